"""Secret scan: fixed patterns, and Markov models of random strings.

The fixed patterns find assignments (``password=...``), access keys and runs of
hexadecimal digits. Beside them, every token is held against two character
Markov models of order one, one of random strings and one of ordinary
identifiers and words. The sum of the log-likelihood ratios of its character
pairs says which it resembles; each pair that a token has counts once, so that
rulers and other repetitions don't add up, and gives ``MOST`` nats at most.
Tokens above the threshold are added as spans of kind ``markov`` unless they
touch a span of the fixed patterns. A token of fewer pairs than the threshold
over ``MOST`` can't get there and isn't looked at.

The models are counts of character pairs over labelled samples (strings with
label 1 for secrets, 0 for ordinary ones; random strings of three alphabets and
common identifiers are always among them), with additive smoothing; they end up in one
array of ratios, a constant of the plan. Everything runs on DataFrame functions:
no Python touches a row.

Positions are running sums over the matches of a text, taken in runs of ``RUN``
matches, so that a text of many matches takes nearly linear time. Spans count
code points, ends are exclusive, and a span covers the whole match.

Defined results: null text counts as empty; an empty text has no spans and its
``base_sha256`` is that of the empty string; without samples the models are those
of the strings they always learn from; texts are scanned whole, whatever their length
and number of matches; repeated rows give repeated results; other columns play
no part, whatever their names.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bounded, fresh, text_or_empty

KINDS = ("assign", "access", "hex", "markov")
#: Letters in the keyword may be in either case; group 1 is the value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A match takes all that follows, so one that is too short hides no longer one.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
TOKEN_CHARACTERS = "[A-Za-z0-9+/_=-]"
TOKEN_SAMPLED = TOKEN_CHARACTERS + "{8,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Alphabets of the random strings that the model of secrets always learns from.
RANDOM_FROM = ("0123456789abcdef", ALPHABET[:62], ALPHABET[:64])
#: Words of the ordinary identifiers that the other model always learns from.
IDENTIFIER_WORDS = "max buffer size value name get set user account http server request response config default timeout connection index file path data type error message status code table column query session version build test main class object string number list map update delete create read write open close start stop count total limit offset time date".split()
#: Documents from which labelled samples are drawn.
SAMPLE_DOCUMENTS = 20_000
#: Nats that a pair of characters may add, and the sum from which a token counts as random.
MOST, THRESHOLD = 2.0, 16.0
#: Matches in one run of a running sum.
RUN = 256
MASK = "[SECRET]"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _running(values: Column, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """For each value of an int array, ``start`` merged with all values before it."""
    none = F.array().cast("array<int>")

    def along(run: Column, begin: Column) -> Column:
        zero = F.struct(begin.alias("at"), none.alias("out"))
        return F.aggregate(run, zero, lambda acc, x: F.struct(merge(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def whole(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / RUN).cast("int")
        runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * RUN + 1, RUN))
        return _let(runs, lambda r: F.flatten(F.zip_with(r, along(F.transform(r, lambda x: F.aggregate(x, start, merge)), start), along)))

    return _let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(none))


def _sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b, F.lit(0))


def _no_spans() -> Column:
    return F.array().cast(_SPAN)


def _spans(text: Column, pattern: str, kind: int, hit_ok=None, group: int = 0) -> Column:
    """Matches of ``pattern`` as (start, kind, end); ``hit_ok`` judges group ``group`` of each."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    shown = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = lambda c: F.transform(c, lambda x: F.length(x))

    def found(hit: Column) -> Column:
        gap = sizes(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hit)))
        good = F.transform(shown if group else hit, hit_ok) if hit_ok is not None else F.transform(hit, lambda x: F.lit(True))
        rows = F.arrays_zip(gap.alias("gap"), sizes(hit).alias("size"), good.alias("good"))
        return _let(rows, lambda r: F.zip_with(r, _sums(F.transform(r, lambda x: x["gap"] + x["size"])), lambda x, before: F.struct((before + x["gap"]).alias("start"), F.lit(kind).alias("kind"), (before + x["gap"] + x["size"]).alias("end"), x["good"].alias("good"))))

    plain = lambda all_: F.transform(F.filter(all_, lambda x: x["good"]), lambda x: F.struct(x["start"], x["kind"], x["end"]))
    return F.when(text.rlike(pattern), plain(_let(hits, found))).otherwise(_no_spans())


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": _spans(text, ASSIGN, 0, lambda value: F.length(value) >= ASSIGN_LEAST, group=1),
        "access": _spans(text, ACCESS, 1),
        "hex": _spans(text, HEX, 2),
    }


def random_strings(n: int = 1500, alphabets: Iterable[str] = RANDOM_FROM, seed: int = 11) -> list[str]:
    """``n`` random strings from each alphabet, the same in every run."""
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randrange(16, 41))) for letters in alphabets for _ in range(n)]


def ordinary_identifiers() -> list[str]:
    """Pairs of words as constants, snake case, camel case and paths."""
    out = []
    for step in range(1, 12):
        for a, b in zip(IDENTIFIER_WORDS, IDENTIFIER_WORDS[step:], strict=False):
            out += [f"{a}_{b}", f"{a}_{b}".upper(), a + b.title(), a.title() + b.title(), f"{a}/{b}", f"{a}-{b}"]
    return out


def samples_from(docs: DataFrame, rows: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text", kinds: Iterable[str] = KINDS[:3]) -> DataFrame:
    """Labelled strings from at most ``rows`` documents, those whose ids hash
    lowest: values that the fixed patterns of ``kinds`` find (1), and the tokens
    outside all fixed patterns (0)."""
    ids = docs.select(F.col(id_col).cast("long").alias("_id")).filter("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("text")).join(bounded(ids), "_id", "left_semi")
    value = lambda pattern, group: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    long_enough = lambda x: F.length(x) >= ASSIGN_LEAST
    listed = {"assign": F.filter(value(ASSIGN, 1), long_enough), "access": value(ACCESS, 0), "hex": value(HEX, 0)}
    secret = F.concat(F.array().cast("array<string>"), *(listed[k] for k in kinds))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = F.regexp_extract_all(rest, F.lit(TOKEN_SAMPLED), F.lit(0))
    both = F.concat(F.transform(secret, lambda s: F.struct(s.alias("string"), F.lit(1).alias("label"))), F.transform(plain, lambda s: F.struct(s.alias("string"), F.lit(0).alias("label"))))
    return texts.select(F.explode(both).alias("s")).select("s.string", "s.label")


def train(samples: DataFrame, smoothing: float = 0.5, also: Iterable[str] | None = None) -> list[float]:
    """Log-likelihood ratios of the alphabet's character pairs, row by row. Each
    distinct string counts once; ``also``: further strings with label 1."""
    size = len(ALPHABET)
    chars = F.split("string", "")
    pairs = F.zip_with(F.slice(chars, F.lit(1), F.size(chars) - 1), F.slice(chars, F.lit(2), F.size(chars) - 1), lambda a, b: F.concat(a, b))
    counts = samples.filter("length(string) > 1").select("label", "string").distinct().select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").agg(F.count("*").alias("n"))
    seen = Counter({(r["label"], r["pair"]): r["n"] for r in counts.collect()})  # at most two rows for each pair of the alphabet
    for label, strings in ((1, random_strings() if also is None else also), (0, ordinary_identifiers())):
        for string in strings:
            seen.update((label, a + b) for a, b in zip(string, string[1:], strict=False))
    of = lambda y, a, b: seen.get((y, a + b), 0)
    ends = {(y, b): sum(of(y, a, b) for a in ALPHABET) for y in (0, 1) for b in ALPHABET}
    all_ = {y: sum(ends[y, b] for b in ALPHABET) for y in (0, 1)}
    # a pair that was not seen falls back on how common its second character is
    alone = {(y, b): (ends[y, b] + smoothing) / (all_[y] + smoothing * size) for y in (0, 1) for b in ALPHABET}
    out = []
    for a in ALPHABET:
        total = {y: sum(of(y, a, b) for b in ALPHABET) for y in (0, 1)}
        for b in ALPHABET:
            p, q = ((of(y, a, b) + smoothing * size * alone[y, b]) / (total[y] + smoothing * size) for y in (1, 0))
            out.append(round(min(MOST, math.log(p / q)), 4))
    return out


def randomness(token: Column, ratios: list[float]) -> Column:
    """Sum of the log-likelihood ratios of a token's distinct character pairs."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    pairs = _let(places, lambda p: F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: a * len(ALPHABET) + b))
    return F.aggregate(F.array_distinct(pairs), F.lit(0.0), lambda acc, i: acc + F.get(table, i))


def _untouched(base: Column, added: Column) -> Column:
    """The spans of ``added`` that share no character with one of ``base``."""
    most = (1 << 31) - 1

    def free(all_: Column) -> Column:
        before = _running(F.transform(all_, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), lambda a, b: F.greatest(a, b), F.lit(0))
        after = F.reverse(_running(F.reverse(F.transform(all_, lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(most))), lambda a, b: F.least(a, b), F.lit(most)))
        rows = F.arrays_zip(all_.alias("span"), before.alias("before"), after.alias("after"))
        alone = F.filter(rows, lambda r: (r["span"]["kind"] == 3) & (r["before"] <= r["span"]["start"]) & (r["after"] >= r["span"]["end"]))
        return F.transform(alone, lambda r: r["span"])

    return F.when(F.size(added) > 0, _let(F.array_sort(F.concat(base, added)), free)).otherwise(_no_spans())


def scanned(docs: DataFrame, ratios: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns text (never null) and spans of each kind, under fresh names."""
    names = {k: fresh(docs, f"spans_{k}") for k in KINDS} | {"text": fresh(docs, "text_here")}
    text = F.col(names["text"])
    out = docs.withColumn(names["text"], text_or_empty(text_col))
    out = out.withColumns({names[k]: c for k, c in base_spans(text).items()})
    highest = max(ratios, default=0.0)
    if threshold > 0 >= highest:
        return out.withColumn(names["markov"], _no_spans()), names
    least = max(1, math.ceil(threshold / highest) + 1)  # a shorter token has too few pairs
    added = _spans(text, f"{TOKEN_CHARACTERS}{{{least},}}", 3, lambda t: randomness(t, ratios) >= threshold)
    out = out.withColumn(names["markov"], added)
    return out.withColumn(names["markov"], _untouched(F.concat(*(F.col(names[k]) for k in KINDS[:3])), F.col(names["markov"]))), names


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: number of spans of each fixed kind, their digest, and all spans."""
    out, names = scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ratios, "text", threshold)
    base = F.concat(*(F.col(names[k]) for k in KINDS[:3]))
    return out.select(
        F.col("doc_id").cast("long").alias(id_col),
        *(F.size(names[k]).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.concat(base, F.col(names["markov"]))).alias("spans"),
    )


def _cut(text: Column, kept: Column) -> Column:
    """The parts (from, to) of ``text``, each followed by a mask. Parts are cut out of
    the stretch of text that a run of them covers, so that none is looked up from
    the beginning of a long text."""

    def stretch(run: Column) -> Column:
        first, last = F.get(run, F.lit(0))["from"], F.element_at(run, -1)["to"]
        return _let(F.substring(text, first + 1, last - first), lambda part: F.array_join(F.transform(run, lambda r: F.concat(F.substring(part, r["from"] - first + 1, r["to"] - r["from"]), F.lit(MASK))), ""))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(kept) - 1) / RUN).cast("int")), lambda i: stretch(F.slice(kept, i * RUN + 1, RUN))), "")


def masked(docs: DataFrame, ratios: list[float], text_col: str = "text", length_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``MASK`` and the length brought up to date."""
    out, names = scanned(docs, ratios, text_col, threshold)
    text = F.col(names["text"])
    spans = F.array_sort(F.concat(*(F.col(names[k]) for k in KINDS)))

    def clean(all_: Column) -> Column:
        """Spans that start after all ends before them give a mask each; the others lengthen one."""
        ends = F.transform(all_, lambda s: s["end"])
        rows = F.arrays_zip(_running(ends, lambda a, b: F.greatest(a, b), F.lit(0)).alias("from"), F.transform(all_, lambda s: s["start"]).alias("to"))
        return _let(F.filter(rows, lambda r: r["to"] >= r["from"]), lambda kept: F.concat(_cut(text, kept), F.substring(text, F.array_max(ends) + 1, F.length(text))))

    clean = _let(spans, clean)
    there = F.size(spans) > 0
    new = {text_col: F.when(there, clean).otherwise(F.col(text_col))}
    if length_col and length_col in docs.columns:
        new[length_col] = F.when(there, F.length(clean).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return out.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
