"""Fuzzy matching and grouping of names."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.company_words import LONG_WORDS, STOP_WORDS
from ..functions.transliterate import ascii_text
from ..graph.components import components
from ..session import if_small, materialize, spread

# -- scorers ------------------------------------------------------------------


def prepared(text: str) -> str:
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = where.get(c, 0) & row
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> int:
    """Twice the common subsequence over both lengths, in percent."""
    return round(100 * 2 * lcs(a, b) / (len(a) + len(b))) if a and b else 0


def token_sort_ratio(a: str, b: str) -> int:
    return ratio(" ".join(sorted(prepared(a).split())), " ".join(sorted(prepared(b).split())))


def token_set_ratio(a: str, b: str) -> int:
    return _set_ratio(set(prepared(a).split()), set(prepared(b).split()))


def _set_ratio(p: set[str], q: set[str]) -> int:
    both = " ".join(sorted(p & q))
    first, second = (f"{both} {' '.join(sorted(x))}".strip() for x in (p - q, q - p))
    return max(ratio(both, first), ratio(both, second), ratio(first, second))


# -- candidates ---------------------------------------------------------------

#: Room for the rounding of limits that are whole numbers.
_ROUND = 1e-9

def _least(length: Column | int, cutoff: float) -> Column:
    """Length that a partner of a string of ``length`` must have to reach the ratio."""
    return F.ceil(cutoff * length / (200 - cutoff) - _ROUND)


def sorted_tokens(c: str | Column, distinct: bool = False) -> Column:
    """Lower-cased words of letters and digits in order, as one string."""
    words = F.filter(F.split(F.lower(X.col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_distinct(words) if distinct else words), " ")


def _grams(key: Column, q: int) -> Column:
    """Grams of a key with a blank at both ends; a repeated one carries its number. Words
    in another order have the same grams of two."""
    text = F.concat(F.lit(" "), key, F.lit(" ")) if q == 2 else key
    listed = F.array_sort(F.transform(F.sequence(F.lit(1), F.length(text) - (q - 1)), lambda i: F.substring(text, i, F.lit(q))))
    # bound to a variable, or the sorted list would be made again for each of its grams
    return F.transform(F.array(listed), lambda all_: F.transform(all_, lambda g, i: F.concat(g, (i + 2 - F.array_position(all_, g)).cast("string"))))[0]


def _mask(parts: Column, seed: int) -> Column:
    """64 bits, of which each part sets one."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x, F.lit(seed)), F.lit(64)).cast("int"))))


def _lacks(a: str, b: str) -> Column:
    """At least so many parts of ``a`` are not in ``b`` (masks)."""
    return F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b))))


def _fronts(rows: DataFrame, parts: Column, rarity: DataFrame, keep: Callable[[Column], Column], *carried: str) -> DataFrame:
    """(id, key, carried columns, part, its place, number of parts) for the rarest parts of
    each key, as many as ``keep`` says of the sorted array; ``rarity``: (part, df) over the
    keys to match against."""
    each = rows.select("id", "key", *carried, F.explode(parts).alias("part")).join(if_small(rarity), "part", "left")
    listed = each.groupBy("id", "key", *carried).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "part"))).alias("parts"))  # one key's own
    return listed.select("id", "key", *carried, F.size("parts").alias("of"), F.posexplode(keep(F.col("parts"))).alias("at", "p")).select("id", "key", *carried, F.col("p.part").alias("part"), "at", "of")


def _rarity(rows: DataFrame, parts: Column) -> DataFrame:
    return rows.select(F.explode(parts).alias("part")).groupBy("part").agg(F.count("*").alias("df"))


def _by_grams(names: DataFrame, choices: DataFrame, cutoff: float) -> DataFrame:
    """Pairs (a, b) that may reach the indel ratio.

    Of strings with lengths m and n that share a subsequence of L, all but 2 (m - L) +
    (n - L) of the first one's m + 1 grams of two are also in the other: an unmatched
    character takes two with it, one in between takes one. So at least 3 L - m - n + 1
    are common, and with grams in one order, rarest first, one of them is among the
    first of both strings, so far in front that enough can follow. Bit masks of characters
    and grams, of which a pair may lack only so many, pass over most other pairs within
    the join. Where that number could be 0 (ratios under 2/3), single
    characters are taken, of which L are common.
    """
    q = 2 if cutoff >= 67 else 1
    length, grams, letters = F.length("key"), _grams(F.col("key"), q), _grams(F.col("key"), 1)
    total = length + _least(length, cutoff)
    shared = lambda total: F.ceil((3 * cutoff / 200 - 1) * total + 1 - _ROUND) if q == 2 else F.ceil(cutoff / 200 * total - _ROUND)
    first = lambda listed: F.slice(listed, 1, F.greatest(F.lit(1), F.size(listed) - shared(total) + 1).cast("int"))
    profiled = lambda x: x.withColumns({"n": length, "c": _mask(letters, 0), "g": _mask(grams, 1), "h": _mask(grams, 2)})
    rarity = materialize(_rarity(choices, grams), "grams")
    a, b = (materialize(_fronts(profiled(x), grams, rarity, first, "n", "c", "g", "h").drop("key"), "fronts") for x in (names, choices))
    a, b = (x.withColumnsRenamed({c: f"{c}_{side}" for c in x.columns if c != "part"}) for x, side in ((a, "a"), (b, "b")))
    m, n = F.col("n_a"), F.col("n_b")
    common = F.ceil(cutoff / 200 * (m + n) - _ROUND)  # characters
    room = shared(m + n) <= F.least(F.col("of_a") - F.col("at_a"), F.col("of_b") - F.col("at_b"))
    fits = (n >= _least(m, cutoff)) & (m >= _least(n, cutoff)) & room & (_lacks("c_a", "c_b") <= m - common) & (_lacks("c_b", "c_a") <= n - common)
    for mask in ("g", "h") if q == 2 else ():
        fits = fits & (_lacks(f"{mask}_a", f"{mask}_b") <= 2 * (m - common) + (n - common))
    pairs = spread(a, "part").join(spread(b, "part"), "part").filter(fits).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    return spread(pairs, "a", "b").distinct()


def _by_tokens(names: DataFrame, choices: DataFrame, cutoff: float) -> DataFrame:
    """Pairs (a, b) of which common words make up so much of one side that they reach the
    ratio by themselves. With words in one order, rarest first, one of the common words
    is among the first of that side, after which less than needed is left."""
    words = F.split("key", " ")
    need = F.length("key") * cutoff / (200 - cutoff) - _ROUND
    # a word belongs to the front if it and what follows, with blanks, are still as long as needed
    length_from = lambda listed, i: F.aggregate(F.slice(listed, i + 1, F.size(listed)), F.lit(-1), lambda s, p: s + F.length(p["part"]) + 1)
    long = lambda listed: F.filter(listed, lambda p, i: (i == 0) | (length_from(listed, i) >= need))
    rarity = materialize(_rarity(choices, words), "words")
    all_a, all_b = (x.select(F.col("id").alias(side), F.explode(F.array_distinct(words)).alias("part"), F.length("key").alias("n")) for x, side in ((names, "a"), (choices, "b")))
    few_a, few_b = (_fronts(x, F.array_distinct(words), rarity, long).select(F.col("id").alias(side), "part", need.alias("need")) for x, side in ((names, "a"), (choices, "b")))
    pair = lambda few, every: spread(few, "part").join(spread(every, "part"), "part").filter("n >= need").select("a", "b")
    return spread(pair(few_a, all_b).unionByName(pair(few_b, all_a)), "a", "b").distinct()


def candidates(names: DataFrame, choices: DataFrame, scorer: str, cutoff: int) -> DataFrame:
    """Pairs (a, b) of ids of ``names`` and ``choices`` (id, key) among which are all that
    reach ``cutoff``; found by equi-joins, never by comparing each with each."""
    least = cutoff - 0.5  # scores are rounded
    pairs = _by_grams(names, choices, least)
    return spread(pairs.unionByName(_by_tokens(names, choices, least)), "a", "b").distinct() if scorer == "token_set_ratio" else pairs


#: Scores of two keys of equal kind.
KEY_SCORERS = {"ratio": ratio, "token_sort_ratio": ratio, "token_set_ratio": lambda a, b: _set_ratio(set(a.split()), set(b.split()))}


#: Scores that are asked for first, one after the other, above the cutoff, and the products of names and choices
#: from which on they are: the higher the score, the fewer the candidates, and most names have a near choice.
RUNGS, RUNGS_FROM = (90,), 20_000_000


def _best(asked: DataFrame, answers: DataFrame, scorer: str, cutoff: int) -> DataFrame:
    """``(a, t)``: the best choice ``t`` (k: its score below 0, least: its name) of each asked id that has one of at least ``cutoff``."""
    pairs = candidates(asked.select("id", "key"), answers.select("id", "key"), scorer, cutoff)
    texts = pairs.join(asked.select(F.col("id").alias("a"), F.col("key").alias("ka")), "a").join(answers.select(F.col("id").alias("b"), F.col("key").alias("kb"), "least"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = KEY_SCORERS[scorer]
        for batch in batches:
            scores = [score(x, y) for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(scores, pa.int32())], names=["a", "least", "score"])
            yield out.filter(pa.array([s >= cutoff for s in scores], pa.bool_()))

    scored = texts.select("a", "ka", "kb", "least").mapInArrow(run, "a long, least string, score int")
    return scored.groupBy("a").agg(F.min(F.struct((-F.col("score")).alias("k"), "least")).alias("t"))


def fuzzy_match(names: DataFrame, choices: DataFrame, column: str, scorer: str = "token_sort_ratio", cutoff: int = 80, rungs_from: int = RUNGS_FROM) -> DataFrame:
    """``(column, match, score)`` for the distinct names: the best choice of at least
    ``cutoff``, itself if it is a choice, else the least of equally good ones; null and 0
    if there is none. Only candidates of lossless blocks are scored; in large tables first
    those of high scores, so that only names without such a choice go on to lower ones."""
    distinct = names.select(F.col(column).alias("name")).filter("name is not null").distinct()
    listed = choices.select(F.col(choices.columns[0]).alias("name")).filter("name is not null").distinct()
    distinct = materialize(distinct.join(listed.withColumn("exact", F.lit(True)), "name", "left"), "names")
    key = F.col("name") if scorer == "ratio" else sorted_tokens("name", distinct=scorer == "token_set_ratio")
    keyed = lambda df: df.select("name", key.alias("key")).filter("key <> ''")
    # what has the same key is one; of choices the least name stands for it
    one = lambda df: df.groupBy("key").agg(F.min("name").alias("least")).withColumn("id", F.monotonically_increasing_id())
    open_ = materialize(keyed(distinct.filter("exact is null")), "open")
    asked, answers = (materialize(spread(one(x)), n) for x, n in ((open_, "asked"), (keyed(listed), "choices")))
    # a name that has a choice at a rung has its best there, with all that are as good
    steps = [r for r in RUNGS if r > cutoff] if asked.count() * answers.count() >= rungs_from else []
    best, left = None, asked
    for rung in (*steps, cutoff):
        found = materialize(_best(left, answers, scorer, rung), "best")
        best = found if best is None else best.unionByName(found)
        if rung > cutoff:
            left = materialize(spread(left.join(found.select(F.col("a").alias("id")), "id", "left_anti")), "left")
    best = best.join(asked.select(F.col("id").alias("a"), "key"), "a").select("key", F.col("t.least").alias("match"), (-F.col("t.k")).alias("score"))
    found = open_.join(best, "key").select("name", "match", "score")
    out = distinct.join(found, "name", "left")
    match = F.when(F.col("exact"), F.col("name")).otherwise(F.col("match"))
    return out.select(F.col("name").alias(column), match.alias("match"), F.when(F.col("exact"), 100).otherwise(F.coalesce("score", F.lit(0))).cast("int").alias("score"))


def match_names(names: DataFrame, choices: DataFrame, column: str) -> DataFrame:
    """Two rounds: sorted tokens, of which scores over 90 count, then token sets from 80."""
    first = materialize(fuzzy_match(names, choices, column, "token_sort_ratio", 91), "fuzzy")
    sure = first.filter("match is not null")
    rest = first.filter("match is null").select(column)
    second = fuzzy_match(rest, choices, column, "token_set_ratio", 80).filter("match is not null")
    return sure.unionByName(second)


# -- company names ------------------------------------------------------------

def prepared_name(c: str | Column, transliterate: bool = True, punctuation: bool = True, faithful: bool = True, long_words: dict[str, str] | None = LONG_WORDS) -> Column:
    """A company name ready for grouping; null for empty, digit-only and unknown ones.
    ``faithful`` leaves stop words in, as the published results have them."""
    name = F.upper(F.trim(X.col(c)))
    x = name
    for pattern, new in (
        (r"\d{2,}", " "),
        (r"C\WO", " "),
        (r"S\W?A\W*DE\W?C\W?V", " SA DE CV "),
        (r"\W+L\W?L\W?C", " LLC "),
        (r"\W+U\W?S\W?A", " USA "),
        (r"\(.*\)", " "),
    ):
        x = F.regexp_replace(x, pattern, new)
    if transliterate:
        x = F.upper(ascii_text(x))
    if punctuation:
        x = F.replace(F.replace(x, F.lit("&"), F.lit(" AND ")), F.lit("+"), F.lit(" AND "))
        x = F.regexp_replace(x, "[^0-9A-Z]", " ")
    x = F.regexp_replace(x, r"\s+", " ")
    if not faithful:
        longest_first = sorted(STOP_WORDS, key=lambda w: (-len(w), w))
        x = F.regexp_replace(x, r"\b(?:" + "|".join(map(re.escape, longest_first)) + r")\b", " ")
    x = F.trim(F.regexp_replace(x, r"\s+", " "))
    if long_words:
        x = X.replace_words(x, long_words)
    x = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.when(~name.rlike(r"^\d+$") & (x != "") & (x != "UNKNOWN"), x)


def ngram_groups(names: DataFrame, column: str, n: int = 3, least: float = 0.8) -> DataFrame:
    """``(column, group)``: names whose n-gram TF-IDF cosine reaches ``least`` are
    linked; a group's name is the member with the greatest sum of similarities.

    Only n-grams in a name's prefix are joined on: with the rarest first, the rest
    of the (unit) vector is too short to reach ``least`` by itself, so a pair that
    does shares a gram of both prefixes. Nothing is lost, and frequent n-grams,
    which would make the pairs many, are not joined on. Of the pairs with such a gram
    only those go on whose remaining norms there can still reach ``least``.
    """
    distinct = materialize(names.select(F.col(column).alias("name")).filter("name is not null").distinct(), "names")
    total = distinct.count()
    plain = F.regexp_replace(F.lower("name"), r"[,-./]|\s", "")
    grams = F.when(F.length(plain) >= n, F.transform(F.sequence(F.lit(1), F.length(plain) - n + 1), lambda i: F.substring(plain, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    terms = distinct.select("name", F.explode(grams).alias("gram")).groupBy("name", "gram").agg(F.count("*").alias("tf"))
    terms = materialize(terms, "grams")
    df = terms.groupBy("gram").agg(F.count("*").alias("df"))
    weighted = terms.join(df, "gram").withColumn("w", F.col("tf") * (F.log((1.0 + total) / (1.0 + F.col("df"))) + 1.0))
    vectors = weighted.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("df", "gram", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))  # one name's own grams
    vectors = vectors.select("name", F.transform("v", lambda x: F.struct(x["gram"].alias("gram"), (x["w"] / F.col("norm")).alias("w"))).alias("v"))
    vectors = materialize(vectors, "vectors")
    start = F.struct(F.lit(1.0).alias("left"), F.array().cast("array<struct<gram:string,left:double>>").alias("prefix"))
    step = lambda acc, x: F.struct((acc["left"] - x["w"] * x["w"]).alias("left"), F.when(acc["left"] >= least * least - 1e-9, F.concat(acc["prefix"], F.array(F.struct(x["gram"].alias("gram"), acc["left"].alias("left"))))).otherwise(acc["prefix"]).alias("prefix"))
    prefixes = vectors.select("name", F.inline(F.aggregate("v", start, step, lambda acc: acc["prefix"])))
    # from the first gram that both have on, neither is longer than what is left of it there
    end = lambda e: prefixes.select("gram", F.col("name").alias(e), F.col("left").alias(f"left_{e}"))
    pairs = end("a").join(end("b"), "gram").filter((F.col("a") < F.col("b")) & (F.col("left_a") * F.col("left_b") >= least * least - 1e-9)).select("a", "b").distinct()
    scored = pairs.join(vectors.select(F.col("name").alias("a"), F.col("v").alias("va")), "a").join(vectors.select(F.col("name").alias("b"), F.map_from_entries("v").alias("vb")), "b")
    dot = F.aggregate("va", F.lit(0.0), lambda acc, x: acc + x["w"] * F.coalesce(F.try_element_at("vb", x["gram"]), F.lit(0.0)))
    links = materialize(scored.select("a", "b", dot.alias("similarity")).filter(F.col("similarity") >= least), "similar")
    ends = links.select(F.col("a").alias("name"), "similarity").unionAll(links.select(F.col("b").alias("name"), "similarity")).groupBy("name").agg(F.sum("similarity").alias("s"))
    placed = components(links, "a", "b").withColumnRenamed("node", "name").join(ends, "name")
    heads = placed.groupBy("component").agg(F.min(F.struct(F.round(-F.col("s"), 9).alias("k"), "name")).alias("h"))
    grouped = placed.join(heads.select("component", F.col("h.name").alias("group")), "component").select("name", "group")
    return distinct.join(grouped, "name", "left").select(F.col("name").alias(column), F.coalesce("group", "name").alias("group"))


def restored(c: str | Column, long_words: dict[str, str] = LONG_WORDS) -> Column:
    """Abbreviations turned back into words, longest abbreviation first in list order."""
    return X.replace_words(X.col(c), {v: k for k, v in long_words.items()})


def group_companies(df: DataFrame, name: str, address: str, sizes: Sequence[int] = (6, 5, 4, 3, 3), least: float = 0.8, originals: bool = False, dedupe: bool = True, faithful: bool = True) -> DataFrame:
    """Company names replaced by their group's, and addresses by the group's first
    (least) one. Names that preparation rejects become null; a group without
    address keeps the row's own unless it is only digits."""
    raw = F.upper(F.trim(F.col(name)))
    df = df.withColumn("_raw", raw)
    names = df.select("_raw").distinct().withColumn("prepared", prepared_name("_raw", faithful=faithful)).filter("prepared is not null")
    names = materialize(names, "company")
    current = names.select("_raw", F.col("prepared").alias("group"))
    for n in sizes:
        step = ngram_groups(current.select("group"), "group", n, least)
        current = materialize(current.join(step.toDF("group", "_new"), "group").select("_raw", F.col("_new").alias("group")), "company")
    # words come back only in groups that had them before preparation
    abbreviated = F.array_compact(F.array(*(F.when(F.contains(F.col("_raw"), F.lit(word)), F.lit(word)) for word in LONG_WORDS)))
    touched = current.select("group", F.explode(abbreviated).alias("word")).distinct().groupBy("group").agg(F.collect_set("word").alias("words"))  # at most the list's length
    current = current.join(touched, "group", "left")
    text = F.col("group")
    words = F.coalesce("words", F.array().cast("array<string>"))
    for word, short in LONG_WORDS.items():  # replacing "" changes nothing, so the expression stays a chain
        text = F.replace(text, F.when(F.array_contains(words, word), F.lit(short)).otherwise(F.lit("")), F.lit(word))
    mapping = materialize(current.select("_raw", text.alias("_group")), "company")
    # the group's address goes with the raw name: groups of very many rows are not joined on
    placed = df.select("_raw", address).filter(F.col("_raw").isNotNull() & F.col(address).isNotNull()).groupBy("_raw").agg(F.min(address).alias("_first"))
    firsts = placed.join(mapping, "_raw").groupBy("_group").agg(F.min("_first").alias("_address"))
    mapping = if_small(materialize(mapping.join(firsts, "_group", "left").select("_raw", "_group", "_address"), "company"))
    out = df.join(mapping, "_raw", "left").withColumn("_address", F.coalesce("_address", X.digits_to_null(address)))
    if originals:
        out = out.withColumnsRenamed({name: f"{name}_raw", address: f"{address}_raw"})
    else:
        out = out.drop(name, address)
    out = out.withColumnsRenamed({"_group": name, "_address": address}).drop("_raw")
    return out.dropDuplicates() if dedupe else out


def pool_names(df: DataFrame, entity: str, **settings) -> DataFrame:
    """Distinct grouped names and addresses of one kind of party, over all files."""
    name, address = f"{entity}_name", f"{entity}_address"
    return group_companies(df.select(name, address).dropDuplicates(), name, address, **settings).select(name, address).distinct()
