"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the least of its s-mers (by hash)
is its first or its last one. Whether a k-mer is chosen depends on nothing
outside it, so equal passages give equal anchors wherever they stand, and two
chosen k-mers are never further apart than k - s. All anchors, each with its
position, are the fingerprint: ``hash@position`` joined by ``;``, by position. A
text shorter than k is a k-mer of its own and its only anchor. Texts of every
length are treated alike: about two anchors in k - s + 1 characters. Likeness is
the Jaccard index of the anchors, where common ones count that lie on the
commonest shift between the two texts or next to another on the same shift, so
that chance matches at scattered places don't count. ``to_compact`` writes the same
anchors in six characters each, under half as many, and ``from_compact`` reads them.

To give each row its successor, rows are dealt into ranges of ids whose bounds
are quantiles; an id that fills several ranges is split by a hash of the text.
The first row of each range also goes to the range before it (a halo row), so
that every task finds the successor of its last row.

Defined results: null text counts as empty; an empty text has the fingerprint
""; two empty texts have likeness 1; rows with equal ids follow each other by a
hash of their text (only rows that repeat id and text share a task); rows without
id come first; the last row's successor is the first row, which may be the row
itself; other columns play no part, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, text_or_empty

#: Lengths of an anchor and of the inner substrings that choose it.
K, S = 8, 3
#: Characters of fingerprints after which a batch of results is passed on.
OUT_CHARS = 8 << 20
#: Ranges of ids that one shuffle partition gets on average.
RANGES_PER_PARTITION = 4
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S32, _LOW, _SIDE = np.uint64(32), np.uint64((1 << 32) - 1), np.uint64(1 << 31)
_TENS = 10 ** np.arange(10, dtype=np.int64)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
_SIXTY_FOUR = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
_OF_CHAR = np.zeros(128, np.uint64)
_OF_CHAR[_SIXTY_FOUR] = np.arange(64, dtype=np.uint64)
#: Characters of an anchor in the compact form; they hold its hash and, in ``_STEP`` bits, how far it is from the one before.
_CHARS, _STEP = 6, np.uint64(4)
_FAR = np.uint64(15)


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    n = len(codes) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _A + codes[i : i + n]
    out = (out ^ (out >> _S32)) * _B
    return out ^ (out >> _S32)


def anchors(codes: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the closed syncmers."""
    small = _hashes(codes, s)
    w, n = k - s + 1, len(codes) - k + 1
    least, width = small, 1
    while width < w:  # minima of windows that double until they cover w
        step = min(width, w - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    least = least[:n]
    at = np.flatnonzero((small[:n] == least) | (small[w - 1 : w - 1 + n] == least))
    return _hashes(codes, k)[at] >> _S32, at


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


def chosen(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a text's anchors, by position."""
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(codes) < k:
        return _hashes(codes, len(codes)) >> _S32, np.zeros(1, np.int64)
    return anchors(codes, k, s)


def sketch(found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Anchors as ascending numbers: hash in the upper half, position in the lower.

    The n-th occurrence of a hash is an anchor of its own; of equal ones the first counts."""
    packed = np.sort(found[0] << _S32 | found[1].astype(np.uint64))
    hashes = packed >> _S32
    again = np.flatnonzero(hashes[1:] == hashes[:-1]) + 1
    if len(again):
        new = np.ones(len(packed), bool)
        new[again] = False
        at = np.arange(len(packed))
        nth = (at - np.maximum.accumulate(np.where(new, at, 0)))[again].astype(np.uint64)
        packed[again] = ((hashes[again] + nth * _A) * _B >> _S32) << _S32 | packed[again] & _LOW
        packed.sort()
        values = packed >> _S32
        new[0], new[1:] = True, values[1:] != values[:-1]
        packed = packed[new]
    return packed


def fingerprint(codes: np.ndarray, k: int = K, s: int = S) -> np.ndarray:
    return sketch(chosen(codes, k, s))


def to_text(print_: np.ndarray) -> str:
    """``hash@position``, by position, joined by ``;``."""
    if not len(print_):
        return ""
    turned = np.sort(print_ << _S32 | print_ >> _S32)
    at, hashes = (turned >> _S32).astype(np.int64), (turned & _LOW).astype(np.int64)
    digits = len(str(int(at[-1])))
    out = np.empty((len(at), 10 + digits), np.uint8)
    for i in range(8):
        out[:, i] = _HEX[hashes >> (28 - 4 * i) & 15]
    out[:, 8], out[:, -1] = ord("@"), ord(";")
    used = np.ones(out.shape, bool)
    for i in range(digits):
        ten = _TENS[digits - 1 - i]
        out[:, 9 + i] = at // ten % 10 + 48
        if i < digits - 1:
            used[:, 9 + i] = at >= ten
    return out[used].tobytes()[:-1].decode("ascii")


def to_compact(print_: np.ndarray) -> str:
    """All anchors by position, each in ``_CHARS`` characters: 32 bits of hash, then the step from the anchor before
    (from -1 for the first) less 1. A step above 15 is 15 there and follows in as many characters of its own."""
    turned = np.sort(print_ << _S32 | print_ >> _S32)
    step = np.diff((turned >> _S32).astype(np.int64), prepend=-1).astype(np.uint64) - np.uint64(1)
    words = (turned & _LOW) << _STEP | np.minimum(step, _FAR)
    far = np.flatnonzero(step >= _FAR)
    if len(far):
        words = np.insert(words, far + 1, step[far])
    shifts = np.arange(6 * (_CHARS - 1), -1, -6, dtype=np.uint64)
    return _SIXTY_FOUR[(words[:, None] >> shifts & np.uint64(63)).astype(np.int64)].tobytes().decode("ascii")


def from_compact(text: str) -> np.ndarray:
    """The fingerprint that ``to_compact`` has written."""
    words = np.zeros(len(text) // _CHARS, np.uint64)
    for column in _OF_CHAR[np.frombuffer(text.encode("ascii"), np.uint8)].reshape(-1, _CHARS).T:
        words = words << np.uint64(6) | column
    out, at, i = [], -1, 0
    while i < len(words):
        word, i = int(words[i]), i + 1
        step = word & int(_FAR)
        if step == int(_FAR):
            step, i = int(words[i]), i + 1
        at += step + 1
        out.append(word >> int(_STEP) << 32 | at)
    return np.sort(np.array(out, np.uint64))


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    if np.array_equal(x, y):
        return 1.0
    both = np.sort(np.concatenate([x, y | _SIDE]))  # positions take 31 bits
    values = both >> _S32
    i = np.flatnonzero(values[1:] == values[:-1])
    if not len(i):
        return 0.0
    common = np.sort((both[i] & _LOW) << _S32 | (both[i + 1] & _LOW) ^ _SIDE)
    shift = (common & _LOW).astype(np.int64) - (common >> _S32).astype(np.int64)
    shifts, n = np.unique(shift, return_counts=True)
    good = shift == shifts[np.argmax(n)]
    same = shift[1:] == shift[:-1]
    good[1:] |= same
    good[:-1] |= same
    return int(good.sum()) / (len(x) + len(y) - len(i))


def after_edit(codes: np.ndarray, found: tuple[np.ndarray, np.ndarray], following: np.ndarray, k: int = K, s: int = S) -> np.ndarray:
    """The edited text's fingerprint: anchors within the part that stays are those of the text (``found``)."""
    n = len(codes) // 4
    kept = len(codes) - n
    new = np.concatenate([codes[:kept], following[:n]])
    since = kept - k + 1  # the first k-mer that reaches into the new part
    if since <= 0 or len(new) < k:
        return sketch(chosen(new, k, s))
    same = np.searchsorted(found[1], since)
    hashes, at = chosen(new[since:], k, s) if len(new) - since >= k else (found[0][:0], found[1][:0])
    return sketch((np.concatenate([found[0][:same], hashes]), np.concatenate([found[1][:same], at + since])))


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the following text's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _array(values: list[int]) -> Column:
    """A constant array from a single literal, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_successor(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (range, halo, id, text), dealt by range and sorted within it, each range followed by its halo row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("key", F.coalesce("id", F.lit(-(1 << 63)))).withColumn("tie", F.xxhash64("text"))
    n = RANGES_PER_PARTITION * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0] or []
    ranges = Counter(found)  # how many ranges begin with an id: at most one for each in all
    bounds, upto = sorted(ranges), [0]
    for bound in bounds:
        upto.append(upto[-1] + ranges[bound])
    spot = F.lit(0)
    if bounds:
        listed = _array(bounds)
        steps = F.array(*(F.lit(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1)))
        # binary search: how many bounds are at most the key
        spot = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(lo + step > len(bounds), lo).when(F.get(listed, lo + step - 1) <= F.col("key"), lo + step).otherwise(lo))
    rows = rows.withColumn("spot", spot)
    if bounds:
        begin, end = F.get(_array(upto), F.greatest(F.col("spot") - 1, F.lit(0))), F.get(_array(upto), F.col("spot"))
        # an id that is a bound: its rows over all ranges that begin with it, by the hash
        share = F.floor((F.shiftright("tie", 32) + (1 << 31)) * (end - begin) / (1 << 32))
        at = F.when((F.col("spot") > 0) & (F.col("key") == F.get(listed, F.col("spot") - 1)), begin + 1 + share).otherwise(end)
        rows = rows.withColumn("range", at.cast("int"))
    else:
        rows = rows.withColumn("range", F.lit(0))
    firsts = {r["range"]: r["first"] for r in rows.groupBy("range").agg(F.min(F.struct("key", "tie")).alias("first")).collect()}  # one row per range
    used = sorted(firsts) or [0]
    width = used[-1] + 1
    column = lambda of: F.get(_array([of(r) for r in range(width)]), F.col("range"))
    before = {r: used[i - 1] for i, r in enumerate(used)}
    first = (F.col("key") == column(lambda r: firsts[r]["key"] if r in firsts else 0)) & (F.col("tie") == column(lambda r: firsts[r]["tie"] if r in firsts else 0))
    own = F.struct(F.col("range"), F.lit(0).alias("halo"))
    copy = F.struct(column(lambda r: before.get(r, 0)).cast("int").alias("range"), F.lit(1).alias("halo"))
    dealt = rows.select(F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))).alias("to"), "id", "key", "tie", "text")
    return dealt.select("to.range", "to.halo", "id", "text", "key", "tie").repartition("range").sortWithinPartitions("range", "halo", "key", "tie", "text").drop("key", "tie")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: Callable[[np.ndarray], str] = to_text) -> DataFrame:
    """Per row: the fingerprints of its text and of its edited text, and how like
    the first is to the second and to its successor's. ``written``: how fingerprints
    are written, ``to_text`` or ``to_compact``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (range, id, text, codes, anchors, fingerprint)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def packed(out: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

        for batch in batches:
            out: list[tuple] = []
            size = 0
            for at, halo, doc, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3)), strict=True):
                if halo and (last is None or last[0] != at):
                    continue  # a further row with the id of the range's first
                codes = codes_of(text)
                found = chosen(codes)
                own = sketch(found)
                if last is not None and last[0] == at:
                    _, prior, before, had, anchors_, print_ = last
                    new = edited(before, text)
                    changed = print_ if new == before else after_edit(had, anchors_, codes)
                    out.append((prior, len(had), hashlib.sha256(new.encode()).hexdigest(), written(print_), written(changed), likeness(print_, changed), likeness(print_, own)))
                    size += len(out[-1][3]) + len(out[-1][4])
                    if size > OUT_CHARS:
                        yield packed(out)
                        out, size = [], 0
                last = None if halo else (at, doc, text, codes, found, own)
            yield packed(out)

    schema = f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_arrow(with_successor(docs, id_col, text_col), run, schema)
