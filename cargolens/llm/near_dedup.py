"""Near-duplicate groups by one-permutation MinHash with optimal densification.

1. A text's words are hashed, its distinct word shingles form its set, and one
   permutation spreads the set over K bins whose minima are the signature. An
   empty bin takes the value of the first non-empty bin that its own sequence
   of hash probes meets (optimal densification), so that bins stay independent.
2. Documents with equal sets are one class, represented by its least id. From
   here on only representatives take part.
3. The signature is cut into bands. In each bucket the members are linked to one
   centre (star edges), never to each other, so a bucket of m gives m - 1 pairs.
4. Pairs are first held against the two signatures; those that are further below
   the threshold than six standard deviations go. The others are confirmed on
   the full sets.
5. Where the members of a bucket still lie in several components, a further round
   takes another centre from the bucket's largest component, one picked by a hash
   in each bucket, and tests only what lies outside that component. What is then
   left outside goes through an exact prefix join (``_rest``) with all members of
   such buckets. So every pair that shares a bucket is either confirmed, refuted,
   or already in one component, and no bucket is ever multiplied out.

At the threshold a pair shares a bucket with probability 1 - (1 - J^r)^b, which
is over 1 - 1e-8 with the parameters that ``band_plan`` picks.

Nodes are numbers given to the classes, so an id may stand for several sets: each
of them is a node of its own, and they are linked because they share the id.

Defined results: null and blank texts have an empty set and link with nothing;
fewer words than the shingle length make one shingle; rows without id are never
linked; rows that repeat an id are one document, linked with all that any of
their texts is linked with, and ``survivors`` keeps or drops them together; extra
columns play no part, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph.components import components
from ..session import materialize
from ._common import bounded, fresh, map_arrow, text_or_empty

BINS = 240
#: Rounds with one more centre per bucket before the rest goes to the prefix join.
STAR_ROUNDS = 1
#: Frequent shingles whose counts order the exact join of the rest.
FREQUENT_SHINGLES = 300_000
WORD_CACHE = 200_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX1, _MIX2, _MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_S29, _S32 = np.uint64(29), np.uint64(32)


def band_plan(threshold: float, bins: int = BINS, miss: float = 1e-8) -> tuple[int, int]:
    """(bands, rows in each): the longest bands whose chance to miss a pair at the threshold is at most ``miss``."""
    for rows in range(12, 0, -1):
        if bins % rows == 0 and (1 - threshold**rows) ** (bins // rows) <= miss:
            return bins // rows, rows
    return bins, 1


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S29)) * _MIX2
    return x ^ (x >> _S32)


def shingle_set(text: str, k: int) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the text's word k-shingles."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    if len(h) < k:
        out = np.array([len(h)], np.uint64)
        for x in h:
            out = _mixed((out + x) * _MIX1)
    else:
        out = h[:n]
        for i in range(1, k):
            out = _mixed(out * _MIX1 + h[i : i + n])
    return np.unique(_mixed(out * _MIX3))


@lru_cache(maxsize=4)
def _probes(bins: int, chunk: int, width: int = 64) -> np.ndarray:
    """Bins that an empty bin looks at, probe by probe."""
    at = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(chunk * width, (chunk + 1) * width, dtype=np.uint64)
    return (_mixed(_mixed((at + np.uint64(1)) * _MIX1)) % np.uint64(bins)).astype(np.int64)


def signature(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The densified one-permutation signature of a non-empty set."""
    where = ((shingles >> _S32) * np.uint64(bins) >> _S32).astype(np.int64)
    there, first = np.unique(where, return_index=True)  # the set ascends, so the first of a bin is its least
    sig, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    sig[there], full[there] = shingles[first], True
    empty, chunk = np.flatnonzero(~full), 0
    while len(empty):
        probes = _probes(bins, chunk)[empty]
        hit = full[probes]
        found = hit.any(axis=1)
        sig[empty[found]] = sig[probes[found, hit[found].argmax(axis=1)]]
        empty, chunk = empty[~found], chunk + 1
    return sig


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """Per row of ``docs`` (id, text): set size, 128-bit digest of the set, short signature, band keys."""
    bins = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = np.arange(1, bands + 1, dtype=np.uint64) * _MIX3
        for batch in batches:
            n, d1, d2, short, keys = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                a, b = _digest(s.tobytes())
                d1.append(a)
                d2.append(b)
                if not len(s):
                    short.append(None)
                    keys.append(None)
                    continue
                sig = _mixed(signature(s, bins))
                short.append((sig & np.uint64(255)).astype(np.uint8).tobytes())
                key = seeds
                for i in range(rows):
                    key = _mixed(key * _MIX1 + sig[i::rows])
                keys.append(key.view(np.int64))
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(short, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "d1", "d2", "sig", "keys"])

    return map_arrow(docs.select("id", "text"), run, "id long, n long, d1 long, d2 long, sig binary, keys array<long>")


def _digest(raw: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(raw)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def shingle_sets(rows: DataFrame, k: int) -> DataFrame:
    """The sets of ``rows`` (id, text) with their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, k).tobytes() for t in batch.column(1).to_pylist()]
            d1, d2 = zip(*map(_digest, sets), strict=True) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sets, pa.binary())], names=["id", "d1", "d2", "shingles"])

    return map_arrow(rows.select("id", "text"), run, "id long, d1 long, d2 long, shingles binary")


def _alike(bins: int, threshold: float):
    """Keeps pairs (columns sa, sb: short signatures) that may reach the threshold."""
    least = math.floor(bins * threshold - 6 * math.sqrt(bins * threshold * (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, bins) for i in (2, 3))
            keep = (x == y).sum(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(keep))

    return run


def _views(sets: pa.BinaryArray) -> Iterator[np.ndarray]:
    """The sets of a column, without copies."""
    _, offsets, data = sets.buffers()
    ends = np.frombuffer(offsets, np.int32)[sets.offset : sets.offset + len(sets) + 1].tolist() if len(sets) else [0]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    for a, b in zip(ends, ends[1:], strict=False):
        yield np.frombuffer(raw[a:b].tobytes() if a % 8 else raw[a:b], np.uint64)


def _confirm(percent: int):
    """Keeps pairs (columns a, b, xa, xb: shingle sets) with 100 * both >= percent * either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_views(batch.column(2)), _views(batch.column(3)), strict=True):
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _tested(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, bins: int, percent: int) -> DataFrame:
    """Pairs (a < b) of ``pairs`` that are confirmed on the full sets."""
    left = nodes.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    right = nodes.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    near = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_alike(bins, percent / 100), "a long, b long")
    near = materialize(near, "near")
    full = near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("xa")), "a")
    full = full.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("xb")), "b").select("a", "b", "xa", "xb")
    return materialize(map_arrow(full, _confirm(percent), "a long, b long"), "links")


def _rest(residue: DataFrame, outside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a document outside its bucket's largest component and a document of
    another component that may reach the threshold, by an exact prefix join.

    In one order of all shingles, two sets with an overlap of ``o`` share a first
    shingle, at positions i and j, and from there on neither has fewer than ``o``.
    So only shingles near the front are joined on, and only pairs whose positions
    and sizes leave room for the overlap come out. Rare shingles stand in front:
    what many copies have in common is not joined on. Any order is exact, so the
    counts of frequent shingles are kept from a count up at which they are few.
    """
    own = sets.join(residue.select("id"), "id", "left_semi")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], names=["shingle"])

    counts = map_arrow(own.select("shingles"), spread, "shingle long").groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 2")
    counts = materialize(counts, "counts")
    sizes = {r["level"]: r["n"] for r in counts.groupBy(F.floor(F.log2("df")).cast("int").alias("level")).agg(F.count("*").alias("n")).collect()}  # a row for each power of two
    level = min(sizes, default=0)
    while sum(n for k, n in sizes.items() if k >= level) > FREQUENT_SHINGLES:
        level += 1
    listed = counts.filter(F.col("df") >= 2**level).toPandas() if sizes else None  # at most FREQUENT_SHINGLES rows
    known = np.sort(listed["shingle"].to_numpy().view(np.uint64)) if listed is not None else np.empty(0, np.uint64)
    often = listed["df"].to_numpy()[np.argsort(listed["shingle"].to_numpy().view(np.uint64))] if listed is not None else np.empty(0, np.int64)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], [], []]
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = np.frombuffer(raw, np.uint64)
                df = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    df = np.where(known[at] == s, often[at], 0)
                n = len(s) - -(-len(s) * percent // 100) + 1  # a smaller partner shares at least this part of the set
                front = s[np.lexsort((s, df))[:n]]
                for c, x in zip(cols, (np.full(len(front), node), front.view(np.int64), np.arange(len(front)), np.full(len(front), len(s))), strict=True):
                    c.append(x)
            joined = [np.concatenate(c) if c else np.empty(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in joined], names=["id", "shingle", "at", "n"])

    fronts = materialize(map_arrow(own.select("id", "shingles"), prefix, "id long, shingle long, at long, n long").join(residue, "id"), "fronts")
    left = fronts.join(outside, F.col("id") == F.col("out"), "left_semi").select("shingle", F.col("id").alias("x"), F.col("at").alias("i"), F.col("n").alias("nx"), F.col("component").alias("cx"))
    right = fronts.select("shingle", F.col("id").alias("y"), F.col("at").alias("j"), F.col("n").alias("ny"), F.col("component").alias("cy"))
    room = f"{100 + percent} * least(nx - i, ny - j) >= {percent} * (nx + ny)"
    return materialize(left, "outside").join(right, "shingle").filter(f"cx <> cy and {room}").select(*_ordered("x", "y")).distinct()


def _merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: only the graph of the components they connect is run through."""
    of = lambda end, name: joined.select(F.col("node").alias(end), F.col("component").alias(name))
    between = links.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b")
    over = materialize(components(between, "a", "b"), "over").select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = joined.join(over, joined["component"] == over["old"], "left").select("node", F.coalesce("new", "component").alias("component"))
    alone = over.join(joined.select("node"), over["old"] == joined["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return materialize(moved.unionByName(alone), "components")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _same_id(linkable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that one id's texts belong to: a star for each id."""
    several = linkable.groupBy("id").agg(F.min(F.struct("d1", "d2")).alias("lo"), F.max(F.struct("d1", "d2")).alias("hi")).filter("lo <> hi").select("id")
    several = materialize(several, "same-id")
    if not several.limit(1).count():
        return several.select(F.col("id").alias("a"), F.col("id").alias("b"))
    own = linkable.select("id", "d1", "d2").join(bounded(several), "id", "left_semi").distinct().join(classes, ["d1", "d2"]).select("id", "node")
    own = materialize(own, "same-id")
    return own.join(own.groupBy("id").agg(F.min("node").alias("b")), "id").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id`` and ``kept``."""
    bands, rows = band_plan(percent / 100)
    bins = bands * rows
    sized = lambda p, q: f"100 * least({p}, {q}) >= {percent} * greatest({p}, {q})"
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sigs = materialize(signatures(texts, k, bands, rows), "signatures")
    linkable = sigs.filter("id is not null and n > 0")
    classes = linkable.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = linkable.join(classes, ["d1", "d2"]).filter("id = rep").select(F.col("node").alias("id"), "rep", "d1", "d2", "n", "sig", "keys").dropDuplicates(["id"])
    nodes = materialize(nodes, "nodes")

    member = nodes.select(F.explode("keys").alias("key"), "id", "n")
    centres = member.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("centre"), F.min_by("n", "id").alias("nc")).filter("size > 1")
    centres = materialize(centres, "centres")
    shared = materialize(member.join(centres.drop("size"), "key"), "buckets")
    stars = shared.filter("id <> centre").filter(sized("n", "nc")).select(*_ordered("id", "centre")).distinct()
    busy = shared.select(F.col("id").alias("node")).distinct().join(nodes.select(F.col("id").alias("node"), F.col("rep").alias("id"), "d1", "d2"), "node")
    busy = materialize(busy, "busy")
    sets = shingle_sets(texts.join(bounded(busy.select("id").distinct()), "id", "left_semi"), k).join(bounded(busy), ["id", "d1", "d2"])
    sets = materialize(sets.select(F.col("node").alias("id"), "shingles").dropDuplicates(["id"]), "sets")
    signed = nodes.select("id", "sig")
    links = _tested(stars, signed, sets, bins, percent)
    tried = materialize(stars, "tried")
    joined = materialize(components(links.unionByName(_same_id(linkable, classes)), "a", "b"), "components")
    shared = shared.select("key", "id", "n")
    for turn in range(STAR_ROUNDS + 1):
        placed = shared.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        parts = placed.groupBy("key", "component").agg(F.count("*").alias("members"), F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "n")).alias("pick"))
        main = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("members", F.col("component").alias("main"), F.col("pick.id").alias("centre"), F.col("pick.n").alias("nc"))).alias("m")).filter("parts > 1").select("key", "m.main", "m.centre", "m.nc")
        main = materialize(main, "split")
        placed = materialize(placed.join(main, "key"), "placed")  # only buckets over several components go on
        shared = placed.select("key", "id", "n")
        outside = placed.filter("component <> main")
        if turn < STAR_ROUNDS:
            pairs = outside.filter(sized("n", "nc")).select(*_ordered("id", "centre")).distinct()
        else:
            pairs = _rest(placed.select("id", "component").distinct(), outside.select(F.col("id").alias("out")).distinct(), sets, percent)
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if not pairs.limit(1).count():
            continue
        new = _tested(pairs, signed, sets, bins, percent)
        tried = tried.unionByName(pairs)
        if new.limit(1).count():
            joined = _merged(joined, new)

    placed = classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    placed = materialize(placed.join(least, "component").select("d1", "d2", "component_id"), "placed")
    out = sigs.select("id", "n", "d1", "d2").join(placed, ["d1", "d2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def survivors(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose group keeps another document."""
    mine = fresh(docs, "gone")
    gone = materialize(near_groups(docs, k, percent, id_col, text_col).filter("not kept").select(F.col(id_col).alias(mine)).distinct(), "gone")
    return docs.join(bounded(gone), F.col(id_col).cast("long") == F.col(mine), "left_anti")
