"""Exact n-gram Jaccard join with R-trees over count vectors.

Shingles are hashed into groups. The counts of a set's groups are a point, and the
summed minima of two points' coordinates bound the overlap of their sets; so does,
for all points below a node of an R-tree, the sum with the node's greatest coordinates.
Only pairs that the bound leaves are verified, on the full sets, which are only sent to
where such pairs are.

A single tree over all points would pass through one task. The directory above the
trees is therefore an equi-join that loses nothing: two sets that link differ in at
most r shingles, so of r + 1 groups at least one has the same content in both. Sets are
dealt by (size class, group, digest of its content), and each such shard gets its own
tree. The number of groups follows from the size class; a set also visits the classes
of smaller partners. Empty groups would bring strangers together: SPARE more groups
are cut, and only sets with more empty groups than that are dealt by them (if a set
has no more, one that is not empty agrees as well).

Links are only sought between components. The groups are gone through in slices; after
each the components are merged, and only shards that still hold two of them go on, so
that a family of near copies does its work once and not in every group. Of shards with
the same members one is enough, over all slices. Within a task
links are found with the sets at hand and components are merged on the way: a shard
gives fewer links than it has members, and no pairs are written. Shards of more than a
page are split: first each page is joined with itself and one common member, then what
is still outside the shard's largest component is joined with all pages, in jobs of
bounded size.

Defined results: null and blank texts have an empty set and link with nothing; fewer
words than the shingle length make one shingle; rows without id are never linked; rows
that repeat an id are one document, linked with all that any of their texts is linked
with; extra columns play no part, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph.components import components
from ..session import Steps
from ._common import bounded, map_arrow, text_or_empty
from .near_dedup import _digest, _merged, _mixed, _same_id, shingle_set, shingle_sets

#: Size classes grow by this factor.
CLASS_RATIO = 1.5
#: Groups beyond r + 1, against strangers that share an empty group.
SPARE = 2
#: Groups up to which a slice goes; the last slice takes the rest.
SLICES = (2, 10)
#: Members and shingles of a page.
PAGE_MEMBERS, PAGE_SHINGLES = 4000, 2_000_000
FANOUT = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_S32 = np.uint64(32)


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Least overlap of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


@lru_cache(maxsize=8)
def size_classes(percent: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower ends of the classes up to size ``most``, and the groups of each (0: only equal sets link)."""
    ends = [1]
    while ends[-1] <= most:
        ends.append(max(ends[-1] + 1, int(ends[-1] * CLASS_RATIO)))
    greatest = np.array(ends[1:]) - 1
    apart = (greatest + 100 * greatest // percent) * (100 - percent) // (100 + percent)
    return np.array(ends[:-1]), np.where(apart > 0, apart + 1 + SPARE, 0)


def group_keys(s: np.ndarray, percent: int) -> list[np.ndarray]:
    """For each size class that the set takes part in, a key per group (0 where an empty group is passed over)."""
    lows, groups = size_classes(percent, 1 << max(4, int(len(s)).bit_length()))
    own = int(np.searchsorted(lows, len(s), "right")) - 1
    first = int(np.searchsorted(lows, max(1, -(-len(s) * percent // 100)), "right")) - 1
    out = []
    mixed = _mixed(s * _MIX)
    for c in range(own, first - 1, -1):
        g = int(groups[c])
        if not g:
            continue
        of = ((s >> _S32) * np.uint64(g)) >> _S32  # the set ascends, so groups are runs
        there, begin = np.unique(of, return_index=True)
        digest = np.zeros(g, np.uint64)
        digest[there.astype(np.int64)] = np.add.reduceat(mixed, begin)
        seed = np.arange(g, dtype=np.uint64) + np.uint64(c << 32)
        keys = _mixed(_mixed(digest * _MIX + seed) * _MIX)
        if g - len(there) <= SPARE:
            empty = np.ones(g, bool)
            empty[there.astype(np.int64)] = False
            keys[empty] = 0
        out.append(keys)
    return out


def keyed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (id, text): set size, 128-bit digest of the set, group counts, keys in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], []]
            counts: list[bytes | None] = []
            slices: list[list] = [[] for _ in range(len(SLICES) + 1)]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, k)
                for c, x in zip(cols, (len(s), *_digest(s.tobytes())), strict=True):
                    c.append(x)
                keys = group_keys(s, percent) if len(s) else []
                counts.append(packed(count_vector(s)) if keys else None)
                for own, low, high in zip(slices, (0, *SLICES), (*SLICES, None), strict=True):
                    cut = [x[low:high] for x in keys]
                    cut = np.concatenate(cut) if cut else np.empty(0, np.uint64)
                    own.append(cut[cut != 0].view(np.int64))
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in cols), pa.array(counts, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in slices)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "d1", "d2", "counts", *(f"keys{i}" for i in range(len(slices)))])

    keys = ", ".join(f"keys{i} array<long>" for i in range(len(SLICES) + 1))
    return map_arrow(docs.select("id", "text"), run, f"id long, n long, d1 long, d2 long, counts binary, {keys}")


# -- the tree of one page -----------------------------------------------------


def count_vector(s: np.ndarray) -> np.ndarray:
    """Counts of the set's shingles in about half as many groups; halves of the vector add
    up to the counts in half as many groups."""
    width = 1 << min(10, max(4, (len(s) // 2).bit_length()))
    return np.bincount((_mixed(s * _MIX) & np.uint64(width - 1)).astype(np.int64), minlength=width)


def packed(counts: np.ndarray) -> bytes:
    """The width's logarithm, then the counts in one byte each, or in four if one doesn't fit."""
    return bytes([len(counts).bit_length() - 1]) + counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    width = 1 << raw[0]
    return np.frombuffer(raw, np.uint8 if len(raw) == width + 1 else np.uint32, offset=1).astype(np.uint32)


def points_of(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors folded to the least of their widths, as rows."""
    width = min(map(len, vectors))
    return np.stack([v.reshape(-1, width).sum(axis=0) for v in vectors]).astype(np.uint32)


class RTree:
    """Packed R-tree over count vectors: leaves by splitting the widest coordinate at its
    median, nodes over FANOUT neighbours with the greatest coordinates and the range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = np.array(self._packed(np.arange(len(points))), np.int64)
        high, least, most = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = []  # from the leaves up
        while len(high) > FANOUT:
            cut = np.arange(0, len(high), FANOUT)
            high, least, most = (f.reduceat(x, cut, axis=0) for f, x in ((np.maximum, high), (np.minimum, least), (np.maximum, most)))
            self.levels.append((high, least, most))

    def _packed(self, rows: np.ndarray) -> list[int]:
        stack, out = [rows], []
        while stack:
            rows = stack.pop()
            if len(rows) <= FANOUT:
                out.extend(rows.tolist())
                continue
            own = self.points[rows]
            spread = own.max(axis=0).astype(np.int64) - own.min(axis=0)
            by = own[:, int(spread.argmax())] if spread.max() * 4 >= np.ptp(self.sizes[rows]) else self.sizes[rows]
            half = -(-len(rows) // (2 * FANOUT)) * FANOUT  # leaves stay full
            at = np.argpartition(by, half)
            stack += [rows[at[half:]], rows[at[:half]]]
        return out

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Rows whose sets may link with a set of this point and size."""
        least, most = -(-percent * size // 100), 100 * size // percent
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.order))
        for depth in range(len(self.levels) - 1, -2, -1):
            if depth < 0:
                rows = self.order[at]
                high, low, up = self.points[rows], self.sizes[rows], self.sizes[rows]
            else:
                high, low, up = (x[at] for x in self.levels[depth])
            bound = np.minimum(high, point).sum(axis=1, dtype=np.int64)
            at = at[(low <= most) & (up >= least) & (bound >= needed(size, np.maximum(low, least), percent))]
            if depth < 0:
                return self.order[at]
            if not len(at):
                return at
            below = len(self.levels[depth - 1][0]) if depth else len(self.order)
            at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            at = at[at < below]
        return at


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0
    return both >= needed(len(x), len(y), percent) and both > 0


def page_links(ids: list[int], sets: list[np.ndarray], groups: list[int], asks: np.ndarray, answers: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between rows that ask and rows that answer, so many that every pair of them
    that links ends in one component. ``groups`` are the components known so far; the
    first row asks first."""
    names = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    group = np.array([names[g] for g in groups])
    count = len(names)
    targets = np.flatnonzero(answers)
    points, sizes = points_of([count_vector(s) for s in sets]), np.array([len(s) for s in sets])
    tree, out = RTree(points[targets], sizes[targets]), []

    def ask(i: int) -> int:
        merged = 0
        found = targets[tree.search(points[i], int(sizes[i]), percent)]
        for j in found[group[found] != group[i]].tolist():
            if group[j] != group[i] and linked(sets[i], sets[j], percent):
                group[group == group[j]] = group[i]
                out.append((ids[i], ids[j]))
                merged += 1
        return merged

    count -= ask(0) if asks[0] else 0
    rest = np.flatnonzero(asks)
    if asks.all():  # pairs with the largest component are asked for from the other side
        largest = np.bincount(group[targets]).argmax()
        rest = rest[group[rest] != largest] if answers[1:].all() else rest
    for i in rest.tolist():
        if count == 1:
            break
        count -= ask(i) if i else 0
    return out


def page_candidates(vectors: list[np.ndarray], groups: list[int], asks: np.ndarray, answers: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have a partner of another component that the bound leaves."""
    names = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    group = np.array([names[g] for g in groups])
    targets = np.flatnonzero(answers)
    points, sizes = points_of(vectors), np.array([int(v.sum()) for v in vectors])
    tree, alive = RTree(points[targets], sizes[targets]), np.zeros(len(vectors), bool)
    for i in np.flatnonzero(asks).tolist():
        if alive.all():
            break
        found = targets[tree.search(points[i], int(sizes[i]), percent)]
        found = found[group[found] != group[i]]
        if len(found):
            alive[found] = alive[i] = True
    return alive


def _by_job(rows: DataFrame, last: str, fn: Callable[[str, list[tuple]], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over the rows (id, component, ask, answer, ``last``) of each job; those that only ask come first."""
    dealt = rows.repartition("job").sortWithinPartitions("job", F.desc("ask"), F.asc("answer"), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, held = None, []
        for batch in batches:
            for this, *row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if this != job and held:
                    yield fn(job, held)
                    held = []
                job = this
                held.append(tuple(row))
        if held:
            yield fn(job, held)

    return map_arrow(dealt.select("job", "id", "component", "ask", "answer", last), run, schema)


_JOBS = "job string, id long, component long, ask boolean, answer boolean"


def _promising(rows: DataFrame, percent: int) -> DataFrame:
    """Rows of each job that the bound leaves a partner; of jobs that are then alike, one."""

    def run(job: str, held: list[tuple]) -> pa.RecordBatch:
        ids, groups, asks, answers, counts = zip(*held, strict=True)
        alive = page_candidates([unpacked(c) for c in counts], list(groups), np.array(asks), np.array(answers), percent)
        arrays = [pa.array([job] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(groups, pa.int64()), pa.array(asks, pa.bool_()), pa.array(answers, pa.bool_())]
        return pa.RecordBatch.from_arrays(arrays, names=["job", "id", "component", "ask", "answer"]).filter(pa.array(alive))

    return _by_job(rows, "counts", run, _JOBS)


def _joined_pages(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in each job."""

    def run(_: str, held: list[tuple]) -> pa.RecordBatch:
        ids, groups, asks, answers, shingles = zip(*held, strict=True)
        links = page_links(list(ids), [np.frombuffer(s, np.uint64) for s in shingles], list(groups), np.array(asks), np.array(answers), percent)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return _by_job(rows, "shingles", run, "a long, b long")


# -- the join -----------------------------------------------------------------


def _paged(members: DataFrame) -> DataFrame:
    """Members with their page in the shard."""
    return members.withColumn("page", F.pmod(F.xxhash64("id"), F.col("pages")))


def _first_jobs(members: DataFrame) -> DataFrame:
    """Each page with itself and the shard's least member."""
    own = _paged(members).select("key", F.col("page").alias("p"), "id", "component", F.lit(True).alias("ask"), F.lit(True).alias("answer"))
    centre = members.filter("pages > 1 and id = centre").withColumn("own", F.pmod(F.xxhash64("id"), F.col("pages")))
    centre = centre.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)).alias("p"), "id", "component", F.lit(True).alias("ask"), F.lit(False).alias("answer"), "own").filter("p <> own").drop("own")
    return own.unionByName(centre).select(F.concat_ws(":", "key", "p").alias("job"), "id", "component", "ask", "answer")


def _last_jobs(members: DataFrame, steps: Steps) -> DataFrame:
    """All pages of split shards with what is outside their largest component."""
    parts = members.groupBy("key", "component").agg(F.count("*").alias("c"))
    sums = parts.groupBy("key").agg(F.max(F.struct("c", "component")).alias("main"), F.sum("c").alias("m"))
    sums = sums.select("key", F.col("main.component").alias("main"), (F.col("m") - F.col("main.c")).alias("outside")).filter("outside > 0")
    rows = steps.write(_paged(members).join(sums, "key").withColumn("turns", F.ceil(F.col("outside") / PAGE_MEMBERS)), "outside")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    asks = rows.filter("component <> main").withColumn("t", F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns"))).withColumn("p", upto("pages")).withColumns({"ask": F.lit(True), "answer": F.lit(False)})
    answers = rows.withColumn("p", F.col("page")).withColumn("t", upto("turns")).withColumns({"ask": F.lit(False), "answer": F.lit(True)})
    job = F.concat_ws(":", "key", "p", "t").alias("job")
    return asks.select(job, "id", "component", "ask", "answer").unionByName(answers.select(job, "id", "component", "ask", "answer"))


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``n_shingles`` and ``component_id``, the least id reachable by links."""
    steps = Steps(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    rows = steps.write(keyed(texts, k, percent), "keyed")
    linkable = rows.filter("id is not null and n > 0")
    classes = linkable.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    classes = steps.write(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    slices = [f"keys{i}" for i in range(len(SLICES) + 1)]
    nodes = linkable.filter(F.size(slices[0]) > 0).join(classes, ["d1", "d2"]).filter("id = rep").dropDuplicates(["node"])
    nodes = steps.write(nodes.select(F.col("node").alias("id"), "rep", "d1", "d2", "n", "counts", *slices), "nodes")
    joined = steps.write(components(_same_id(linkable, classes), "a", "b"), "components")

    def placed(members: DataFrame) -> DataFrame:
        return members.join(bounded(joined.withColumnRenamed("node", "id")), "id", "left").withColumn("component", F.coalesce("component", "id"))

    def linked_in(jobs: DataFrame) -> bool:
        """Runs the jobs and merges components; whether there were any links."""
        nonlocal joined
        jobs = steps.write(_promising(nodes.select("id", "counts").join(bounded(steps.write(jobs, "jobs")), "id"), percent), "promising")
        alike = jobs.groupBy("job").agg(F.count("*").alias("m"), F.sum(F.xxhash64("id", "ask", "answer").cast("decimal(38,0)")).alias("sum")).groupBy("m", "sum").agg(F.min("job").alias("job"))
        jobs = steps.write(jobs.join(alike.select("job"), "job", "left_semi"), "jobs")
        ids = steps.write(jobs.select("id").distinct().join(nodes.select("id", "rep", "d1", "d2"), "id").withColumnsRenamed({"id": "node", "rep": "id"}), "busy")
        sets = shingle_sets(texts.join(bounded(ids.select("id").distinct()), "id", "left_semi"), k).join(bounded(ids), ["id", "d1", "d2"])
        sets = steps.write(sets.select(F.col("node").alias("id"), "shingles").dropDuplicates(["id"]), "sets")
        links = steps.write(_joined_pages(sets.join(bounded(jobs), "id"), percent), "links")
        steps.drop("jobs", "promising", "busy", "sets")
        if links.isEmpty():
            return False
        joined = steps.write(_merged(joined, links), "components")
        return True

    tested = None  # signatures of the members of shards that are done
    for turn, keys in enumerate(slices):
        rows_of = placed(nodes.select("id", "n", keys)).select("id", "n", "component", F.explode(keys).alias("key"))
        several = rows_of.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
        members = steps.write(rows_of.join(bounded(steps.write(several, "several")), "key"), "members")
        shards = members.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("load"), F.min("id").alias("centre"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"))
        shards = shards.groupBy("m", "load", "sum").agg(F.min(F.struct("key", "centre")).alias("one")).select("one.*", "m", "load", "sum")  # many have the same members
        shards = shards if tested is None else shards.join(tested, ["m", "load", "sum"], "left_anti")
        shards = steps.write(shards, f"shards{turn}")
        tested = shards.select("m", "load", "sum") if tested is None else tested.unionByName(shards.select("m", "load", "sum"))
        pages = F.greatest(F.ceil(F.col("m") / PAGE_MEMBERS), F.ceil(F.col("load") / PAGE_SHINGLES))
        members = steps.write(members.join(bounded(shards.select("key", "centre", pages.alias("pages"))), "key"), "members")
        if members.isEmpty():
            continue
        linked_in(_first_jobs(members))
        split = members.filter("pages > 1")
        if not split.isEmpty():
            linked_in(_last_jobs(placed(split.drop("component")), steps))
    steps.drop("members", "several", "outside", "nodes")

    found = classes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = steps.write(found.join(least, "component").select("d1", "d2", "component_id"), "placed")
    out = rows.select("id", "n", "d1", "d2").join(found, ["d1", "d2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
