"""Nearest neighbours over vector properties by neighbour descent.

A node's neighbours are likely to be each other's. The search starts from random
groups, within which all pairs are compared, and keeps the best ``k`` of each node. In
a round each node's neighbourhood, a sample of those it lists and of those that list
it, is brought together and its pairs are compared if one of them is new there; random
groups are compared as well, against local ends. Only pairs better than what a node has
leave the task. The search ends when fewer than ``delta`` of all places changed.

All choices are hashes of ids, round and seed, so a search gives the same result on any
number of tasks. Work grows with the nodes: groups are of ``GROUP`` nodes, a
neighbourhood has at most four samples.

Defined results: rows whose vector is null, empty or has a null, NaN or infinite value
have no neighbours; so have those of another length than the least id's; of rows that
repeat an id the least vector counts; ties go to the least id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Steps

#: Nodes of a random group, and neighbourhoods that go to a task's Python at once.
GROUP, AT_ONCE = 96, 64
#: Scores that are computed at once.
CELLS = 1 << 20
ROUNDS = 30


def _alike(v: np.ndarray, metric: str) -> np.ndarray:
    """How alike the vectors (the last two axes) of each place are."""
    if metric == "COSINE":  # from 0 (opposite) to 1
        size = np.linalg.norm(v, axis=-1, keepdims=True)
        unit = v / np.where(size > 0, size, 1)
        return (1 + unit @ unit.swapaxes(-1, -2)) / 2
    square = (v * v).sum(axis=-1)
    return 1 / (1 + np.sqrt(np.maximum(0, square[..., :, None] + square[..., None, :] - 2 * v @ v.swapaxes(-1, -2))))


def _compared(rows: pa.Table, metric: str, k: int) -> pa.Table:
    """Pairs of each place's nodes that are better than the floors of their ends: columns src, dst, score. Places
    of about the same size are compared at once."""
    place, ids, floor = (rows.column(c).to_numpy() for c in ("place", "id", "floor"))
    fresh = rows.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
    order = np.lexsort((~fresh, ids, place))  # of a node that is there twice the fresh row counts
    new = np.r_[True, (place[order][1:] != place[order][:-1]) | (ids[order][1:] != ids[order][:-1])] if len(order) else np.zeros(0, bool)
    order = order[new]
    starts = np.flatnonzero(np.r_[True, place[order][1:] != place[order][:-1]]) if len(order) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(order)))
    by_size = np.argsort(sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 1]
    vectors, out = rows.column("v").combine_chunks(), []
    if len(by_size):
        values = vectors.flatten().to_numpy().astype(np.float64).reshape(len(vectors), -1)
    at = 0
    while at < len(by_size):
        to = at + 1  # as many places as fit, filled up to the size of the largest
        while to < len(by_size) and (to - at + 1) * int(sizes[by_size[to]]) ** 2 <= CELLS:
            to += 1
        chosen, m = by_size[at:to], int(sizes[by_size[to - 1]])
        at = to
        seat = np.arange(m)
        real = seat < sizes[chosen][:, None]
        row = order[np.where(real, starts[chosen][:, None] + seat, 0)]
        # scores are rounded, so that they do not depend on the order of a sum
        alike = np.round(_alike(values[row], metric), 9)
        good = real[:, :, None] & real[:, None, :] & (seat[:, None] != seat) & (fresh[row][:, :, None] | fresh[row][:, None, :]) & (alike >= floor[row][:, :, None])
        if m > k + 1:  # no more than k of a place can be among a node's best
            good &= alike >= -np.partition(-np.where(good, alike, -2.0), k, axis=2)[:, :, k : k + 1]
        place_, i, j = np.nonzero(good)
        out.append((ids[row[place_, i]], ids[row[place_, j]], alike[place_, i, j]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    return pa.table(dict(zip(("src", "dst", "score"), columns, strict=True)))


def _best(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy(F.desc("score"), "dst")
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _run(members: DataFrame, metric: str, k: int, buckets: int) -> DataFrame:
    """``members``: (place, id, v, floor, fresh)."""
    dealt = members.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(lambda rows: _compared(rows, metric, k), "src long, dst long, score double")


def nearest(nodes: DataFrame, vector: str, k: int = 14, metric: str = "COSINE", id_col: str = "id", sample: float = 0.5, delta: float = 0.001, rounds: int = ROUNDS, seed: int = 42) -> DataFrame:
    """``(src, dst, score, rank)``: the ``k`` nearest nodes found for each node (ids as longs)."""
    steps = Steps(nodes.sparkSession)
    kept = "array<float>" if dict(nodes.dtypes)[vector] == "array<float>" else "array<double>"  # half the bytes to send, the same numbers
    rows = nodes.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast(kept).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine).groupBy("id").agg(F.min("v").alias("v"))
    rows = steps.write(rows, "vectors")
    first = rows.orderBy("id").limit(1).collect()
    if first:
        rows = rows.filter(F.size("v") == len(first[0]["v"]))
    count = rows.count()
    groups = max(1, -(-count // GROUP))
    buckets = max(8, count // AT_ONCE)
    taken = max(1, int(np.ceil(sample * k)))

    def random_groups(floors: DataFrame | None, turn: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id", F.lit(seed), F.lit(turn)), F.lit(groups))
        floor = F.lit(-1.0) if floors is None else F.coalesce("floor", F.lit(-1.0))
        own = rows if floors is None else rows.join(floors, "id", "left")
        return own.select((-1 - place).alias("place"), "id", "v", floor.alias("floor"), F.lit(True).alias("fresh"))

    now = steps.write(_best(_run(random_groups(None, 0), metric, k, buckets), k).withColumn("fresh", F.lit(True)), "neighbours")
    for turn in range(1, rounds + 1):
        floors = steps.write(now.groupBy(F.col("src").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-1.0).alias("floor")), "floors")
        # new neighbours take part once; which ones now, a hash says
        picked = F.pmod(F.xxhash64("src", "dst", F.lit(seed), F.lit(turn)), F.lit(1000)) < int(1000 * sample)
        now = now.withColumn("now", F.col("fresh") & picked)
        listed = now.select(F.col("src").alias("place"), F.col("dst").alias("id"), F.col("now").alias("fresh"), F.lit(0).alias("way")).unionByName(now.select(F.col("dst").alias("place"), F.col("src").alias("id"), F.col("now").alias("fresh"), F.lit(1).alias("way")))
        order = Window.partitionBy("place", "way", "fresh").orderBy(F.xxhash64("place", "id", F.lit(turn)), "id")
        few = listed.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= taken).select("place", "id", "fresh")
        hood = few.join(rows, "id").join(floors, "id", "left").select("place", "id", "v", F.coalesce("floor", F.lit(-1.0)).alias("floor"), "fresh")
        found = _run(hood.unionByName(random_groups(floors, turn)), metric, k, buckets)
        old = now.select("src", "dst", "score", (F.col("fresh") & ~F.col("now")).alias("fresh"), F.lit(True).alias("old"))
        both = old.unionByName(found.select("src", "dst", "score", F.lit(True).alias("fresh"), F.lit(False).alias("old")))
        one = both.groupBy("src", "dst").agg(F.max("score").alias("score"), F.max("old").alias("old"), F.min(F.when(F.col("old"), F.col("fresh"))).alias("kept"))
        best = _best(one, k).select("src", "dst", "score", "rank", F.coalesce("kept", F.lit(True)).alias("fresh"), "old")
        now = steps.write(best, "neighbours")
        changed = now.filter("not old").count()
        now = now.drop("old")
        if changed <= delta * k * count:
            break
    return now.select("src", "dst", "score", F.col("rank").cast("int").alias("rank"))
