"""Replay of conversations with faulty turns: quarantine, retries and release in order.

A conversation's turns, numbered ``p`` from 0 by turn, arrive at second ``7 p``.
Each may wait for a parent up to four turns earlier, may be faulty until it is
repaired, and is retried with doubling pauses. All chance comes from crc32 hashes
of conversation and turn, so a replay gives the same rows again.

Hashes and checksums are computed in the JVM, so that no text is shuffled or sent
to Python. Whole conversations then go, in buckets of some 2,000 turns, to grouped
pandas: one turn-ordered pass over the parent array computes attempts and delivery,
a stable lexsort by (delivery, turn) and cumulative sums give releases and states.

Conversations of more than ``longest`` turns never meet in one task. Their turns are
ranked over ranges of (conversation, turn) with a running count whose carries are a
row per range. They are cut into blocks of consecutive turns, and each block starts
with ``halo`` turns before it: parent chains are short, as every fifth turn has no
parent, so nearly all end within the halo. Blocks in which a chain goes further back
are replayed again with the results known so far, until none is left. Releases are
ranked and summed over ranges like the turns.

Defined results: rows that repeat conversation and turn are turns of their own, in the
order of their texts' crc32; null texts count as empty; rows without conversation or
turn belong to none and have null in every result column; states are sums modulo 2^64
(as signed longs); extra columns play no part, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Steps
from ._common import text_or_empty

#: Seconds between arrivals, first pause, most attempts.
ARRIVAL, PAUSE, ATTEMPTS = 7, 20, 6
DELIVERED, DEAD, BLOCKED, UNKNOWN = 0, 1, 2, 3
NAMES = ["delivered", "dead", "blocked"]
#: Turns in a bucket of conversations, and buckets for each shuffle partition at least.
BUCKET_TURNS, BUCKETS_EACH = 2000, 4
LONGEST = 50_000
HALO = 256
#: Ranges that turns of long conversations are dealt to, for each shuffle partition.
RANGES_EACH = 2
OFFSETS = [PAUSE * (2**a - 1) for a in range(ATTEMPTS)]


def _hash(k: int) -> Column:
    return F.crc32(F.concat(F.lit(f"{k}:"), F.col("conv").cast("string"), F.lit(":"), F.col("turn").cast("string")).cast("binary"))


def prepared(turns: DataFrame, conv_col: str, turn_col: str, text_col: str) -> DataFrame:
    """What the replay needs of each turn: distance of the parent, seconds to the
    repair (-1: not faulty), a bit for each attempt that fails by chance, crc32 of the text."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.crc32(text_or_empty(text_col).cast("binary")).alias("crc"))
    failing = sum((F.when(_hash(a + 2) % 3 == 0, 1 << (a - 1)).otherwise(0) for a in range(1, ATTEMPTS + 1)), F.lit(0))
    return rows.select("conv", "turn", "crc", (_hash(0) % 5).cast("int").alias("back"), F.when(_hash(1) % 101 < 50, (_hash(2) % 101).cast("int")).otherwise(-1).alias("repair"), failing.cast("int").alias("failing"))


def attempted(place, back, repair, failing, first, status=None, delivered=None):
    """Turn-ordered pass over the turns of one or more conversations.

    ``place`` is the turn's number in its conversation, ``first`` the row of the first
    turn at hand of its conversation. Given results (``status`` not UNKNOWN) stay.
    A turn whose parent is not at hand, or itself unknown, is UNKNOWN.
    """
    n = len(place)
    state = [UNKNOWN] * n if status is None else status.tolist()
    end = [0] * n if delivered is None else delivered.tolist()
    tries, begin = [0] * n, [0] * n
    for i, (p, d, r, bits, start) in enumerate(zip(place.tolist(), back.tolist(), repair.tolist(), failing.tolist(), first.tolist(), strict=True)):
        if state[i] != UNKNOWN:
            continue
        at = arrival = ARRIVAL * p
        if 0 < d <= p:
            parent = i - d
            if parent < start or state[parent] == UNKNOWN:
                continue
            if state[parent] != DELIVERED:
                state[i] = BLOCKED
                continue
            at = max(at, end[parent])
        begin[i] = at
        state[i], tries[i], end[i] = DELIVERED, 1, at
        if r >= 0:
            for a, later in enumerate(OFFSETS):
                tries[i], end[i] = a + 1, at + later
                if at + later >= arrival + r and not bits >> a & 1:
                    break
            else:
                state[i] = DEAD
    return np.array(state, np.int8), np.array(tries, np.int32), np.array(begin, np.int64), np.array(end, np.int64)


def _starts(key: np.ndarray) -> np.ndarray:
    """For each row the first row of its run of equal keys."""
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)


def _replay_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """All turns of some conversations, as columns of the result."""
    rows = rows.iloc[np.lexsort((rows["crc"], rows["turn"], rows["conv"]))]
    conv, turn, crc = (rows[c].to_numpy() for c in ("conv", "turn", "crc"))
    first = _starts(conv)
    place = np.arange(len(conv)) - first
    state, tries, begin, end = attempted(place, *(rows[c].to_numpy() for c in ("back", "repair", "failing")), first)
    release, total = np.zeros(len(conv), np.int64), np.zeros(len(conv), np.int64)
    out = np.flatnonzero(state == DELIVERED)
    out = out[np.lexsort((place[out], end[out], conv[out]))]  # stable, so turns with one number keep their order
    at = _starts(conv[out])
    release[out] = number = np.arange(len(out)) - at + 1
    sums = np.cumsum(number * crc[out])  # wraps like a long
    total[out] = sums - np.where(at > 0, sums[at - 1], 0)
    return _result(conv, turn, state, tries, begin, end, release, total)


def _result(conv, turn, state, tries, begin, end, release=None, total=None) -> pd.DataFrame:
    ran, done = state != BLOCKED, state == DELIVERED
    columns = {"conv": conv, "turn": turn, "status": np.array(NAMES, object)[state], "attempts": tries, "first_at": pd.array(np.where(ran, begin, 0), "Int64"), "last_at": pd.array(np.where(ran, end, 0), "Int64")}
    columns["first_at"][~ran] = columns["last_at"][~ran] = pd.NA
    if release is not None:
        columns |= {"release_no": pd.array(release, "Int64"), "state": pd.array(total, "Int64")}
        columns["release_no"][~done] = columns["state"][~done] = pd.NA
    return pd.DataFrame(columns)


_OUT = "conv long, turn long, status string, attempts int, first_at long, last_at long"


def _ranged(df: DataFrame, order: list[str], steps: Steps, name: str) -> DataFrame:
    """``df`` sorted over ranges of ``order``, written, with the number of its range."""
    ranges = RANGES_EACH * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())
    return steps.write(dealt, name)


def _carried(df: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per conversation and range, sums over its earlier ranges (a row for each range at most)."""
    parts = df.groupBy("conv", "range").agg(*(c.alias(k) for k, c in sums.items()))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("conv", "range", *sums, *(F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"before_{k}") for k in sums))


def _long(rows: DataFrame, steps: Steps, block: int, halo: int) -> DataFrame:
    """The replay of conversations that are too long for one task."""
    window = Window.partitionBy("range", "conv").orderBy("turn", "crc")
    dealt = _ranged(rows, ["conv", "turn", "crc"], steps, "turns")
    offset = _carried(dealt, {"n": F.count("*")}).select("conv", "range", "before_n")
    placed = dealt.withColumn("local", F.row_number().over(window)).join(offset, ["conv", "range"])
    placed = placed.select("conv", "turn", "crc", "back", "repair", "failing", (F.col("before_n") + F.col("local") - 1).alias("p"))
    placed = placed.withColumn("block", F.floor(F.col("p") / block))
    known = steps.write(placed.withColumns({"status": F.lit(UNKNOWN).cast("tinyint"), "tries": F.lit(0), "begin": F.lit(0).cast("long"), "end": F.lit(0).cast("long")}), "known")
    own = ("conv", "turn", "crc", "back", "repair", "failing", "p", "block", "status", "tries", "begin", "end")
    schema = known.select(*own).schema

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("p")
        n = len(rows)
        state, tries, begin, end = attempted(*(rows[c].to_numpy() for c in ("p", "back", "repair", "failing")), np.zeros(n, np.int64), rows["status"].to_numpy(), rows["end"].to_numpy())
        fresh = rows["status"].to_numpy() == UNKNOWN
        out = rows.assign(status=state, tries=np.where(fresh, tries, rows["tries"]).astype(np.int32), begin=np.where(fresh, begin, rows["begin"]), end=np.where(fresh, end, rows["end"]))
        return out.loc[out["block"] == out["job"], list(own)]

    while True:
        todo = known.filter(F.col("status") == UNKNOWN).select("conv", F.col("block").alias("job")).distinct()
        todo = steps.write(todo, "todo")
        if todo.isEmpty():
            break
        # a block's rows go to its own job, those among its last `halo` also to the next (a halo longer than a block: to more)
        reach = F.floor((F.col("p") + halo) / block)
        sent = known.withColumn("job", F.explode(F.sequence("block", reach))).join(todo.hint("shuffle_hash"), ["conv", "job"], "left_semi")
        done = sent.groupBy("conv", "job").applyInPandas(run, schema)
        kept = known.join(todo.withColumnRenamed("job", "block").hint("shuffle_hash"), ["conv", "block"], "left_anti").select(*own)
        known = steps.write(kept.unionByName(done), "known")

    delivered = known.filter(F.col("status") == DELIVERED).select("conv", "turn", "crc", "p", F.col("end").alias("last_at"))
    dealt = _ranged(delivered, ["conv", "last_at", "p"], steps, "released")
    inner = Window.partitionBy("range", "conv").orderBy("last_at", "p")
    wide = lambda c: c.cast("decimal(38,0)")
    local = steps.write(dealt.withColumn("local", F.row_number().over(inner).cast("long")), "released-local")
    parts = _carried(local, {"n": F.count("*"), "crcs": F.sum(wide(F.col("crc"))), "partial": F.sum(wide(F.col("local")) * F.col("crc"))})
    offset = parts.withColumn("own", F.col("partial") + F.col("before_n") * F.col("crcs"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offset = offset.select("conv", "range", "before_n", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before_state"))
    numbered = local.join(offset, ["conv", "range"]).withColumn("release_no", F.col("before_n") + F.col("local"))
    summed = F.col("before_state") + F.sum(wide(F.col("release_no")) * F.col("crc")).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.pmod(summed, F.lit("18446744073709551616").cast("decimal(38,0)"))
    signed = F.when(whole >= F.lit("9223372036854775808").cast("decimal(38,0)"), whole - F.lit("18446744073709551616").cast("decimal(38,0)")).otherwise(whole)
    releases = numbered.select("conv", "p", "release_no", signed.cast("long").alias("state"))
    status = F.element_at(F.array(*(F.lit(x) for x in NAMES)), F.col("status").cast("int") + 1)
    ran = F.col("status") != BLOCKED
    out = known.select("conv", "turn", "p", status.alias("status"), F.col("tries").alias("attempts"), F.when(ran, F.col("begin")).alias("first_at"), F.when(ran, F.col("end")).alias("last_at"))
    return out.join(releases, ["conv", "p"], "left").drop("p")


def replay(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", longest: int = LONGEST, block: int = 20_000, halo: int = HALO) -> DataFrame:
    """One row per turn: status, attempts, times of the first and last attempt, release and state."""
    spark = turns.sparkSession
    steps = Steps(spark)
    rows = steps.write(prepared(turns, conv_col, turn_col, text_col), "prepared")
    placed, lost = rows.filter("conv is not null and turn is not null"), rows.filter("conv is null or turn is null")
    sizes = placed.groupBy("conv").agg(F.count("*").alias("n"))
    long = steps.write(sizes.filter(F.col("n") > longest).select("conv"), "long")
    short, parts = placed, []
    if not long.isEmpty():
        short = placed.join(long.hint("merge"), "conv", "left_anti")
        parts.append(_long(placed.join(long.hint("merge"), "conv", "left_semi"), steps, block, halo))
    buckets = max(BUCKETS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_TURNS))
    bucketed = short.withColumn("bucket", F.pmod(F.xxhash64("conv"), F.lit(buckets)))
    parts.append(bucketed.groupBy("bucket").applyInPandas(_replay_bucket, f"{_OUT}, release_no long, state long"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("status", "string"), ("attempts", "int"), ("first_at", "long"), ("last_at", "long"), ("release_no", "long"), ("state", "long"))]
    parts.append(lost.select("conv", "turn", *nothing))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumnsRenamed({"conv": conv_col, "turn": turn_col})
