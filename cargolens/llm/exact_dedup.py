"""Exact deduplication with counting quotient filters.

1. Each text is normalised (runs of ASCII white space become one blank), and a
   64-bit fingerprint and its SHA-256 are taken in the JVM. These narrow rows
   are written once.
2. Each partition builds counting quotient filters from its fingerprints. The
   fingerprint's leading bits name a block and a quotient in it, the others are
   the remainder. A filter stores which quotients occur, where their runs of
   remainders end, the remainders in ascending order, and counters for those
   that occur more than once. Nothing of a fingerprint is lost.
3. The filters of a block merge by running through their sorted remainders and
   adding up counters. A filter holds each fingerprint once per partition
   however often it occurs, so a text that a third of all rows share costs one
   entry per partition. A large table's partitions have too few fingerprints for
   filters of single blocks; theirs are of wider blocks, and merges of some of
   them are cut into narrower ones, level by level (``block_plan``).
4. Fingerprints with a count above one route their rows to byte verification:
   rows are grouped by the normalised text itself, with partial aggregation, so
   that each partition sends a text once.

Defined results: null text counts as empty, and all empty texts are equal;
``keep_id`` is the least non-null id of the group (null if there is none); rows
with that id are ``kept`` (rows that repeat both id and text share the flag,
``survivors()`` leaves one of them); other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._common import bounded, fresh, text_or_empty

#: Fingerprints that one block of the merged filter holds on average.
ENTRIES_PER_BLOCK = 100_000
#: Fingerprints that a partition's filter of one block holds at least, on average.
ENTRIES_PER_FILTER = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


class QuotientFilter:
    """A static counting quotient filter over sorted 64-bit fingerprints.

    ``occupied`` has a bit for each quotient that occurs, ``run_end`` a bit for
    each remainder that ends its quotient's run; ``remainders`` are ascending
    within runs; ``extra`` lists (slot, count) for counts above one.
    """

    def __init__(self, quotient_bits: int, remainder_bits: int, occupied: np.ndarray, run_end: np.ndarray, remainders: np.ndarray, extra_slots: np.ndarray, extra_counts: np.ndarray):
        self.quotient_bits, self.remainder_bits = quotient_bits, remainder_bits
        self.occupied, self.run_end, self.remainders = occupied, run_end, remainders
        self.extra_slots, self.extra_counts = extra_slots, extra_counts

    @classmethod
    def build(cls, low: np.ndarray, counts: np.ndarray, remainder_bits: int, width: int) -> QuotientFilter:
        """From ascending distinct values of ``width`` bits (uint64) with their counts."""
        r = np.uint64(remainder_bits)
        quotients = (low >> r).astype(np.int64)
        occupied = np.zeros(1 << (width - remainder_bits), bool)
        occupied[quotients] = True
        run_end = np.ones(len(low), bool)
        run_end[:-1] = quotients[1:] != quotients[:-1]
        slots = np.flatnonzero(counts > 1)
        return cls(width - remainder_bits, remainder_bits, np.packbits(occupied), np.packbits(run_end), low & ((np.uint64(1) << r) - np.uint64(1)), slots, counts[slots])

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """The values and counts it was built from."""
        n = len(self.remainders)
        quotients = np.flatnonzero(np.unpackbits(self.occupied)).astype(np.uint64)
        ends = np.unpackbits(self.run_end)[:n].astype(np.int64)
        run = np.cumsum(ends) - ends
        counts = np.ones(n, np.int64)
        counts[self.extra_slots] = self.extra_counts
        return (quotients[run] << np.uint64(self.remainder_bits)) | self.remainders, counts

    def to_bytes(self) -> bytes:
        head = np.array([self.quotient_bits, self.remainder_bits, len(self.occupied), len(self.remainders), len(self.extra_slots)], "<i8")
        return b"".join(x.tobytes() for x in (head, self.occupied, self.run_end, self.remainders.astype("<u8"), self.extra_slots.astype("<i8"), self.extra_counts.astype("<i8")))

    @classmethod
    def from_bytes(cls, raw: bytes) -> QuotientFilter:
        q, r, n_occ, n, n_extra = np.frombuffer(raw, "<i8", 5).tolist()
        at = 40
        occupied = np.frombuffer(raw, np.uint8, n_occ, at)
        run_end = np.frombuffer(raw, np.uint8, (n + 7) // 8, at := at + n_occ)
        remainders = np.frombuffer(raw, "<u8", n, at := at + (n + 7) // 8)
        slots = np.frombuffer(raw, "<i8", n_extra, at := at + 8 * n)
        return cls(q, r, occupied, run_end, remainders, slots, np.frombuffer(raw, "<i8", n_extra, at + 8 * n_extra))


def merge(filters: list[QuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted remainders of all filters of a block, with counts added up."""
    parts = [f.items() for f in filters]
    values, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    starts = np.flatnonzero(first)
    return values[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _filters(values: np.ndarray, counts: np.ndarray, bits: int) -> tuple[list[int], list[bytes]]:
    """Blocks (the ``bits`` leading bits) of ascending fingerprints, and a filter for each."""
    width = 64 - bits
    blocks = (values >> np.uint64(width)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    names, filters = [], []
    for low, n, block in zip(np.split(values, cuts), np.split(counts, cuts), np.split(blocks, cuts), strict=True):
        if len(low):
            quotient_bits = max(3, int(len(low)).bit_length())
            names.append(int(block[0]))
            filters.append(QuotientFilter.build(low & np.uint64((1 << width) - 1), n, width - quotient_bits, width).to_bytes())
    return names, filters


def _merged(block: int, filters: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole fingerprints of a block's filters, ascending, and their counts."""
    values, counts = merge([QuotientFilter.from_bytes(f) for f in filters])
    return values | (np.uint64(block) << np.uint64(64 - bits) if bits else np.uint64(0)), counts


def _narrower(wide: int, narrow: int):
    """Merges some filters of a block of ``wide`` leading bits and cuts them into blocks of ``narrow`` ones."""

    def run(group: pa.Table) -> pa.Table:
        names, found = _filters(*_merged(group.column("block")[0].as_py(), group.column("filter").to_pylist(), wide), narrow)
        part = group.column("part")[0].as_py()
        return pa.table({"block": pa.array(names, pa.int64()), "part": pa.array([part] * len(names), pa.int64()), "filter": pa.array(found, pa.binary())})

    return run


def block_plan(n_rows: int, partitions: int) -> tuple[list[int], int]:
    """Leading bits of the blocks level by level, and how many filters a merge before the last takes.

    Blocks of the last level have ``ENTRIES_PER_BLOCK`` fingerprints. A partition of a
    large table has far fewer than one for each of them, so its filters are those of
    wider blocks, of ``ENTRIES_PER_FILTER``; merging some of them and cutting the result
    into narrower blocks comes in between."""
    last = max(0, min(40, math.ceil(math.log2(max(1, n_rows / ENTRIES_PER_BLOCK)))))
    together = max(2, ENTRIES_PER_BLOCK // ENTRIES_PER_FILTER)
    bits = [min(last, max(0, int(math.log2(max(1, n_rows / max(1, partitions) / ENTRIES_PER_FILTER)))))]
    while bits[-1] < last:
        bits.append(min(last, bits[-1] + int(math.log2(together))))
    return bits, together


def repeated_fingerprints(prints: DataFrame, column: str = "fp") -> DataFrame:
    """Fingerprints (column ``fp``) that occur more than once in ``prints``, with their counts."""
    row = prints.select(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.max("p").alias("p")).first()
    bits, together = block_plan(row["n"], (row["p"] or 0) + 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.unique(b.column(0).to_numpy().view(np.uint64), return_counts=True) for b in batches if b.num_rows]
        if not parts:
            return
        values, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
        names, filters = _filters(values, counts, bits[0])
        here = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([here] * len(names), pa.int64()), pa.array(filters, pa.binary())], names=["block", "part", "filter"])

    filters = prints.select(F.col(column).cast("long").alias("fp")).mapInArrow(build, "block long, part long, filter binary")
    for wide, narrow in zip(bits, bits[1:], strict=False):
        filters = filters.withColumn("part", F.floor(F.col("part") / together).cast("long")).groupBy("block", "part").applyInArrow(_narrower(wide, narrow), "block long, part long, filter binary")

    def repeated(group: pa.Table) -> pa.Table:
        values, counts = _merged(group.column("block")[0].as_py(), group.column("filter").to_pylist(), bits[-1])
        often = counts > 1
        return pa.table({"fp": pa.array(values[often].view(np.int64)), "copies": pa.array(counts[often])})

    return filters.select("block", "filter").groupBy("block").applyInArrow(repeated, "fp long, copies long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = normalised(text_or_empty(text_col))
    return docs.select(F.col(id_col).cast("long").alias(id_col), text.alias("norm")).select(id_col, F.xxhash64("norm").alias("fp"), F.sha2("norm", 256).alias("text_sha256"), "norm")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    wide = fingerprints(docs, id_col, text_col)
    narrow = materialize(wide.drop("norm"), "prints")
    repeated = materialize(repeated_fingerprints(narrow), "repeated").select("fp")
    candidates = wide.join(bounded(repeated), "fp", "left_semi")
    verified = candidates.groupBy("fp", "norm").agg(F.min(id_col).alias("keep_id"), F.count("*").alias("group_size"))
    verified = verified.filter("group_size > 1").select("fp", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    verified = materialize(verified, "verified")
    out = narrow.join(verified, ["fp", "text_sha256"], "left")
    out = out.withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id")))
    return out.select(
        id_col,
        "keep_id",
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with one row left of each group of equal texts."""
    verdict = materialize(groups(docs, id_col, text_col).filter("group_size > 1"), "verdict")
    dropped = verdict.filter(~F.col("kept")).select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    sha = fresh(docs, "sha")
    out = docs.withColumn(sha, F.sha2(normalised(text_or_empty(text_col)), 256))
    gone = bounded(dropped)
    left = out.join(gone, (out[sha] == gone["_sha"]) & out[id_col].cast("long").eqNullSafe(gone["_id"]), "left_anti")
    again = verdict.filter("kept").groupBy(id_col, "text_sha256").count().filter("count > 1").select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha"))
    if again.limit(1).count():  # rows that repeat both id and text
        again = bounded(materialize(again, "again"))
        same = (left[sha] == again["_sha"]) & left[id_col].cast("long").eqNullSafe(again["_id"])
        once = left.join(again, same, "left_semi").dropDuplicates([id_col, sha])
        left = left.join(again, same, "left_anti").unionByName(once)
    return left.select(*docs.columns)
