"""Best-fit-decreasing packing of token sequences into bins of fixed capacity.

The tokens of a document are cut into pieces of at most ``capacity``; only
longer documents are cut, and it is the first piece that is short. Pieces are
then packed, longest first, each into the open bin with the least room that
still takes it.

Best fit only looks at lengths, and there are at most ``capacity`` of them. So
the plan is made from the histogram of lengths, whose size does not depend on
the data: bins with the same room are kept as ranges of bin numbers, and a
segment tree over the rooms 0..capacity finds the tightest one in logarithmic
time. A run of equal pieces that goes to bins of equal room is placed in one
step; the outcome is the one that placing them singly would have. The plan says
where the pieces of a length with ranks i..j go, and each piece finds its place
from its own rank. Ranks are counted within (length, salt), so that a length
that a third of all pieces share is ranked by many tasks.

Defined results: null text counts as empty and packs as its end mark alone;
repeated rows are packed each by itself; a text of any length is packed whole;
rows without id are packed as well; columns other than id and text are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ._common import map_arrow, text_or_empty
from .bpe import SPLIT, _Chunks, read_vocabulary

#: Pieces that one (length, salt) group has on average, were all lengths alike.
PIECES_PER_SALT = 200_000
MIN_SALTS = 64


class RoomTree:
    """Segment tree over rooms: which rooms have an open bin."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, room: int, there: bool) -> None:
        i = room + self.size
        self.any[i] = there
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int:
        """The smallest room of at least ``least`` that has a bin, or -1."""
        i = least + self.size
        if self.any[i]:
            return least
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Placements ``(length, first rank, first bin, pieces in each bin, offset)``.

    Pieces of a length with ranks from ``first rank`` up to the next
    placement's go ``pieces in each bin`` at a time into ``first bin`` and the
    following ones, from ``offset`` on.
    """
    tree, open_bins = RoomTree(capacity), {}
    placed, next_bin = [], 0

    def put(room: int, start: int, n: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((start, n))
            tree.set(room, True)

    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, each = capacity, capacity // length
                start, n = next_bin, -(-left // each)
                next_bin += n
            else:
                ranges = open_bins[room]
                start, n = ranges.pop()
                if not ranges:
                    del open_bins[room]
                    tree.set(room, False)
                each = room // length
            full = min(n, left // each)
            placed.append((length, rank, start, each, capacity - room))
            put(room - each * length, start, full)
            taken = full * each
            if full < n and (rest := min(left - taken, each)):
                put(room - rest * length, start + full, 1)
                put(room, start + full + 1, n - full - 1)
                taken += rest
            else:
                put(room, start + full, n - full)
            left -= taken
            rank += taken
    return placed


class _Encoder:
    """Ids as the vocabulary file gives them; words out of the cache go to a compiled encoder."""

    def __init__(self, path: str):
        labels, self.special, _ = read_vocabulary(path, with_merges=False)
        ranks = {b: i for i, b in labels.items()}
        self.words = tiktoken.Encoding("pack", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.chunks = _Chunks(self._ids)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.straddles = re.compile(r"\s \s|\s $")

    def _ids(self, chunk: str) -> bytes:
        return np.array(self.words.encode_ordinary(chunk), "<u4").tobytes()

    def plain(self, text: str) -> bytes:
        if self.straddles.search(text):
            return self._ids(text)
        first, *rest = text.split(" ")
        return b"".join([self.chunks[first] if first else b"", *map(self.chunks.__getitem__, [" " + c for c in rest])])

    def __call__(self, text: str) -> bytes:
        if self.cut and any(s in text for s in self.special):
            return b"".join(np.uint32(self.special[p]).astype("<u4").tobytes() if p in self.special else self.plain(p) for p in self.cut.split(text))
        return self.plain(text) if text else b""


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: id, piece number, start, length, crc32 of its ids (and the ids)."""
    schema = f"{id_col} long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = encode(text) + end
                n = len(raw) // 4
                at, k = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    part = raw[4 * at : 4 * (at + size)]
                    row = (doc, k, at, size, zlib.crc32(part))
                    out.append((*row, np.frombuffer(part, "<u4").tolist()) if with_ids else row)
                    at, k = at + size, k + 1
            cols = list(zip(*out, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = [id_col, "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=False)], names=names[: len(cols)])

    return map_arrow(docs.select(F.col(id_col).cast("long").alias(id_col), text_or_empty(text_col).alias("text")), run, schema)


def pack(cut: DataFrame, capacity: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of ``pieces()``."""
    cut = materialize(cut, "pieces")
    total = cut.count()
    salts = max(MIN_SALTS, total // PIECES_PER_SALT)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)))
    counts = materialize(salted.groupBy("length", "_salt").count(), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `capacity` rows
    before = counts.select("length", "_salt", (F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).alias("_before"))
    ranked = salted.withColumn("_k", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(id_col, "piece")) - 1)
    ranked = ranked.join(before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_k"))

    places = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    order = np.lexsort((places[:, 1], places[:, 0]))
    places = places[order]
    names = ranked.columns
    keep = cut.columns
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    big = np.int64(1) << 44
    keys = places[:, 0] * big + places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("_rank")).to_numpy()
            row = places[np.searchsorted(keys, length * big + rank, "right") - 1]
            k = rank - row[:, 1]
            bins, at = row[:, 2] + k // row[:, 3], row[:, 4] + k % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in keep), pa.array(bins), pa.array(at)], names=[*keep, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)
