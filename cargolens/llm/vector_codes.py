"""Product codes of vectors by integer Lloyd rounds with Hamerly's bounds.

Components become ``floor(4096 x)`` and vectors are cut into equal consecutive parts,
each with a codebook of its own. All arithmetic that decides is on integers, so codes
do not depend on the order of rows or on the number of tasks.

Each round is one pass over the state table: integers of the vector and, per part, the
code, one upper bound of the distance to its entry and one lower bound of the distance
to the second nearest. Codebooks (a few kB whatever the input) travel with the tasks.
After entries moved, bounds widen by their moves. While the upper bound is strictly
below the lower one (or half the distance from the entry to its nearest neighbour),
the entry is the only nearest one and the part is passed over. Else the upper bound is
made exact, and if it still isn't strictly below, the part is compared with all entries
on integers, of which the lowest index wins a tie. Bounds are rounded outwards to 32
bits. The same pass writes, for each task, sums and counts by entry, which one small
aggregation adds up for the next codebooks.

Defined results: rows whose vector is null, empty, or holds a null, NaN or infinite
component go, as do those beyond 2^50 (their integers would not fit); null ids stay
and sort last among the first entries, and rows with one id sort by vector; vectors of
another length than that of the least kept id go; a length that the number of parts
does not divide is filled with zeros; fewer vectors than entries give shorter
codebooks; errors that exceed a long are null; extra columns play no part, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Steps, if_small
from ._common import map_arrow

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components of integers up to here have squared distances that fit 64 bits.
_PLAIN = 1 << 25
_STATE = "vec_id long, label string, v array<long>, code binary, upper binary, lower binary, part int, entry int, n long, sums array<decimal(38,0)>"
_NAMES = [field.split()[0] for field in _STATE.split(", ")]
#: Codes are one byte.
ENTRIES_MOST = 256


def kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows whose vector can be coded; vectors as doubles."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 50)))
    return rows.filter(F.col("x").isNotNull() & (F.size("x") > 0) & fine)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """64-bit integers where squares fit, else Python's."""
    if all(not a.size or int(np.abs(a).max()) <= _PLAIN for a in arrays):
        return list(arrays)
    return [a.astype(object) for a in arrays]


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of (n, width) points to (k, width) entries."""
    points, entries = _exact(points, entries)
    out = np.zeros((len(points), len(entries)), points.dtype)
    for d in range(points.shape[1]):
        gap = points[:, d, None] - entries[None, :, d]
        out = out + gap * gap
    return out


def _root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf))


class Moves:
    """What a part's bounds need to know of its codebook: how far entries moved since
    the last round, and half the distance of each to its nearest neighbour."""

    def __init__(self, old: np.ndarray | None, new: np.ndarray):
        k = len(new)
        between = _root(squared(new, new))
        between[np.arange(k), np.arange(k)] = np.inf
        self.half = _down(between.min(axis=1) / 2).astype(np.float64) if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k) if old is None else np.array([_up(_root(squared(o[None], n[None])))[0, 0] if (o != n).any() else 0.0 for o, n in zip(old, new, strict=True)], np.float64)
        most = np.argsort(self.moved)[::-1]
        self.others = np.full(k, self.moved[most[0]])  # the longest move of any other entry
        self.others[most[0]] = self.moved[most[1]] if k > 1 else 0.0


def assign(points: np.ndarray, entries: np.ndarray, moves: Moves, code: np.ndarray | None, upper: np.ndarray | None, lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Codes and bounds of one part after a round, and how many points were scanned."""
    n = len(points)
    if code is None:
        code, upper, lower = np.zeros(n, np.uint8), np.full(n, np.inf, np.float32), np.full(n, -np.inf, np.float32)
        scan = np.arange(n)
    else:
        code = code.copy()
        upper = _up(upper.astype(np.float64) + moves.moved[code])
        lower = _down(lower.astype(np.float64) - moves.others[code])
        floor = np.maximum(lower, moves.half[code])
        doubt = np.flatnonzero(~(upper < floor))
        own, at = _exact(points[doubt], entries)
        gap = own - at[code[doubt]]
        upper[doubt] = _up(_root((gap * gap).sum(axis=1))) if len(doubt) else upper[doubt]
        scan = doubt[~(upper[doubt] < floor[doubt])]
    if len(scan):
        far = squared(points[scan], entries)
        best = far.argmin(axis=1)  # the lowest index of equal ones
        code[scan] = best
        nearest = far[np.arange(len(scan)), best]
        far = _root(far)
        far[np.arange(len(scan)), best] = np.inf
        upper[scan], lower[scan] = _up(_root(nearest)), _down(far.min(axis=1))
    return code, upper, lower, len(scan)


def _pass(codebooks: list[np.ndarray], before: list[np.ndarray] | None, first: bool, parts: int, last: bool):
    """One pass over the state: new codes, bounds and sums, or at the last the codes and errors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = codebooks[0].shape[1]
        moves = [Moves(before[j] if before else None, codebooks[j]) for j in range(parts)]
        counts = np.zeros((parts, ENTRIES_MOST), np.int64)
        sums = np.zeros((parts, ENTRIES_MOST, width), object)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            flat = pa.concat_arrays([batch.column(2)]).flatten().to_numpy(zero_copy_only=False).reshape(n, parts, width)
            state = [None] * 3 if first else [np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, parts) for c, t in ((3, np.uint8), (4, np.float32), (5, np.float32))]
            code, upper, lower = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.float32), np.zeros((n, parts), np.float32)
            errors = np.zeros(n, object)
            for j in range(parts):
                points = flat[:, j]
                code[:, j], upper[:, j], lower[:, j], _ = assign(points, codebooks[j], moves[j], *(None if s is None else s[:, j] for s in state))
                if last:
                    own, at = _exact(points, codebooks[j])
                    gap = own - at[code[:, j]]
                    errors += (gap * gap).sum(axis=1).astype(object)
                    continue
                order = np.argsort(code[:, j], kind="stable")
                there, begin = np.unique(code[order, j], return_index=True)
                counts[j, there] += np.diff(np.append(begin, n))
                batch_sums = np.add.reduceat(points[order] if int(np.abs(points).max()) < 1 << 40 else points[order].astype(object), begin, axis=0)
                sums[j, there] += batch_sums.astype(object)
            if last:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(errors.tolist(), pa.decimal128(38, 0))], names=["vec_id", "label", "code", "error"])
                continue
            arrays = [batch.column(0), batch.column(1), batch.column(2), *(pa.array([row.tobytes() for row in x], pa.binary()) for x in (code, upper, lower)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.decimal128(38, 0)))]
            yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)
        used = [] if last else [(j, e) for j in range(parts) for e in range(ENTRIES_MOST) if counts[j, e]]
        if used:
            m = len(used)
            arrays = [pa.nulls(m, pa.int64()), pa.nulls(m, pa.string()), pa.nulls(m, pa.list_(pa.int64())), *(pa.nulls(m, pa.binary()) for _ in range(3)), pa.array([j for j, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()), pa.array([int(counts[x]) for x in used], pa.int64()), pa.array([[int(y) for y in sums[x]] for x in used], pa.list_(pa.decimal128(38, 0)))]
            yield pa.RecordBatch.from_arrays(arrays, names=_NAMES)

    return run


def _updated(codebooks: list[np.ndarray], state: DataFrame, width: int) -> list[np.ndarray]:
    """Entries moved to the floors of their points' means; at most parts x entries rows reach the driver."""
    added = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(width)]
    out = [b.copy() for b in codebooks]
    for r in state.filter("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():
        out[r["part"]][r["entry"]] = [int(r[f"s{d}"]) // r["n"] for d in range(width)]
    return out


class Codes:
    """Codebooks (a list of integer arrays, one for each part) and coded rows."""

    def __init__(self, codebooks: list[np.ndarray], rows: DataFrame):
        self.codebooks, self.rows = codebooks, rows

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for book in self.codebooks for entry in book for x in entry).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codebooks after ``rounds`` Lloyd rounds, and for each kept vector its id, label (as text), code (hex) and error."""
    if not 1 <= entries <= ENTRIES_MOST:
        raise ValueError(f"from 1 to {ENTRIES_MOST} entries")
    spark = vectors.sparkSession
    steps = Steps(spark)
    rows = kept(vectors, id_col, vector_col, label_col)
    least = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "x").limit(1).collect()
    if not least:
        return Codes([], spark.createDataFrame([], "vec_id long, label string, code string, error decimal(38,0)"))
    dim = len(least[0]["x"])
    width = -(-dim // parts)
    integers = F.transform("x", lambda x: F.floor(x * scale))
    integers = F.concat(integers, F.array_repeat(F.lit(0).cast("long"), parts * width - dim)) if parts * width > dim else integers
    points = rows.filter(F.size("x") == dim).select("vec_id", "label", integers.alias("v"), "x")
    start = points.orderBy(F.col("vec_id").isNull(), "vec_id", "x").limit(entries).select("v").collect()
    books = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, width)
    codebooks, before = [np.ascontiguousarray(books[:, j]) for j in range(parts)], None
    state = points.select("vec_id", "label", "v")
    for turn in range(rounds):
        state = steps.write(map_arrow(state, _pass(codebooks, before, turn == 0, parts, False), _STATE), "state")
        before, codebooks = codebooks, _updated(codebooks, state, width)
        state = state.filter("part is null").select(*_NAMES[:6])
    coded = map_arrow(state, _pass(codebooks, before, rounds == 0, parts, True), "vec_id long, label string, code string, error decimal(38,0)")
    coded = steps.write(coded, "codes")
    steps.drop("state")
    return Codes(codebooks, coded)


def compressed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **settings) -> DataFrame:
    """One row per kept vector: code, error, the error of its label's rows, and a digest of the codebooks."""
    codes = train(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col, **settings)
    by_label = codes.rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    out = codes.rows.join(if_small(by_label), F.col("label").eqNullSafe(F.col("_label")))
    return out.select(F.col("vec_id").alias(id_col), "code", F.col("error").try_cast("long").alias("error"), F.col("label_error").try_cast("long").alias("label_error"), F.lit(codes.digest()).alias("codebooks_sha256"))
