"""Vector codes against plain Lloyd rounds on Python's integers."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from cargolens.llm import vector_codes
from cargolens.llm.queries import op11_vector_codes

COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    rows = sorted((r for r in rows if fine(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return []
    dim = len(rows[0][1])
    rows = [r for r in rows if len(r[1]) == dim]
    width = -(-dim // parts)
    ints = [[math.floor(4096 * x) for x in r[1]] + [0] * (parts * width - dim) for r in rows]
    cut = [[v[j * width : (j + 1) * width] for j in range(parts)] for v in ints]
    books = [[v[j] for v in cut[:entries]] for j in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        codes = [[min(range(len(books[j])), key=lambda e: (far(v[j], books[j][e]), e)) for j in range(parts)] for v in cut]  # noqa: B023
        if turn < rounds:
            for j in range(parts):
                for e in range(len(books[j])):
                    own = [v[j] for v, c in zip(cut, codes, strict=True) if c[j] == e]
                    if own:
                        books[j][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    errors = [sum(far(v[j], books[j][c[j]]) for j in range(parts)) for v, c in zip(cut, codes, strict=True)]
    total = {}
    for r, e in zip(rows, errors, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    long = lambda x: x if x < 2**63 else None
    return [(r[0], "".join(f"{c:02x}" for c in code), long(e), long(total[r[2]]), sha) for r, code, e in zip(rows, codes, errors, strict=True)]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def same(spark, rows, **settings):
    got = vector_codes.compressed(spark.createDataFrame(rows, SCHEMA), **settings)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == ordered(brute(rows, **settings))


def test_whole_query_is_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert ordered(op11_vector_codes(spark, sf).collect()) == ordered(brute([tuple(r) for r in rows]))


def test_ties_repeats_and_broken_rows(spark):
    rnd = random.Random(3)
    grid = [[rnd.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(16)] for _ in range(120)]  # many equal distances
    rows = [(i // 2, v, rnd.choice([None, 1, 2])) for i, v in enumerate(grid)]
    rows += [(900, [float("nan")] * 16, 1), (901, None, 1), (902, [], 1), (903, [float("inf")] + [0.0] * 15, 1), (904, [None] + [0.0] * 15, 2), (-5, [-0.0] * 16, None), (905, [0.1] * 9, 1), (None, [0.3] * 16, 1), (5, grid[0], 1), (5, grid[0], 1)]
    same(spark, rows)


def test_large_components_odd_lengths_few_rows(spark):
    rnd = random.Random(5)
    same(spark, [(i, [rnd.uniform(-1e6, 1e6) for _ in range(11)], i % 3) for i in range(60)], parts=4, entries=5)
    same(spark, [(i, [rnd.uniform(-1e14, 1e14) for _ in range(8)], None) for i in range(20)], entries=4, rounds=3)
    same(spark, [(3, [0.5] * 8, 1), (2, [0.25] * 8, 1)])
    same(spark, [])
    same(spark, [(1, None, 1)])


def test_clashing_columns(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").withColumns({c: F.lit("c") for c in ("x", "v", "code", "part", "n", "_label", "error")})
    assert ordered(vector_codes.compressed(df).collect()) == ordered(op11_vector_codes(spark, sf).collect())


def test_bounds_save_scans():
    rnd = np.random.default_rng(1)
    points = (rnd.normal(size=(5000, 8)) + rnd.integers(0, 4, (5000, 1)) * 6).astype(np.float64)
    points = np.floor(points * 4096).astype(np.int64)
    book, before, state, scanned = points[:16].copy(), None, (None,) * 3, []
    for _ in range(7):
        *state, n = vector_codes.assign(points, book, vector_codes.Moves(before, book), *state)
        plain = vector_codes.squared(points, book).argmin(axis=1)
        assert (state[0] == plain).all()
        scanned.append(n)
        before, book = book, np.array([points[plain == e].sum(axis=0) // max(1, (plain == e).sum()) if (plain == e).any() else book[e] for e in range(16)])
    assert scanned[0] == 5000 and scanned[-1] < 2500
