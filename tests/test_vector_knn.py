"""Neighbour descent against all pairs."""

import numpy as np
import pytest

from cargolens.graph import vector_knn
from cargolens.plans.search_queries import QUERIES


def exact(ids, vectors, k, metric="COSINE"):
    alike = np.round(vector_knn._alike(np.asarray(vectors, np.float64), metric), 9)
    out = {}
    for i, a in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-alike[i, j], ids[j]))[:k]
        out[a] = {ids[j]: alike[i, j] for j in order}
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r["src"], {})[r["dst"]] = r["score"]
    assert all(len(v) == len(want[s]) for s, v in got.items()) and set(got) == set(want)
    # equally good neighbours count
    hit = sum(score >= min(want[s].values()) - 1e-9 for s, v in got.items() for score in v.values())
    return hit / sum(map(len, want.values()))


def test_whole_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    assert recall(QUERIES["gra11_knn_vectors"](spark, sf).collect(), exact([r[0] for r in rows], [r[1] for r in rows], 14)) >= 0.9


@pytest.mark.parametrize("metric", ["COSINE", "EUCLIDEAN"])
def test_descent_beyond_random_groups(spark, monkeypatch, metric):
    monkeypatch.setattr(vector_knn, "GROUP", 20)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 12)) * 3
    vectors = (centres[rng.integers(0, 30, 900)] + rng.normal(size=(900, 12))).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>")
    found = vector_knn.nearest(df, "v", 8, metric).collect()
    assert recall(found, exact(list(range(900)), vectors, 8, metric)) >= 0.9


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, None), (4, []), (5, [nan, 1.0]), (6, [1.0, None]), (7, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = {(r["src"], r["rank"]): r["dst"] for r in vector_knn.nearest(df, "v", 3).collect()}
    assert got == {(1, 1): 2, (1, 2): 7, (2, 1): 1, (2, 2): 7, (7, 1): 1, (7, 2): 2}
    assert vector_knn.nearest(df.limit(0), "v", 3).collect() == []
