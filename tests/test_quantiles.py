"""Exact quantiles of whole columns without a buffer that holds one."""

import math
import random

import numpy as np
import pytest

from cargolens.operators import cleaning as C


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.99, 0.995, 1.0])
def test_against_sorted_values(spark, share, monkeypatch):
    monkeypatch.setattr(C, "QUANTILE_VALUES", 40)  # several rounds on a small table
    rng = random.Random(2)
    columns = {
        "even": [rng.random() for _ in range(4000)],
        "few": [float(rng.randrange(5)) for _ in range(4000)],
        "skewed": [rng.choice([0.0, 0.0, rng.expovariate(1) ** 6]) for _ in range(4000)],
        "hot": [7.5 if i % 3 else rng.gauss(0, 1e6) for i in range(4000)],
        "gaps": [None if i % 5 else float(i) for i in range(4000)],
        "none": [None] * 4000,
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(3)
    got = C.quantiles(df, list(columns), share)
    for c, values in columns.items():
        there = [v for v in values if v is not None]
        assert got[c] == (None if not there else pytest.approx(float(np.quantile(there, share)), rel=1e-12, abs=1e-12)), c


def test_no_rows_and_one_row(spark):
    df = spark.createDataFrame([(3.0, None)], "a double, b double")
    assert C.quantiles(df, ["a", "b"], 0.99) == {"a": 3.0, "b": None}
    assert C.quantile_limits(df.limit(0), ["a"]) == {"a": None} and C.quantile_limits(df, ["a"]) == {"a": None}


def reference(values, share):
    there = sorted(v for v in values if v is not None and not math.isnan(v))
    if not there:
        return None
    place = (len(there) - 1) * share
    x, after = there[int(place)], there[min(int(place) + 1, len(there) - 1)]
    return x if x in (after, -math.inf) or place == int(place) else x + (after - x) * (place - int(place))


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 0.96, 0.99, 1.0])
def test_nan_infinities_and_equal_values(spark, share, monkeypatch):
    """NaN counts as null, infinities as values; the search always ends."""
    monkeypatch.setattr(C, "QUANTILE_VALUES", 50)
    rng, n, nan, inf = random.Random(7), 1000, float("nan"), float("inf")
    columns = {
        "nans": [nan if i % 20 == 0 else rng.random() for i in range(n)],
        "high": [inf if i % 20 == 0 else float(i) for i in range(n)],
        "low": [-inf if i < 300 else float(i) for i in range(n)],
        "both": [rng.choice([-inf, inf, 1.0, 2.0, nan, None]) for _ in range(n)],
        "equal": [4.25] * n,
        "null": [None] * n,
        "only_nan": [nan] * n,
        "whole": [float(rng.randrange(-3, 3)) for _ in range(n)],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(4)
    got = C.quantiles(df, list(columns), share)
    for c, values in columns.items():
        want = reference(values, share)
        assert got[c] == (want if want is None or math.isinf(want) else pytest.approx(want, rel=1e-12)), c


def test_a_sketch_that_misses_is_asked_again(spark, monkeypatch):
    monkeypatch.setattr(C, "SKETCH_SIZE", 8)
    monkeypatch.setattr(C, "SKETCH_ROOM", 1e-6)
    df = spark.range(20_000).selectExpr("cast((id * 7919) % 20011 as double) as x")
    there = sorted((i * 7919) % 20011 for i in range(20_000))
    assert C.quantiles(df, ["x"], 0.5) == {"x": (there[9999] + there[10000]) / 2}


def test_limits_of_columns_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float(i), inf if i > 95 else float(i), float("nan")) for i in range(100)], "a double, b double, c double")
    limits = C.quantile_limits(df, ["a", "b", "c"], 0.9)
    assert limits == {"a": pytest.approx(89.1), "b": pytest.approx(89.1), "c": None}
    assert C.quantile_mask(df, ["b"], 0.9)[0].filter("b_outlier").count() == 10
