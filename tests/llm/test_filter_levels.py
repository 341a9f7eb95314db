"""Quotient filters merged over several levels of blocks."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from cargolens.llm import exact_dedup


@pytest.mark.parametrize("levels", [1, 3])
def test_counts_are_those_of_the_fingerprints(spark, monkeypatch, levels):
    if levels > 1:
        monkeypatch.setattr(exact_dedup, "ENTRIES_PER_BLOCK", 16)
        monkeypatch.setattr(exact_dedup, "ENTRIES_PER_FILTER", 4)
    rng = random.Random(4)
    prints = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(1500)]
    prints += rng.choices(prints[:100], k=400) + [prints[7]] * 800 + [0, 0, -1, -1, (1 << 63) - 1, -(1 << 63)]
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(40, F.rand(1))
    bits, _ = exact_dedup.block_plan(len(prints), 40)
    assert (len(bits) > 2) == (levels > 1)
    got = {r["fp"]: r["copies"] for r in exact_dedup.repeated_fingerprints(df).collect()}
    assert got == {p: n for p, n in collections.Counter(prints).items() if n > 1}


def test_the_plan_for_a_large_table():
    bits, together = exact_dedup.block_plan(50_000_000_000, 800_000)
    assert bits[-1] == 19 and 50_000_000_000 / 800_000 / 2 ** bits[0] >= exact_dedup.ENTRIES_PER_FILTER
    assert all(b - a <= 11 for a, b in zip(bits, bits[1:], strict=False)) and together == 1562
    assert exact_dedup.block_plan(0, 1) == ([0], 1562) and exact_dedup.block_plan(300_000, 32)[0] == [2]


def test_no_fingerprints(spark):
    assert exact_dedup.repeated_fingerprints(spark.createDataFrame([], "fp long")).count() == 0
