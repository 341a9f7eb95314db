"""Stored tables: a batch rewrites only the buckets that it touches."""

import glob
import os

from pyspark.sql import functions as F

from cargolens.graph.store import KeyedTable, repeated

SCHEMA = "kind string, k string, a int, b string"


def table(spark, tmp_path, rows):
    return KeyedTable.create(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), ["kind", "k"], "kind", buckets=8)


def files(tmp_path):
    return {os.path.relpath(f, tmp_path) for f in glob.glob(str(tmp_path / "t" / "*" / "*" / "*.parquet"))}


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_touches_its_buckets_only(spark, tmp_path):
    t = table(spark, tmp_path, [("x", f"k{i}", i, "old") for i in range(200)] + [("y", "k1", 1, None), (None, "z", 1, ""), ("x", None, 1, "")])
    before = files(tmp_path)
    batch = spark.createDataFrame([("x", "k3", None, "new"), ("x", "k3", None, "less"), ("y", "fresh", 9, None), (None, "k3", 5, "n"), ("z", "k3", 7, "n")], SCHEMA)
    t.upsert(batch)
    after = files(tmp_path)
    assert len(before - after) == 1 + len({f for f in before if f.startswith("t/kind=y")} - after)
    want = {("x", f"k{i}", i, "old") for i in range(200) if i != 3} | {("x", "k3", 3, "new"), ("y", "k1", 1, None), ("y", "fresh", 9, None), ("z", "k3", 7, "n")}
    assert set(map(tuple, t.rows().collect())) == want
    again = files(tmp_path)
    t.upsert(batch)
    assert set(map(tuple, t.rows().collect())) == want and len(again) == len(files(tmp_path))


def test_find_and_delete(spark, tmp_path):
    t = table(spark, tmp_path, [("x", f"k{i}", i, "o") for i in range(40)] + [("y", f"k{i}", i, "o") for i in range(3)])
    found = t.find(spark.createDataFrame([("x", "k7"), ("x", "k7"), ("y", "k7"), ("x", None)], "kind string, k string"))
    assert rows(found) == [("x", "k7", 7, "o")]
    t.delete((F.col("a") >= 2) & (F.col("kind") == "y"))
    t.delete(F.col("a") > 1000)
    assert rows(t.rows().filter("kind = 'y'")) == [("y", "k0", 0, "o"), ("y", "k1", 1, "o")] and t.rows().count() == 42
    t.delete(F.col("kind") == "y")
    t.delete_groups("nothing", "y")
    assert t.rows().count() == 40
    t.delete_groups("x")
    assert t.rows().collect() == []
    t.upsert(spark.createDataFrame([("x", "k", 1, "b")], SCHEMA))
    assert rows(t.rows()) == [("x", "k", 1, "b")]


def test_repeated_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "i int, k string")
    assert rows(repeated(df, "k")) == [("a", 2)]
