"""Quirks, date edges and null keys on tiny literals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cargolens.functions import exprs as X
from cargolens.operators import cleaning as C
from cargolens.operators import matching as M
from cargolens.operators import metrics
from cargolens.sources import scan, sinks


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("y", "p", "want"), [([3, -0.5, 2, 7], [2.5, 0, 2, 8], 0.32738), ([1, -1, 2, -2], [0.7, -0.7, 1.4, -1.4], 0.3)])
def test_mape(spark, y, p, want):
    df = spark.createDataFrame(list(zip(map(float, y), map(float, p), strict=True)), "y double, p double")
    assert metrics.mape(df, "y", "p").first()[0] == pytest.approx(want, abs=1e-5)


def test_month_edges(spark):
    day = lambda s: F.lit(s).cast("date")
    assert one(spark, X.month_end_after(day("2024-01-31"))) == dt.date(2024, 2, 29)
    assert one(spark, X.month_end_after(day("2024-01-30"))) == dt.date(2024, 1, 31)
    assert one(spark, X.month_start_before(day("2024-03-01"))) == dt.date(2024, 2, 1)
    assert one(spark, X.with_year(day("2024-02-29"), F.lit(2023))) == dt.date(2023, 2, 28)
    assert one(spark, X.quarter_text(day("2022-05-01"))) == "2022-2Q"


def test_half_even_and_utilization(spark):
    assert one(spark, X.half_even(F.lit(2.5))) == 2.0
    assert one(spark, X.half_even(F.lit(0.85), 1)) == 0.8
    assert one(spark, X.utilization(F.lit(5), F.lit(4))) == 1.0
    assert one(spark, X.utilization(F.lit(0), F.lit(4))) is None
    assert one(spark, X.utilization(F.lit(3), F.lit(4), whole=True)) == 0.0


def test_delay_repair(spark):
    rows = [("2020-01-05", "2019-01-04"), ("2020-06-05", "2019-06-04"), ("2020-06-05", "2020-06-01"), (None, "2020-01-01")]
    df = spark.createDataFrame(rows, "a string, e string").select(F.col("a").cast("date").alias("arrival_date_actual"), F.col("e").cast("date").alias("arrival_date_estimate"))
    got = sorted((str(r[1]), r[2]) for r in C.repair_delay(df).collect())
    assert got == [("2020-01-01", None), ("2020-01-04", 1), ("2020-06-01", 4), ("2020-06-04", 1)]


def test_split_and_lists(spark):
    df = spark.createDataFrame([("57035, YANTIAN!",), ("PLAIN",), (None,)], "p string")
    assert [tuple(r) for r in C.split_column(df, "p", "code", "name", ",").collect()] == [("57035", "YANTIAN"), ("PLAIN", None), (None, None)]
    assert one(spark, X.listed(F.lit("B 1, A,, B1 ,"))) == "B1, A"
    assert one(spark, X.listed(F.lit(None).cast("string"))) is None


def test_winsorise_without_outliers(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert [r["x_outliers_off"] for r in C.winsorise(df, ["x"]).collect()] == [1.0, 1.0, None]


def test_fill_each_other_keeps_null_keys(spark):
    df = spark.createDataFrame([("A", "1"), ("A", None), (None, "1"), (None, None)], "vessel_name string, vessel_imo string")
    got = sorted(map(str, ((r["vessel_name"], r["vessel_imo"]) for r in C.fill_each_other(df).collect())))
    assert got == sorted(map(str, [("A", "1"), ("A", "1"), ("A", "1"), (None, None)]))


def test_mismatches(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, "c", None), (None, "d", None)], "k int, name string, z string")
    assert sorted(map(str, (tuple(r) for r in C.drop_mismatches(df, "k", "name").collect()))) == sorted(map(str, [(1, "b", "x"), (2, "c", None), (None, "d", None)]))


def test_scorers():
    assert M.token_sort_ratio("MSC ANNA", "ANNA MSC") == 100
    assert M.token_set_ratio("EVER GIVEN", "EVER GIVEN II") == 100
    assert M.ratio("abcd", "abxd") == 75
    assert M.lcs("", "abc") == 0


def test_two_rounds(spark):
    names = spark.createDataFrame([("ANNA MSC",), ("EVER GIVEN II",), ("ZZZZZ",), (None,)], "n string")
    choices = spark.createDataFrame([("MSC ANNA",), ("EVER GIVEN",)], "c string")
    got = {r["n"]: (r["match"], r["score"]) for r in M.match_names(names, choices, "n").collect()}
    assert got == {"ANNA MSC": ("MSC ANNA", 100), "EVER GIVEN II": ("EVER GIVEN", 100)}


def test_prepared_names(spark):
    rows = ["Acme S.A. de C.V.", "Müller & Söhne 2001", "12345", "Foo L.L.C", "  ", "unknown", None]
    df = spark.createDataFrame([(r,) for r in rows], "n string").select(M.prepared_name("n").alias("x"))
    assert [r["x"] for r in df.collect()] == ["ACME SDC", "MULLER AND SOHNE", None, "FOO LLC", None, None, None]


def test_ngram_groups_against_brute_force(spark):
    import itertools
    import math

    names = ["ACME TRADING COMPANY", "ACME TRADING COMPANI", "ACME TRADING", "OTHER SHIPPING", "OTHER SHIPPINGS", "LONE", "AB"]
    grams = {n: [n.lower().replace(" ", "")[i : i + 3] for i in range(len(n.replace(" ", "")) - 2)] for n in names}
    df = {}
    for g in grams.values():
        for x in set(g):
            df[x] = df.get(x, 0) + 1
    vec = {}
    for n, g in grams.items():
        v = {x: g.count(x) * (math.log((1 + len(names)) / (1 + df[x])) + 1) for x in set(g)}
        size = math.sqrt(sum(w * w for w in v.values())) or 1
        vec[n] = {x: w / size for x, w in v.items()}
    links = {(a, b) for a, b in itertools.combinations(names, 2) if sum(w * vec[b].get(x, 0) for x, w in vec[a].items()) >= 0.7}
    got = {r["name"]: r["group"] for r in M.ngram_groups(spark.createDataFrame([(n,) for n in names], "name string"), "name", 3, 0.7).collect()}
    root = {n: n for n in names}
    for a, b in links:
        for n in names:
            if root[n] == root[a]:
                root[n] = root[b]
    assert all((got[a] == got[b]) == (root[a] == root[b]) for a, b in itertools.combinations(names, 2))


def test_scan_and_sinks(spark, tmp_path):
    folder = tmp_path / "us"
    folder.mkdir()
    (folder / "202203_a.csv").write_text("Bill of Lading,Marks & Numbers,day\nB1,??,1\nB1,??,1\n,????,\n")
    (folder / "202204_b.csv").write_text("Bill of Lading,Marks & Numbers,day\nB1,??,1\n")
    df = scan.read_manifests(spark, str(tmp_path), ["Bill of Lading", "Marks & Numbers", "day"])
    got = sorted((r["bill_of_lading"], r["marks_n_numbers"], str(r["report_month"]), r["country_imp"]) for r in df.collect())
    assert got == [("B1", None, "2022-03-01", "US"), ("B1", None, "2022-04-01", "US")]
    assert sinks.save_parquet(df, str(tmp_path / "out"), check=True)
    edges = spark.createDataFrame([("a", "b", 3)], "src string, dst string, n long")
    assert sinks.save_bulk(edges, str(tmp_path / "bulk"), source="A", target="B") == [":START_ID(A_ID)", ":END_ID(B_ID)", "n:long", ".to"]


def test_stream_without_repeats(spark, tmp_path):
    from cargolens.streaming import ingest

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,ts\n1,2022-01-01 00:00:00\n1,2022-01-01 00:00:00\n??,2022-01-02 00:00:00\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.TimestampType())])
    stream = ingest.without_repeats(ingest.stream_manifests(spark, str(tmp_path / "in"), schema), "ts", ["id"])
    q = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    assert sorted(str(r["id"]) for r in spark.sql("select * from once").collect()) == ["1", "None"]
