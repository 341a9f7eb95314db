"""The whole cleaning pipeline: its fuzzy columns are what the operators give, all others what the exact pipeline gives."""

from pyspark.sql import functions as F

from cargolens.operators import cleaning as C
from cargolens.operators import matching as M
from cargolens.plans import fixtures as V
from cargolens.plans import process_queries as P
from cargolens.plans.queries import QUERIES

FUZZY = ("vessel_imo", "vessel_name", "vessel_type", "shipper_name", "shipper_address", "consignee_name", "consignee_address")


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_whole_pipeline(spark, sf):
    full, exact = QUERIES["prc02_process"](spark, sf).cache(), QUERIES["prc01_process_exact"](spark, sf)
    assert full.columns == exact.columns == sorted(full.columns)
    other = [c for c in full.columns if c not in FUZZY]
    assert rows(full, *other) == rows(exact, *other)
    raw = V.view(spark, sf, P.RAW)
    vessels = C.standardise_vessels(C.clean_vessel_keys(raw), V.view(spark, sf, V.REGISTRY))
    assert rows(full, "row_id", *FUZZY[:3]) == rows(vessels, "row_id", *FUZZY[:3])
    assert vessels.filter("match_score between 80 and 99").count() > 0
    for name, address in (FUZZY[3:5],):
        grouped = M.group_companies(raw.select("row_id", name, address), name, address, dedupe=False)
        assert rows(full, "row_id", name, address) == rows(grouped, "row_id", name, address)


def test_missing_columns_are_passed_over(spark, sf):
    raw = V.view(spark, sf, P.RAW).select("row_id", "actual_arrival_date", "estimate_arrival_date", F.lit(None).cast("string").alias("vessel_imo"), F.upper(F.trim("vessel_name")).alias("vessel_name"), F.lit("container_ship").alias("vessel_type"), "weight")
    got = P.process(raw, *(V.view(spark, sf, x) for x in (V.REGISTRY, V.PORTS, V.HSCODES)))
    assert got.count() == raw.count() and "weight_outliers_off" in got.columns and "hscode_02" not in got.columns


def test_small_lookups_leave_the_rows_where_they_are(spark):
    from cargolens.operators import cleaning, matching

    rows = spark.createDataFrame([("1", "A", "ACME INC", "X"), (None, "A", "ACME INC", None), ("2", None, "BOLT CO", "Y"), ("2", "B", "12", "7 Z")], "vessel_imo string, vessel_name string, company string, address string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # of itself Spark broadcasts nothing
    try:
        filled = cleaning.fill_each_other(rows)
        grouped = matching.group_companies(rows, "company", "address", dedupe=False)
        for out in (filled, grouped):
            assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, filled.select("vessel_imo", "vessel_name").collect())) == [("1", "A"), ("1", "A"), ("2", "B"), ("2", "B")]
        assert [r["address"] for r in grouped.filter("vessel_name = 'A'").collect()] == ["X", "X"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
