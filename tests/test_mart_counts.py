"""Marts with two distinct counts: missing values, and one shuffle of the rows."""

import re

from pyspark.sql import functions as F

from cargolens.plans import marts


def rows(spark):
    made = [(i, None if i % 7 == 0 else i % 3, None if i % 5 == 0 else f"c{i % 4}", float(i), i % 6, "a" if i % 2 else None) for i in range(200)]
    df = spark.createDataFrame(made, "shipment_id long, voyage_number long, container_id string, cif double, containers_count int, consignee_name string")
    names = ("consignee_address", "carrier_code", "vessel_name", "shipper_name", "port_of_lading_country", "arrival_quarter", "arrival_quarter_txt")
    return df.withColumns({c: F.when(F.col("cif") < 0, F.lit(c)) if c == "carrier_code" else F.concat_ws("", F.lit(c), F.when(F.col("cif") < 0, "x")) for c in names})


def test_distinct_counts_with_missing_values(spark):
    got = {r["consignee_name"]: r for r in marts.cnee_carriers(rows(spark)).collect()}
    assert set(got) == {None, "a"}
    plain = rows(spark).collect()
    for key, r in got.items():
        own = [x for x in plain if x["consignee_name"] == key]
        assert r["shipments_count"] == len(own) == 100 and r["value_sum"] == sum(x["cif"] for x in own)
        assert r["voyages_count"] == len({x["voyage_number"] for x in own} - {None})
        assert r["containers_count"] == len({x["container_id"] for x in own} - {None})


def test_rows_are_shuffled_once_and_not_multiplied(spark):
    for mart in (marts.cnee_carriers, marts.cnee_shippers):
        plan = mart(rows(spark).repartition(3)).select("*")._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"\bExpand\b", plan) and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
