"""The views that play the parts of the shipment data, over the star-schema tables.

Each view is one SQL text in the dialect that Spark and DuckDB share, with table
names in braces, so that an oracle runs the same text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SHIPMENTS = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS shipment_id,
  CASE WHEN l.l_linenumber = 2 THEN NULL ELSE concat('BOL', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_suppkey % 7 AS STRING)) END AS bill_of_lading,
  CASE WHEN o.o_custkey % 50 = 0 THEN NULL ELSE c.c_name END AS consignee_name,
  concat(c.c_mktsegment, ' ', nc.n_name) AS consignee_address,
  s.s_name AS shipper_name, ns.n_name AS shipper_address,
  CASE WHEN l.l_orderkey % 10 < 4 THEN NULL ELSE concat('NOTIFY ', CAST(o.o_custkey % 97 AS STRING)) END AS notify_party_name,
  o.o_orderpriority AS notify_party_address,
  p.p_brand AS carrier_code, concat(p.p_brand, ' LINES') AS carrier_name,
  CASE WHEN l.l_partkey % 100 = 0 THEN NULL ELSE CAST(9000000 + p.p_size AS STRING) END AS vessel_imo,
  upper(p.p_name) AS vessel_name,
  CASE WHEN l.l_returnflag <> 'R' THEN 'container_ship' ELSE 'non_container_ship' END AS vessel_type,
  CAST(57000 + s.s_nationkey AS STRING) AS port_of_lading_code, ns.n_name AS port_of_lading,
  ns.n_name AS port_of_lading_country, rs.r_name AS port_of_lading_continent,
  CAST(s.s_nationkey AS DOUBLE) + 10.25 AS port_of_lading_lat, CAST(s.s_nationkey AS DOUBLE) + 0.5 AS port_of_lading_lon,
  CAST(3000 + c.c_nationkey AS STRING) AS port_of_unlading_code, nc.n_name AS port_of_unlading,
  nc.n_name AS port_of_unlading_country, rc.r_name AS port_of_unlading_continent,
  CAST(c.c_nationkey AS DOUBLE) + 20.75 AS port_of_unlading_lat, CAST(c.c_nationkey AS DOUBLE) + 1.5 AS port_of_unlading_lon,
  CASE WHEN l.l_linenumber = 7 THEN NULL ELSE concat('CNT', CAST(l.l_partkey AS STRING), ', CNT', CAST(l.l_suppkey AS STRING)) END AS container_id,
  concat(lpad(CAST(p.p_partkey % 97 + 1 AS STRING), 2, '0'), lpad(CAST(p.p_size AS STRING), 2, '0'), '00') AS hscode,
  CASE WHEN l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS cargo_count,
  l.l_quantity / 10 AS teu, l.l_quantity AS quantity, l.l_extendedprice AS cif,
  l.l_quantity * 100 * (1 - l.l_discount) AS weight_kg, l.l_quantity * 220 * (1 - l.l_discount) AS weight,
  p.p_size AS containers_count, p.p_size * 2 - (l.l_linenumber - 1) * 5 AS vessel_teu,
  l.l_orderkey % 1000 AS voyage_number,
  CAST(l.l_shipdate AS DATE) AS arrival_date_actual,
  CAST(l.l_shipdate AS DATE) - CAST(l.l_partkey % 41 - 10 AS INT) AS arrival_date_estimate,
  CAST(o.o_orderdate AS DATE) AS arrival_date_estimate_dirty,
  CAST(l.l_partkey % 41 - 10 AS INT) AS arrival_date_delay,
  concat('POINT (', CAST(s.s_nationkey AS STRING), '.5 ', CAST(s.s_nationkey + 10 AS STRING), '.25)') AS port_of_fl_centroid,
  concat('POINT (', CAST(c.c_nationkey AS STRING), '.5 ', CAST(c.c_nationkey + 10 AS STRING), '.125)') AS port_of_ul_centroid
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {supplier} s ON l.l_suppkey = s.s_suppkey JOIN {part} p ON l.l_partkey = p.p_partkey
  JOIN {nation} nc ON c.c_nationkey = nc.n_nationkey JOIN {nation} ns ON s.s_nationkey = ns.n_nationkey
  JOIN {region} rc ON nc.n_regionkey = rc.r_regionkey JOIN {region} rs ON ns.n_regionkey = rs.r_regionkey
"""

REGISTRY = """
SELECT concat(split_part(upper(p_name), ' ', 2), ' ', split_part(upper(p_name), ' ', 1)) AS vessel_name,
  CAST(9000000 + min(p_size) AS STRING) AS vessel_imo, 'container_ship' AS vessel_type
FROM {part} GROUP BY upper(p_name), split_part(upper(p_name), ' ', 1), split_part(upper(p_name), ' ', 2)
"""

PORTS = """
SELECT CAST(57000 + n_nationkey AS STRING) AS port_code, CAST(n_nationkey AS DOUBLE) + 10.25 AS lat, CAST(n_nationkey AS DOUBLE) + 0.5 AS lon,
  n_name AS country, r_name AS continent FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
UNION ALL
SELECT CAST(3000 + n_nationkey AS STRING), CAST(n_nationkey AS DOUBLE) + 20.75, CAST(n_nationkey AS DOUBLE) + 1.5,
  n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

HSCODES = """
SELECT concat(lpad(CAST(ch AS STRING), 2, '0'), '01 - ', lpad(CAST(ch AS STRING), 2, '0'), '30') AS hscode_02_range,
  concat('Chapter ', CAST(ch AS STRING)) AS hscode_02_desc_short, concat(lpad(CAST(ch AS STRING), 2, '0'), lpad(CAST(sz AS STRING), 2, '0')) AS hscode_04,
  concat('Heading ', CAST(ch AS STRING), '-', CAST(sz AS STRING)) AS hscode_04_desc_short
FROM (SELECT DISTINCT p_partkey % 97 + 1 AS ch FROM {part}) chapters CROSS JOIN (SELECT DISTINCT p_size AS sz FROM {part} WHERE p_size <= 30) sizes
"""


def tables_of(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(text)})


def oracle_text(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SHIPMENTS)


def oracle(select: str, **views: str) -> str:
    """``select`` over the named views (shipments is always there)."""
    named = {"shipments": SHIPMENTS} | views
    return "WITH " + ",\n".join(f"{k} AS ({oracle_text(v)})" for k, v in named.items()) + "\n" + select
