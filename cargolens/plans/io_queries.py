"""Queries over scans, sinks, profiles and write-backs: what is written is read again."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graph import algorithms as G
from ..graph import build as B
from ..graph import project
from ..operators import cleaning as C
from ..session import materialize, work_dir
from ..sources import scan, sinks
from . import fixtures as V
from . import marts
from . import queries as Q


def _new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# -- scans --------------------------------------------------------------------

#: Raw manifests: headers as they come, a month in the file's name, null tokens and repeated rows.
MANIFEST = ("Bill of Lading", "Vessel Name", "Marks & Numbers", "HS Code")
_RAW = """
SELECT CAST(l_orderkey % 400 AS STRING) AS bill, CASE l_partkey % 5 WHEN 0 THEN '??' WHEN 1 THEN NULL ELSE concat('VESSEL ', CAST(l_suppkey % 9 AS STRING)) END AS vessel,
  CASE l_linenumber % 3 WHEN 0 THEN '################' ELSE concat('a, "', l_returnflag, '"') END AS marks, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE concat('0', CAST(l_linenumber AS STRING)) END AS code,
  month(l_shipdate) AS m
FROM {lineitem}
"""


def _raw_manifests(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.view(spark, sf, _RAW)
    path = _new_path(spark, "manifests")
    rows.select(*(F.col(c).alias(n) for c, n in zip(("bill", "vessel", "marks", "code"), MANIFEST, strict=True)), "m").write.partitionBy("m").option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{path}/raw")
    # file names carry the month, folders the country
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(f"{path}/files/us"))
    for month in range(1, 13):
        for i, found in enumerate(fs.globStatus(Path(f"{path}/raw/m={month}/part-*")) or []):
            fs.rename(found.getPath(), Path(f"{path}/files/us/2001{month:02d}_manifest_{i}.csv.gz"))
    return scan.read_manifests(spark, f"{path}/files", MANIFEST, renames={"vessel_name": "vessel"})


Q.QUERIES["src01_raw_manifests"] = _raw_manifests
_CLEAN = lambda c: f"CASE WHEN {c} IN ('??', '################') THEN NULL ELSE {c} END"
Q.ORACLE_SQL["src01_raw_manifests"] = V.oracle(
    f"SELECT DISTINCT bill AS bill_of_lading, {_CLEAN('vessel')} AS vessel, {_CLEAN('marks')} AS marks_n_numbers, code AS hs_code, CAST(concat('2001-', lpad(CAST(m AS VARCHAR), 2, '0'), '-01') AS DATE) AS report_month, 'US' AS country_imp FROM raw",
    raw=_RAW,
)


#: Orders whose rows one archive holds.
_ORDERS_EACH = 20_000


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """One archive: two members in nested folders, a note, and a member whose checksum is wrong."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
        parts = {"a.csv": rows.iloc[::2], "more/b.csv": rows.iloc[1::2]}
        for name, part in parts.items():
            archive.writestr(name, part[["bill", "vessel", "marks", "code"]].to_csv(index=False, header=list(MANIFEST)))
        archive.writestr("note.txt", "no rows")
        lost = zipfile.ZipInfo("more/broken.csv")
        archive.writestr(lost, "a,b,c,d\nBROKEN,BROKEN,BROKEN,BROKEN\n", compress_type=zipfile.ZIP_STORED)
    content = raw.getvalue().replace(b"BROKEN,BROKEN", b"BROKEN,broken", 1)
    first = rows.iloc[0]
    return pd.DataFrame({"path": [f"raw/us/2001{first['m']:02d}_manifest_{first['part']}.zip"], "content": [content]})


def _archived_manifests(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.view(spark, sf, _RAW.replace("month(l_shipdate) AS m", f"month(l_shipdate) AS m, l_orderkey div {_ORDERS_EACH} AS part"))
    packed = rows.groupBy("m", "part").applyInPandas(_packed, "path string, content binary")
    return scan.read_archived_manifests(materialize(packed, "archives"), MANIFEST, renames={"vessel_name": "vessel"}, broken="skip")


Q.QUERIES["src14_archived_manifests"] = _archived_manifests
Q.ORACLE_SQL["src14_archived_manifests"] = Q.ORACLE_SQL["src01_raw_manifests"]


def _dimension(reader, view: str, columns: dict[str, str]):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = _new_path(spark, "dimension")
        V.view(spark, sf, view).select(*(F.col(c).alias(n) for c, n in columns.items())).write.option("header", True).csv(path)
        return reader(spark, path)

    return run


Q.QUERIES["src05_ports"] = _dimension(scan.read_ports, V.PORTS, {c: c for c in ("port_code", "lat", "lon", "country", "continent")})
Q.ORACLE_SQL["src05_ports"] = V.oracle("SELECT port_code, lat, lon, country, continent FROM ports", ports=V.PORTS)
Q.QUERIES["src06_vessels"] = _dimension(scan.read_vessels, V.REGISTRY, {"vessel_name": "vessel_name", "vessel_imo": "imo", "vessel_type": "my_vessel_type.0"})
Q.ORACLE_SQL["src06_vessels"] = V.oracle("SELECT vessel_name, vessel_imo, vessel_type FROM registry", registry=V.REGISTRY)
Q.QUERIES["src07_hscodes"] = _dimension(scan.read_hscodes, V.HSCODES, {c: c for c in ("hscode_02_range", "hscode_02_desc_short", "hscode_04", "hscode_04_desc_short")})
Q.ORACLE_SQL["src07_hscodes"] = V.oracle("SELECT hscode_02_range, hscode_02_desc_short, hscode_04, hscode_04_desc_short FROM hscodes", hscodes=V.HSCODES)


def _yearly(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly summary files, of which the chosen years are read with the chosen columns."""
    path = _new_path(spark, "years")
    s = V.shipments(spark, sf).withColumn("year", F.year("arrival_date_actual"))
    sinks.save_parquet(s.select("shipment_id", "cif", "quantity", "arrival_date_actual", "year"), path, partition_by=["year"])
    return scan.read_processed(spark, path, ["shipment_id", "cif", "year"]).filter(F.col("year").isin(1996, 1998))


Q.QUERIES["src13_years"] = _yearly
Q.ORACLE_SQL["src13_years"] = V.oracle("SELECT shipment_id, cif, CAST(year(arrival_date_actual) AS INT) AS year FROM shipments WHERE year(arrival_date_actual) IN (1996, 1998)")
Q.QUERIES["src16_graph_query"] = lambda spark, sf: project.query(Q._graph(spark, sf, ("Shipper", "Carrier"), ("SHIPS_BY",)), "SELECT n.label, count(*) AS nodes, CAST(sum(d) AS BIGINT) AS links FROM {nodes} n LEFT JOIN (SELECT src AS id, count(*) AS d FROM {edges} GROUP BY src) e ON n.id = e.id GROUP BY n.label")
Q.ORACLE_SQL["src16_graph_query"] = V.oracle(f", n AS ({Q._nodes_sql(('Shipper', 'Carrier'))}), e AS (SELECT src AS id, count(*) AS d FROM ({Q._edges_sql(('SHIPS_BY',))}) GROUP BY src) SELECT split_part(n.id, ':', 1) AS label, count(*) AS nodes, CAST(sum(d) AS BIGINT) AS links FROM n LEFT JOIN e ON n.id = e.id GROUP BY 1")

# -- sinks --------------------------------------------------------------------

_SOME = ("shipment_id", "carrier_code", "cif", "arrival_date_actual", "notify_party_name")


def _parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = _new_path(spark, "parquet")
    rows = V.shipments(spark, sf).select(*_SOME)
    same = sinks.save_parquet(rows, path, check=True)
    return spark.read.parquet(path).withColumn("same", F.lit(same))


Q.QUERIES["snk01_parquet"] = _parquet
Q.ORACLE_SQL["snk01_parquet"] = V.oracle(f"SELECT {', '.join(_SOME)}, true AS same FROM shipments")


def _geo(spark: SparkSession, sf: str) -> DataFrame:
    path = _new_path(spark, "geo")
    same = sinks.save_geo(V.view(spark, sf, V.PORTS).select("port_code", "lat", "lon"), path)
    return spark.read.parquet(path).withColumn("same", F.lit(same))


Q.QUERIES["snk03_geo"] = _geo
Q.ORACLE_SQL["snk03_geo"] = V.oracle("SELECT port_code, lat, lon, concat('POINT (', CAST(lon AS VARCHAR), ' ', CAST(lat AS VARCHAR), ')') AS geometry, true AS same FROM ports", ports=V.PORTS)


def _csv(spark: SparkSession, sf: str) -> DataFrame:
    path = _new_path(spark, "csv")
    rows = V.shipments(spark, sf).select(*_SOME)
    sinks.save_csv_gz(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


Q.QUERIES["snk04_csv_gz"] = _csv
Q.ORACLE_SQL["snk04_csv_gz"] = V.oracle(f"SELECT {', '.join(_SOME)} FROM shipments")


def _bulk(spark: SparkSession, sf: str) -> DataFrame:
    """Header and data files of a bulk import, as the loader puts them together."""
    path = _new_path(spark, "bulk")
    edges = B.edges(V.shipments(spark, sf), "CARRIES_FROM").select("src", "dst", "type", "shipment_count", "valid_from")
    sinks.save_bulk(edges, path, source="Carrier", target="PortOfLading")
    header = spark.read.text(f"{path}/header").first()[0].split(",")
    read = spark.read.schema(", ".join(f"`{h}` {'long' if h.endswith(':long') else 'string'}" for h in header)).csv(f"{path}/data")
    return read.toDF(*[h.replace(":", "_").replace(".", "_").replace("(", "_").replace(")", "") for h in header])


Q.QUERIES["snk05_bulk_import"] = _bulk
Q.ORACLE_SQL["snk05_bulk_import"] = V.oracle(f"SELECT src AS \"_START_ID_Carrier_ID\", dst AS \"_END_ID_PortOfLading_ID\", 'CARRIES_FROM' AS \"_TYPE\", shipment_count AS shipment_count_long, CAST(valid_from AS VARCHAR) AS \"_from_date\", '~' AS \"_to\" FROM (SELECT carrier_code AS src, port_of_lading_code AS dst, count(*) AS shipment_count, {Q._EDGE_SQL} {Q._CS} GROUP BY 1, 2)")


def _bulk_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The loader skips edges that lack an end: here shippers of some countries are not among the nodes."""
    s = V.shipments(spark, sf)
    nodes = B.entity_nodes(s.filter("port_of_lading_country < 'NATION_2'"), "Shipper"), B.entity_nodes(s.filter("consignee_name is not null"), "Consignee")
    return B.loaded(B.edges(s, "SHIPS_FOR").select("src", "dst", "shipment_count"), *nodes)


Q.QUERIES["snk06_loaded"] = _bulk_loaded
Q.ORACLE_SQL["snk06_loaded"] = V.oracle(f"SELECT shipper_name AS src, consignee_name AS dst, count(*) AS shipment_count {Q._CS} AND consignee_name IS NOT NULL AND shipper_name IN (SELECT shipper_name {Q._CS} AND port_of_lading_country < 'NATION_2') GROUP BY 1, 2")


def _mart_table(spark: SparkSession, sf: str) -> DataFrame:
    """A mart is replaced as a table, laid out by quarter."""
    name = f"mart_{uuid.uuid4().hex[:12]}"
    mart = marts.MARTS["od_carriers"](marts.base(V.shipments(spark, sf)))
    marts.save(mart.limit(0), name, path=_new_path(spark, "mart"))
    marts.save(mart, name, path=_new_path(spark, "mart"))
    return spark.table(name).select(*mart.columns)


Q.QUERIES["snk07_mart_table"] = _mart_table
Q.ORACLE_SQL["snk07_mart_table"] = Q.ORACLE_SQL["mrt05_od_carriers"]
Q.QUERIES["snk08_report"] = lambda spark, sf: C.report(V.shipments(spark, sf).select("quantity", "cif", "cargo_count"))
Q.ORACLE_SQL["snk08_report"] = V.oracle(
    " UNION ALL ".join(f"SELECT '{c}' AS column, count({c}) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS kinds, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS deviation, min({c}) AS least, max({c}) AS greatest, round(corr({c}, quantity), 6) AS quantity, round(corr({c}, cif), 6) AS cif, round(corr({c}, cargo_count), 6) AS cargo_count FROM shipments" for c in ("quantity", "cif", "cargo_count"))
).replace(" AS column,", ' AS "column",')


def _written_back(spark: SparkSession, sf: str) -> DataFrame:
    g = Q._parties(spark, sf)
    return project.with_results(g.nodes.select("id", "label"), wcc=G.wcc(g), degree=G.degree(g))


Q.QUERIES["snk09_written_back"] = _written_back
Q.ORACLE_SQL["snk09_written_back"] = "SELECT w.id, split_part(w.id, ':', 1) AS label, component AS wcc_component, size AS wcc_size, degree FROM (" + Q.ORACLE_SQL["gra02_wcc"] + ") w JOIN (" + V.oracle(Q._PARTY_SQL + " SELECT id, coalesce(d, 0) AS degree FROM n LEFT JOIN (SELECT v, count(*) AS d FROM (SELECT src AS v FROM e UNION ALL SELECT dst FROM e) GROUP BY v) ON id = v") + ") g ON w.id = g.id"


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks of carriers and ports: kept on ports under their final name, removed elsewhere."""
    g = Q._graph(spark, sf, *reversed(Q._LADING))
    found = project.with_results(g.nodes, rankX=G.pagerank(g).withColumn("rank", F.round("rank", 6)))
    return project.renamed(found, {"rankX": "rank", "key": None}, labels=("PortOfLading",))


Q.QUERIES["gra15_renamed"] = _renamed
Q.ORACLE_SQL["gra15_renamed"] = "SELECT id, split_part(id, ':', 1) AS label, CASE WHEN starts_with(id, 'PortOfLading:') THEN rank END AS rank FROM (" + Q.ORACLE_SQL["gra07_pagerank_ports_lading"] + ")"

# -- tables that grow ---------------------------------------------------------


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the shipments loaded, then all of them: what is there stays."""
    s = V.shipments(spark, sf)
    first = B.relation(s.filter("voyage_number < 500"), "SHIPS_BY").withColumn("batch", F.lit(1))
    return B.merge_edges(first, B.relation(s, "SHIPS_BY").withColumn("batch", F.lit(2)))


Q.QUERIES["ddp02_merge_edges"] = _merged
Q.ORACLE_SQL["ddp02_merge_edges"] = V.oracle("SELECT shipper_name AS src, carrier_code AS dst, 'SHIPS_BY' AS type, CASE WHEN min(voyage_number) < 500 THEN 1 ELSE 2 END AS batch FROM shipments WHERE shipper_name IS NOT NULL AND carrier_code IS NOT NULL GROUP BY 1, 2")
Q.QUERIES["set02_concat"] = lambda spark, sf: scan.concat(*(V.shipments(spark, sf).filter(f"vessel_type = '{k}'").select("shipment_id", c) for k, c in (("container_ship", "teu"), ("non_container_ship", "quantity"))))
Q.ORACLE_SQL["set02_concat"] = V.oracle("SELECT shipment_id, CASE WHEN vessel_type = 'container_ship' THEN teu END AS teu, CASE WHEN vessel_type <> 'container_ship' THEN quantity END AS quantity FROM shipments")
_NAMELESS = """, s AS (SELECT shipment_id, CASE WHEN shipment_id % 4 = 0 THEN NULL ELSE vessel_imo END AS vessel_imo, CASE WHEN shipment_id % 3 = 0 THEN NULL ELSE vessel_name END AS vessel_name FROM shipments),
  i AS (SELECT vessel_name AS k, min(vessel_imo) AS v FROM s WHERE vessel_imo IS NOT NULL AND vessel_name IS NOT NULL GROUP BY 1),
  f AS (SELECT shipment_id, coalesce(vessel_imo, v) AS vessel_imo, vessel_name FROM s LEFT JOIN i ON vessel_name = k),
  j AS (SELECT vessel_imo AS k, min(vessel_name) AS v FROM f WHERE vessel_imo IS NOT NULL AND vessel_name IS NOT NULL GROUP BY 1)
SELECT shipment_id, vessel_imo, coalesce(vessel_name, v) AS vessel_name FROM f LEFT JOIN j ON vessel_imo = k"""
Q.QUERIES["win01_fill_names"] = lambda spark, sf: C.fill_each_other(V.shipments(spark, sf).select("shipment_id", F.expr("CASE WHEN shipment_id % 4 = 0 THEN NULL ELSE vessel_imo END").alias("vessel_imo"), F.expr("CASE WHEN shipment_id % 3 = 0 THEN NULL ELSE vessel_name END").alias("vessel_name")))
Q.ORACLE_SQL["win01_fill_names"] = V.oracle(_NAMELESS)
