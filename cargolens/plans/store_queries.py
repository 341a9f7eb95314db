"""Merging, finding and deleting nodes and edges of stored tables, each with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graph import build as B
from ..graph.store import KeyedTable, detach_delete, repeated
from ..session import work_dir
from ..streaming.ingest import ComponentStream
from . import fixtures as V
from . import queries as Q

#: Properties of the parties, from the rows of one half of the voyages.
_PARTIES = """
SELECT '{label}' AS label, concat('{label}:', {key}) AS id, max({address}) AS address, count(*) AS shipments, CASE WHEN max(quantity) > 45 THEN max(quantity) END AS largest
FROM ({rows}) WHERE {key} IS NOT NULL AND {half} GROUP BY {key}
"""
_KINDS = (("Shipper", "shipper_name", "shipper_address"), ("Consignee", "consignee_name", "consignee_address"), ("NotifyParty", "notify_party_name", "notify_party_address"))


def _nodes(half: str, rows: str = V.SHIPMENTS) -> str:
    return " UNION ALL ".join(_PARTIES.format(label=a, key=b, address=c, half=half, rows=rows) for a, b, c in _KINDS)


_EDGES = f"""
SELECT DISTINCT 'SHIPS_FOR' AS type, concat('Shipper:', shipper_name) AS src, concat('Consignee:', consignee_name) AS dst FROM ({V.SHIPMENTS}) WHERE consignee_name IS NOT NULL
UNION ALL SELECT DISTINCT 'NOTIFY_FOR', concat('NotifyParty:', notify_party_name), concat('Consignee:', consignee_name) FROM ({V.SHIPMENTS}) WHERE consignee_name IS NOT NULL AND notify_party_name IS NOT NULL
UNION ALL SELECT DISTINCT 'SHIPS_BY', concat('Shipper:', shipper_name), concat('Carrier:', carrier_code) FROM ({V.SHIPMENTS})
"""
_OLD, _NEW = "voyage_number % 4 <> 0", "voyage_number % 4 = 0"


def _table(spark: SparkSession, sf: str, text: str, name: str, keys: tuple[str, ...], group: str) -> KeyedTable:
    return KeyedTable.create(V.view(spark, sf, text), f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", keys, group)


def _stored_nodes(spark: SparkSession, sf: str) -> KeyedTable:
    return _table(spark, sf, _nodes(_OLD), "stored-nodes", ("label", "id"), "label")


def _stored_edges(spark: SparkSession, sf: str) -> KeyedTable:
    return _table(spark, sf, _EDGES, "stored-edges", ("type", "src", "dst"), "type")


def _upserted(spark: SparkSession, sf: str) -> DataFrame:
    table = _stored_nodes(spark, sf)
    table.upsert(V.view(spark, sf, _nodes(_NEW)))
    return table.rows()


_OLD_SQL, _NEW_SQL = V.oracle_text(_nodes(_OLD)), V.oracle_text(_nodes(_NEW))
Q.QUERIES["ddp04_upsert_nodes"] = _upserted
Q.ORACLE_SQL["ddp04_upsert_nodes"] = f"SELECT label, id, coalesce(n.address, o.address) AS address, coalesce(n.shipments, o.shipments) AS shipments, coalesce(n.largest, o.largest) AS largest FROM ({_OLD_SQL}) o FULL JOIN ({_NEW_SQL}) n USING (label, id)"

_ASKED = "SELECT 'Consignee' AS label, concat('Consignee:', c_name) AS id FROM {customer} WHERE c_custkey % 7 = 0"
Q.QUERIES["ddp05_find_nodes"] = lambda spark, sf: _stored_nodes(spark, sf).find(V.view(spark, sf, _ASKED))
Q.ORACLE_SQL["ddp05_find_nodes"] = f"SELECT o.* FROM ({_OLD_SQL}) o SEMI JOIN ({V.oracle_text(_ASKED)}) a USING (label, id)"


def _detached(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = _stored_nodes(spark, sf), _stored_edges(spark, sf)
    detach_delete(nodes, edges, "NotifyParty")
    return nodes.rows().select(F.col("label").alias("kind"), F.col("id").alias("a"), F.lit(None).cast("string").alias("b")).unionByName(edges.rows().select(F.col("type").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")))


Q.QUERIES["ddp06_delete_label"] = _detached
Q.ORACLE_SQL["ddp06_delete_label"] = f"SELECT label AS kind, id AS a, NULL AS b FROM ({_OLD_SQL}) WHERE label <> 'NotifyParty' UNION ALL SELECT type, src, dst FROM ({V.oracle_text(_EDGES)}) WHERE type <> 'NOTIFY_FOR'"


def _without_types(spark: SparkSession, sf: str) -> DataFrame:
    edges = _stored_edges(spark, sf)
    edges.delete_groups("SHIPS_BY")
    edges.delete(F.endswith("dst", F.lit("7")))
    return edges.rows()


Q.QUERIES["ddp07_delete_type"] = _without_types
Q.ORACLE_SQL["ddp07_delete_type"] = f"SELECT * FROM ({V.oracle_text(_EDGES)}) WHERE type <> 'SHIPS_BY' AND NOT ends_with(dst, '7')"
Q.QUERIES["ddp08_not_unique"] = lambda spark, sf: repeated(V.shipments(spark, sf), "bill_of_lading")
Q.ORACLE_SQL["ddp08_not_unique"] = V.oracle('SELECT bill_of_lading, count(*) AS "rows" FROM shipments WHERE bill_of_lading IS NOT NULL GROUP BY 1 HAVING count(*) > 1')
Q.QUERIES["adm_last_ids"] = lambda spark, sf: V.view(spark, sf, _nodes("true")).select("id").orderBy(F.desc("id")).limit(10)
Q.ORACLE_SQL["adm_last_ids"] = f"SELECT id FROM ({V.oracle_text(_nodes('true'))}) ORDER BY id DESC LIMIT 10"


def _wcc_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The parties' components from files of a quarter each, taken in one after the other."""
    quarter = F.quarter("arrival_date_actual").alias("part")
    rows = B.container_rows(V.shipments(spark, sf)).select("shipper_name", "consignee_name", "notify_party_name", quarter)
    ends = lambda a, key_a, b, key_b: rows.select("part", F.concat(F.lit(f"{a}:"), key_a).alias("src"), F.concat(F.lit(f"{b}:"), key_b).alias("dst"))
    links = ends("Shipper", "shipper_name", "Consignee", "consignee_name").unionByName(ends("NotifyParty", "notify_party_name", "Consignee", "consignee_name"))
    path = f"{work_dir(spark)}/wcc-stream-{uuid.uuid4().hex[:12]}"
    links.na.drop().distinct().repartition("part").write.partitionBy("part").parquet(f"{path}/files")
    return ComponentStream(spark, path).run(f"{path}/files")


Q.QUERIES["gra02_wcc_stream"] = _wcc_stream
_STREAM_SQL = Q.ORACLE_SQL["gra02_wcc"].replace("SELECT id, component, count(*) OVER (PARTITION BY component) AS size FROM", "SELECT id AS node, component FROM")
# nodes without a link to another node are in no file
Q.ORACLE_SQL["gra02_wcc_stream"] = f"{_STREAM_SQL} WHERE id IN (SELECT src FROM e UNION ALL SELECT dst FROM e)"
