"""Full-text search over names, with BM25 in SQL beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..graph.fulltext import B, K1, PLACES, build_index, search
from ..graph.vector_knn import nearest
from . import fixtures as V
from .queries import ORACLE_SQL, QUERIES

TOP = 10

#: Names with addresses of the parties and vessels of the shipments, as nodes of the graph.
NAMES = """
SELECT DISTINCT concat('Consignee:', c_name) AS id, concat(c_name, ' ', c_mktsegment, ' ', n_name) AS text FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION SELECT DISTINCT concat('Shipper:', s_name), concat(s_name, ' ', n_name) FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION SELECT DISTINCT concat('Vessel:', upper(p_name)), upper(p_name) FROM {part}
"""
#: Each 50th consignee's address, and each vessel's name.
NAME_QUERIES = """
SELECT concat('q', CAST(c_custkey AS STRING)) AS query, concat(n_name, ' ', c_mktsegment) AS asked FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_custkey % 50 = 0
UNION SELECT DISTINCT concat('v', p_name), p_name FROM {part}
"""
#: Clients of a shop, whose names are misspelt, turned around, cut or missing.
CLIENTS = "SELECT client_id AS id, concat(coalesce(name, ''), ' ', coalesce(city, '')) AS text FROM {clients}"
CLIENT_QUERIES = "SELECT client_id AS query, coalesce(name, '') AS asked FROM {clients} WHERE client_id % 50 = 0"


def _register(name: str, rows: str, queries: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = build_index(V.view(spark, sf, rows), ["id"], ["text"])
        return search(index, V.view(spark, sf, queries), "query", "asked", TOP)

    QUERIES[name] = run
    terms = lambda c: rf"unnest(list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> ''))"
    ORACLE_SQL[name] = f"""
WITH d AS ({V.oracle_text(rows)}), w AS (SELECT id, {terms('text')} AS term FROM d),
  tf AS (SELECT id, term, count(*) AS tf FROM w GROUP BY 1, 2), len AS (SELECT id, count(*) AS len FROM w GROUP BY 1),
  n AS (SELECT (SELECT count(*) FROM d) AS n, (SELECT count(*) FROM w) / (SELECT count(*) FROM d) AS mean),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  q AS (SELECT DISTINCT query, {terms('asked')} AS term FROM ({V.oracle_text(queries)})),
  s AS (SELECT query, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + {K1} * (1 - {B} + {B} * len / mean))), {PLACES}) AS score
        FROM q JOIN tf USING (term) JOIN df USING (term) JOIN len USING (id), n GROUP BY 1, 2)
SELECT query, rank, id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS INT) AS rank FROM s) WHERE rank <= {TOP}"""


_register("fts01_party_names", NAMES, NAME_QUERIES)
_register("fts02_client_names", CLIENTS, CLIENT_QUERIES)


#: Neighbours over whole vectors (a search, held to a recall of 0.9 against all pairs by the tests).
QUERIES["gra11_knn_vectors"] = lambda spark, sf: nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), "embedding", 14, id_col="vec_id")
