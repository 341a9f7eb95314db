"""A query for each operator, with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.company_words import LONG_WORDS, STOP_WORDS
from ..functions.transliterate import ascii_text
from ..graph import algorithms as G
from ..graph import build as B
from ..graph import communities as K
from ..graph import paths
from ..graph.project import Projection
from ..operators import cleaning as C
from ..operators import matching as M
from ..operators import metrics
from ..session import if_small, materialize
from . import fixtures as V
from . import marts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Text columns with the faults that the cleaning operators mend.
DIRTY = """
SELECT l_orderkey * 10 + l_linenumber AS id,
  CASE l_orderkey % 6 WHEN 0 THEN '?' WHEN 1 THEN '????' WHEN 2 THEN '################' WHEN 3 THEN NULL ELSE l_returnflag END AS token_text,
  CASE l_orderkey % 5 WHEN 0 THEN ' 12 ' WHEN 1 THEN '12.5' WHEN 2 THEN 'x1' WHEN 3 THEN '1_000' ELSE CAST(l_partkey AS STRING) END AS int_text,
  CASE WHEN l_linenumber = 3 THEN 'NODELIM' ELSE concat('BR', CAST(l_partkey % 25 AS STRING), ' - LINE.', CAST(l_suppkey % 10 AS STRING), '!') END AS combined,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE concat('A', CAST(l_partkey % 5 AS STRING), ', B', CAST(l_suppkey % 3 AS STRING), ',, A', CAST(l_partkey % 5 AS STRING), ' ,') END AS list_text,
  concat('<p>', l_returnflag, '</p><br>é', CAST(l_linenumber AS STRING), '<p>', l_returnflag, '</p>') AS tagged,
  CASE l_linenumber % 3 WHEN 0 THEN 'nan' WHEN 1 THEN '2001-02-30' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS day_text,
  l_linenumber, l_quantity - 25 AS signed, CAST(l_shipdate AS DATE) AS day, l_suppkey, l_partkey
FROM {lineitem}
"""


def query(name: str, sql: str | None = None, **views: str):
    """Registers a query over the shipments (or over the first of ``views``)."""

    def wrap(fn: Callable[[DataFrame], DataFrame]):
        text = next(iter(views.values())) if views else V.SHIPMENTS
        QUERIES[name] = lambda spark, sf_dir: fn(V.view(spark, sf_dir, text))
        if sql is not None:
            ORACLE_SQL[name] = V.oracle(sql, **views)
        return fn

    return wrap


def dirty(name: str, sql: str | None = None):
    return query(name, sql, dirty=DIRTY)


# -- scans and projections ----------------------------------------------------


@dirty("src03_null_tokens", "SELECT id, CASE WHEN trim(token_text) IN ('?', '??', '???', '????', '################') THEN NULL ELSE token_text END AS token_text FROM dirty")
def _(d):
    return d.select("id", X.null_tokens("token_text").alias("token_text"))


@dirty("src04_drop_all_null", "SELECT a, b FROM (SELECT CASE WHEN trim(token_text) LIKE '?%' OR token_text LIKE '#%' THEN NULL ELSE token_text END AS a, list_text AS b FROM dirty) WHERE a IS NOT NULL OR b IS NOT NULL")
def _(d):
    return d.select(X.null_tokens("token_text").alias("a"), F.col("list_text").alias("b")).na.drop("all")


@dirty("src08_dedupe_rows", "SELECT DISTINCT token_text, list_text, l_linenumber FROM dirty")
def _(d):
    return C.drop_duplicated(d.select("token_text", "list_text", "l_linenumber"))


QUERIES["src12_processed_scan"] = lambda spark, sf: _processed(spark, sf)
ORACLE_SQL["src12_processed_scan"] = "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem"


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.scan import read_processed

    return read_processed(spark, f"{sf}/lineitem.parquet", ["l_suppkey", "l_returnflag", "l_linestatus"], dedupe=True)


@dirty("prj01_split_in_two", r"SELECT id, trim(split_part(combined, ' - ', 1)) AS code, CASE WHEN strpos(combined, ' - ') > 0 THEN trim(regexp_replace(split_part(combined, ' - ', 2), '[^\w\s]+', '', 'g')) END AS name FROM dirty")
def _(d):
    return C.split_column(d.select("id", "combined"), "combined", "code", "name", " - ")


_LISTED = r"list_filter(string_split(regexp_replace(list_text, '\s+', '', 'g'), ','), lambda x: x <> '')"


@dirty("prj03_listed", f"SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ', ') AS list_text FROM (SELECT id, {_LISTED} AS l FROM dirty)")
def _(d):
    return C.normalise_lists(d.select("id", "list_text"), ["list_text"])


@dirty("prj04_vessel_type", "SELECT id, CASE WHEN l_linenumber = 1 THEN 'container_ship' ELSE 'non_container_ship' END AS vessel_type FROM dirty")
def _(d):
    return d.select("id", X.vessel_type_of(F.when(F.col("l_linenumber") == 1, 10).when(F.col("l_linenumber") == 2, 11)).alias("vessel_type"))


@dirty("prj05_valid_int", r"SELECT id, regexp_matches(int_text, '^\s*[+-]?\d+(_\d+)*\s*$') AS valid FROM dirty")
def _(d):
    return d.select("id", X.valid_int("int_text").alias("valid"))


@dirty("prj06_exclusive_keys", r"SELECT id, CASE WHEN regexp_matches(int_text, '^\s*[+-]?\d+(_\d+)*\s*$') THEN int_text END AS vessel_imo, CASE WHEN NOT regexp_matches(int_text, '^\s*[+-]?\d+(_\d+)*\s*$') THEN upper(trim(int_text)) END AS vessel_name FROM dirty")
def _(d):
    rows = d.select("id", F.col("int_text").alias("vessel_code"), F.col("int_text").alias("vessel_name"), F.lit(10).alias("mode_of_transportation"))
    return C.clean_vessel_keys(rows).select("id", "vessel_imo", "vessel_name")


@dirty("prj07_coalesce", "SELECT id, coalesce(list_text, combined) AS name FROM dirty")
def _(d):
    return d.select("id", F.coalesce("list_text", "combined").alias("name"))


@dirty("prj08_digits_to_null", r"SELECT id, CASE WHEN NOT regexp_matches(int_text, '^\d+$') THEN int_text END AS x FROM dirty")
def _(d):
    return d.select("id", X.digits_to_null("int_text").alias("x"))


@dirty("prj09_upper_trim", "SELECT id, upper(trim(int_text)) AS x FROM dirty")
def _(d):
    return d.select("id", F.upper(F.trim("int_text")).alias("x"))


@dirty("prj10_abs", "SELECT id, abs(signed) AS x FROM dirty")
def _(d):
    return d.select("id", F.abs("signed").alias("x"))


@dirty("prj12_to_number", "SELECT id, CASE WHEN int_text LIKE '%\\_%' ESCAPE '\\' THEN NULL ELSE TRY_CAST(int_text AS DOUBLE) END AS x FROM dirty")
def _(d):
    return C.coerce(d, numbers=["int_text"]).select("id", F.col("int_text").alias("x"))


@dirty("prj13_to_text", "SELECT id, CAST(CAST(trunc(signed) AS BIGINT) AS VARCHAR) AS a, CASE WHEN day_text = 'nan' THEN NULL ELSE day_text END AS b FROM dirty")
def _(d):
    return d.select("id", X.to_text("signed", as_int=True).alias("a"), X.to_text("day_text").alias("b"))


@dirty("prj14_to_date", "SELECT id, TRY_CAST(day_text AS DATE) AS x FROM dirty")
def _(d):
    return C.coerce(d, days=["day_text"]).select("id", F.col("day_text").alias("x"))


@dirty("prj16_detect_dates", "SELECT id, CAST(a AS TIMESTAMP) AS a, b FROM (SELECT id, CAST(day AS VARCHAR) AS a, day_text AS b FROM dirty)")
def _(d):
    return C.detect_dates(d.select("id", F.col("day").cast("string").alias("a"), F.col("day_text").alias("b")))


_TOKENS = ("?", "????", "################", "A", "N", "R")


@dirty("prj17_one_hot", "SELECT id, " + ", ".join(f"CAST(coalesce(token_text = '{t}', false) AS INT) AS \"t_{t}\"" for t in _TOKENS) + " FROM dirty")
def _(d):
    return C.one_hot(d.select("id", F.col("token_text").alias("t")), ["t"])


@dirty("prj18_plain_types", "SELECT id, CAST(l_linenumber AS BIGINT) AS a, CAST(CASE WHEN l_linenumber > 3 THEN l_linenumber END AS DOUBLE) AS b FROM dirty")
def _(d):
    return C.plain_types(d.select("id", F.col("l_linenumber").alias("a"), F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("b")))


@dirty("prj20_sorted_columns", "SELECT combined, id, token_text FROM dirty")
def _(d):
    return C.sorted_columns(d.select("token_text", "id", "combined"))


QUERIES["prj19_mixed_types"] = lambda spark, sf: spark.createDataFrame([(c,) for c in C.mixed_types(V.view(spark, sf, DIRTY))], "column_name string")
ORACLE_SQL["prj19_mixed_types"] = V.oracle(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name FROM dirty HAVING count(TRY_CAST({c} AS DOUBLE)) > 0 AND count(TRY_CAST({c} AS DOUBLE)) < count({c})" for c in ("token_text", "int_text", "combined", "list_text", "tagged", "day_text")),
    dirty=DIRTY,
)

# -- filters, joins -----------------------------------------------------------


@query("flt01_container_ships", "SELECT shipment_id, consignee_name FROM shipments WHERE vessel_type = 'container_ship'")
def _(s):
    return B.container_rows(s).select("shipment_id", "consignee_name")


@query("flt02_since", "SELECT shipment_id, arrival_date_actual FROM shipments WHERE arrival_date_actual >= DATE '1998-01-01' AND arrival_date_estimate >= DATE '1998-01-01' AND arrival_date_estimate_dirty >= DATE '1998-01-01'")
def _(s):
    since = F.lit("1998-01-01").cast("date")
    return s.filter((F.col("arrival_date_actual") >= since) & (F.col("arrival_date_estimate") >= since) & (F.col("arrival_date_estimate_dirty") >= since)).select("shipment_id", "arrival_date_actual")


@query("flt04_predicates", "SELECT shipment_id, carrier_code FROM shipments WHERE consignee_name IS NOT NULL AND carrier_code IN ('Brand#11', 'Brand#12', 'Brand#13') AND quantity > 10 AND quantity < 40 AND starts_with(vessel_name, 'S')")
def _(s):
    return s.filter(F.col("consignee_name").isNotNull() & F.col("carrier_code").isin("Brand#11", "Brand#12", "Brand#13") & (F.col("quantity") > 10) & (F.col("quantity") < 40) & F.startswith("vessel_name", F.lit("S"))).select("shipment_id", "carrier_code")


@query("flt06_sample", None)
def _(s):
    return C.sample_rows(s.select("shipment_id", "carrier_code"), 1000)


QUERIES["joi01_registry_by_imo"] = lambda spark, sf: _by_imo(spark, sf)
ORACLE_SQL["joi01_registry_by_imo"] = V.oracle(
    """, one AS (SELECT min(vessel_name) AS registry_name, vessel_imo AS imo FROM registry GROUP BY vessel_imo)
SELECT shipment_id, vessel_imo, registry_name FROM shipments LEFT JOIN one ON vessel_imo = imo""",
    registry=V.REGISTRY,
)


def _by_imo(spark: SparkSession, sf: str) -> DataFrame:
    one = V.view(spark, sf, V.REGISTRY).groupBy(F.col("vessel_imo").alias("imo")).agg(F.min("vessel_name").alias("registry_name"))
    s = V.shipments(spark, sf).select("shipment_id", "vessel_imo")
    return s.join(if_small(one), F.col("vessel_imo") == F.col("imo"), "left").drop("imo")


QUERIES["prt01_port_enrichment"] = lambda spark, sf: C.enrich_ports(V.shipments(spark, sf).select("shipment_id", "port_of_lading_code"), V.view(spark, sf, V.PORTS), "port_of_lading")
ORACLE_SQL["prt01_port_enrichment"] = V.oracle("SELECT shipment_id, port_of_lading_code, lat AS port_of_lading_lat, lon AS port_of_lading_lon, country AS port_of_lading_country, continent AS port_of_lading_continent FROM shipments LEFT JOIN ports ON port_of_lading_code = port_code", ports=V.PORTS)

QUERIES["hsc01_hscodes"] = lambda spark, sf: C.enrich_hscodes(V.shipments(spark, sf).select("shipment_id", "hscode"), V.view(spark, sf, V.HSCODES))
ORACLE_SQL["hsc01_hscodes"] = V.oracle(
    """, heads AS (SELECT DISTINCT hscode_04 AS h4, hscode_02_desc_short AS d2, hscode_04_desc_short AS d4 FROM hscodes),
  lasts AS (SELECT substr(h4, 1, 2) AS h2, d2 AS f2, d4 AS f4 FROM heads WHERE h4 IN (SELECT split_part(hscode_02_range, ' ', 3) FROM hscodes))
SELECT shipment_id, hscode, CAST(1 AS DOUBLE) AS cargo_count, substr(hscode, 1, 2) AS hscode_02, substr(hscode, 1, 4) AS hscode_04,
  CASE WHEN d2 IS NULL THEN f2 ELSE d2 END AS hscode_02_desc_short, CASE WHEN d2 IS NULL THEN f4 ELSE d4 END AS hscode_04_desc_short
FROM shipments LEFT JOIN heads ON substr(hscode, 1, 4) = h4 LEFT JOIN lasts ON substr(hscode, 1, 2) = h2""",
    hscodes=V.HSCODES,
)


@query("joi11_semi", "SELECT shipment_id FROM shipments WHERE carrier_code IN (SELECT carrier_code FROM shipments WHERE quantity > 49.5 AND port_of_lading_country = 'NATION_3')")
def _(s):
    keys = s.filter("quantity > 49.5 and port_of_lading_country = 'NATION_3'").select("carrier_code").distinct()
    return s.join(keys, "carrier_code", "left_semi").select("shipment_id")


@query("joi12_anti", "SELECT shipment_id FROM shipments WHERE consignee_name NOT IN (SELECT consignee_name FROM shipments WHERE quantity > 49 AND consignee_name IS NOT NULL) OR consignee_name IS NULL")
def _(s):
    return s.join(s.filter("quantity > 49").select("consignee_name").distinct(), "consignee_name", "left_anti").select("shipment_id")


# -- aggregates and windows ---------------------------------------------------

_CS = "FROM shipments WHERE vessel_type = 'container_ship'"


@query("agg01_counts", f"SELECT carrier_code, count(shipment_id) AS n, count(DISTINCT voyage_number) AS voyages, round(sum(cif), 2) AS value, round(avg(quantity), 6) AS quantity {_CS} GROUP BY carrier_code")
def _(s):
    return B.container_rows(s).groupBy("carrier_code").agg(F.count("shipment_id").alias("n"), F.count_distinct("voyage_number").alias("voyages"), F.round(F.sum("cif"), 2).alias("value"), F.round(F.avg("quantity"), 6).alias("quantity"))


@query("agg02_min_max", "SELECT carrier_code, min(teu) AS lo, max(teu) AS hi, round(avg(teu), 6) AS mean, count(*) AS n, count(*) FILTER (arrival_date_delay > 0) AS late FROM shipments GROUP BY carrier_code")
def _(s):
    return s.groupBy("carrier_code").agg(F.min("teu").alias("lo"), F.max("teu").alias("hi"), F.round(F.avg("teu"), 6).alias("mean"), F.count("*").alias("n"), F.count_if(F.col("arrival_date_delay") > 0).alias("late"))


@query("agg04_last_first", "SELECT shipper_name, arg_max(cargo_count, {'d': arrival_date_actual, 'x': cargo_count}) FILTER (cargo_count IS NOT NULL) AS last, arg_min(cargo_count, {'d': arrival_date_actual, 'x': cargo_count}) FILTER (cargo_count IS NOT NULL) AS first FROM shipments GROUP BY shipper_name")
def _(s):
    return s.groupBy("shipper_name").agg(X.last_of("cargo_count", "arrival_date_actual").alias("last"), X.first_of("cargo_count", "arrival_date_actual").alias("first"))


@query("agg06_quantiles", "SELECT consignee_name, quantile_cont(arrival_date_delay, 0.5) AS q50, round(quantile_cont(arrival_date_delay, 0.95), 6) AS q95 FROM shipments GROUP BY consignee_name")
def _(s):
    return s.groupBy("consignee_name").agg(F.percentile("arrival_date_delay", 0.5).alias("q50"), F.round(F.percentile("arrival_date_delay", 0.95), 6).alias("q95"))


@query("agg07_names_per_key", "SELECT vessel_imo, count(DISTINCT vessel_name) + max(CASE WHEN vessel_name IS NULL THEN 1 ELSE 0 END) AS names FROM shipments GROUP BY vessel_imo")
def _(s):
    return s.groupBy("vessel_imo").agg((F.count_distinct("vessel_name") + F.max(F.col("vessel_name").isNull().cast("int"))).alias("names"))


_EXPLODED = "SELECT DISTINCT {keys}, arrival_date_actual, unnest(string_split(coalesce(container_id, 'XXXXXXXXXXX'), ', ')) AS c {rows}"


@query("agg08_containers", f"SELECT carrier_code, count(*) AS container_count FROM ({_EXPLODED.format(keys='carrier_code', rows=_CS)}) GROUP BY carrier_code")
def _(s):
    return B.containers_per(B.container_rows(s), "carrier_code")


@query("agg13_zscores", "SELECT shipment_id, cif, abs(cif - (SELECT avg(cif) FROM shipments)) > 1.5 * (SELECT stddev_samp(cif) FROM shipments) AS cif_outlier FROM shipments")
def _(s):
    return C.zscore_mask(s.select("shipment_id", "cif"), ["cif"], 1.5)


@query("agg16_null_counts", "SELECT shipment_id, CAST(consignee_name IS NULL AS INT) + CAST(notify_party_name IS NULL AS INT) + CAST(container_id IS NULL AS INT) + CAST(cargo_count IS NULL AS INT) AS nulls FROM shipments")
def _(s):
    cols = ("consignee_name", "notify_party_name", "container_id", "cargo_count")
    return s.select("shipment_id", sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0)).alias("nulls"))


@query("agg17_correlation", "SELECT round(corr(quantity, cif), 6) AS r, round(stddev_samp(cif), 4) AS s FROM shipments")
def _(s):
    return s.agg(F.round(F.corr("quantity", "cif"), 6).alias("r"), F.round(F.stddev_samp("cif"), 4).alias("s"))


@query(
    "win01_fill_imo_and_name",
    """, i AS (SELECT vessel_name AS k, min(vessel_imo) AS v FROM shipments WHERE vessel_imo IS NOT NULL GROUP BY 1)
SELECT shipment_id, coalesce(vessel_imo, v) AS vessel_imo, vessel_name FROM shipments LEFT JOIN i ON vessel_name = k""",
)
def _(s):
    return C.fill_each_other(s.select("shipment_id", "vessel_imo", "vessel_name"))


@query("win03_last_address", "SELECT shipment_id, last_value(shipper_address) OVER (PARTITION BY shipper_name ORDER BY arrival_date_actual, shipper_address ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS address_last FROM shipments")
def _(s):
    last = s.groupBy("shipper_name").agg(X.last_of("shipper_address", "arrival_date_actual").alias("address_last"))
    return s.select("shipment_id", "shipper_name").join(last, "shipper_name", "left").select("shipment_id", "address_last")


@query("win05_group_size", "SELECT shipment_id, count(*) OVER (PARTITION BY carrier_code) AS size FROM shipments")
def _(s):
    return s.select("shipment_id", "carrier_code").join(s.groupBy("carrier_code").agg(F.count("*").alias("size")), "carrier_code").select("shipment_id", "size")


@query("win06_top_k", "SELECT src, dst, score FROM (SELECT shipper_name AS src, carrier_code AS dst, count(*) AS score, row_number() OVER (PARTITION BY shipper_name ORDER BY count(*) DESC, carrier_code) AS r FROM shipments GROUP BY 1, 2) WHERE r <= 3")
def _(s):
    return G.top_k(s.groupBy(F.col("shipper_name").alias("src"), F.col("carrier_code").alias("dst")).agg(F.count("*").alias("score")), 3)


@query("srt03_top_consignees", "SELECT consignee_name, count(*) AS n FROM shipments GROUP BY 1 ORDER BY n DESC, consignee_name NULLS FIRST LIMIT 25")
def _(s):
    return s.groupBy("consignee_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("consignee_name")).limit(25)


@query("ddp01_first_of_key", "SELECT carrier_code, vessel_name, min(shipment_id) AS shipment_id FROM shipments GROUP BY 1, 2")
def _(s):
    return C.drop_duplicated(s.select("carrier_code", "vessel_name", "shipment_id"), ["carrier_code", "vessel_name"], ["shipment_id"])


@query(
    "ddp03_id_name_mismatches",
    """, d AS (SELECT shipment_id % 5000 AS k, consignee_name, notify_party_name FROM shipments),
  bad AS (SELECT k FROM d GROUP BY k HAVING count(DISTINCT consignee_name) + max(CASE WHEN consignee_name IS NULL THEN 1 ELSE 0 END) > 1)
SELECT * FROM d WHERE k NOT IN (SELECT k FROM bad)
UNION ALL SELECT k, consignee_name, notify_party_name FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY CAST(consignee_name IS NULL AS INT) + CAST(notify_party_name IS NULL AS INT), consignee_name NULLS FIRST, notify_party_name NULLS FIRST) AS r FROM d WHERE k IN (SELECT k FROM bad)) WHERE r = 1""",
)
def _(s):
    return C.drop_mismatches(s.select((F.col("shipment_id") % 5000).alias("k"), "consignee_name", "notify_party_name"), "k", "consignee_name")


@query("set01_union_all", "SELECT port_of_lading_code AS port, 'lading' AS side, count(*) AS n FROM shipments GROUP BY 1 UNION ALL SELECT port_of_unlading_code, 'unlading', count(*) FROM shipments GROUP BY 1")
def _(s):
    part = lambda c, side: s.groupBy(F.col(c).alias("port")).agg(F.lit(side).alias("side"), F.count("*").alias("n"))
    return part("port_of_lading_code", "lading").unionByName(part("port_of_unlading_code", "unlading"))


@query("set03_difference", "SELECT DISTINCT shipper_name AS name FROM shipments EXCEPT SELECT shipper_name FROM shipments WHERE quantity > 49 AND voyage_number < 100")
def _(s):
    return s.select(F.col("shipper_name").alias("name")).distinct().join(s.filter("quantity > 49 and voyage_number < 100").select(F.col("shipper_name").alias("name")).distinct(), "name", "left_anti")


# -- dates, text, numbers -----------------------------------------------------

_MOVED = "CAST({d} + to_months(CAST(({y}) * 12 AS INT)) AS DATE)"


@query(
    "dat01_repair_years",
    f""", a1 AS (SELECT shipment_id, CASE WHEN abs(year(a) - year(m)) > 1 AND abs(datediff('day', e, a)) > 360 THEN {_MOVED.format(d='a', y='year(e) - year(a)')} ELSE a END AS a, e, m FROM
  (SELECT shipment_id, CASE WHEN shipment_id % 9 = 0 THEN CAST(arrival_date_actual + INTERVAL 3 YEAR AS DATE) ELSE arrival_date_actual END AS a, CASE WHEN shipment_id % 7 = 0 THEN CAST(arrival_date_actual - INTERVAL 2 YEAR AS DATE) ELSE arrival_date_estimate END AS e, CAST(date_trunc('month', arrival_date_actual) AS DATE) AS m FROM shipments))
SELECT shipment_id, a AS arrival_date_actual, CASE WHEN abs(year(e) - year(m)) > 1 AND abs(datediff('day', a, e)) > 360 THEN {_MOVED.format(d='e', y='year(a) - year(e)')} ELSE e END AS arrival_date_estimate FROM a1""",
)
def _(s):
    a = F.col("arrival_date_actual")
    rows = s.select("shipment_id", F.when(F.col("shipment_id") % 9 == 0, F.add_months(a, 36)).otherwise(a).alias("arrival_date_actual"), F.when(F.col("shipment_id") % 7 == 0, F.add_months(a, -24)).otherwise(F.col("arrival_date_estimate")).alias("arrival_date_estimate"), F.trunc(a, "MM").alias("report_month"))
    return C.repair_years(rows).drop("report_month")


@query(
    "dat02_repair_delay",
    """, r AS (SELECT shipment_id, arrival_date_actual AS a, arrival_date_estimate_dirty AS e FROM shipments),
  r1 AS (SELECT shipment_id, a, CASE WHEN datediff('day', e, a) < -300 AND (month(a) IN (1, 2, 3) OR month(e) IN (1, 2)) THEN CAST(e - INTERVAL 1 YEAR AS DATE) WHEN datediff('day', e, a) > 300 AND (month(a) IN (1, 2, 3) OR month(e) IN (1, 2)) THEN CAST(e + INTERVAL 1 YEAR AS DATE) ELSE e END AS e FROM r),
  r2 AS (SELECT shipment_id, a, CASE WHEN datediff('day', e, a) > 300 THEN CAST(e + INTERVAL 1 YEAR AS DATE) ELSE e END AS e FROM r1),
  r3 AS (SELECT shipment_id, a, CASE WHEN datediff('day', e, a) < -300 THEN CAST(e - INTERVAL 1 YEAR AS DATE) ELSE e END AS e FROM r2)
SELECT shipment_id, a AS arrival_date_actual, e AS arrival_date_estimate, datediff('day', e, a) AS arrival_date_delay FROM r3""",
)
def _(s):
    return C.repair_delay(s.select("shipment_id", "arrival_date_actual", F.col("arrival_date_estimate_dirty").alias("arrival_date_estimate")))


@query("dat03_month_ends", "SELECT shipment_id, last_day(arrival_date_actual + 1) AS month_end, CAST(date_trunc('month', arrival_date_actual - 1) AS DATE) AS month_start, strftime(arrival_date_actual, '%Y%m') AS month_text, CAST(date_trunc('quarter', arrival_date_actual) AS TIMESTAMP) AS quarter, concat(year(arrival_date_actual), '-', quarter(arrival_date_actual), 'Q') AS quarter_text FROM shipments")
def _(s):
    d = "arrival_date_actual"
    return s.select("shipment_id", X.month_end_after(d).alias("month_end"), X.month_start_before(d).alias("month_start"), X.year_month(d).alias("month_text"), X.quarter(d).alias("quarter"), X.quarter_text(d).alias("quarter_text"))


@dirty("str01_printable", r"SELECT id, regexp_replace(tagged, '[^\x20-\x7E\t\n\r\x0B\x0C]', '', 'g') AS x FROM dirty")
def _(d):
    return d.select("id", X.printable("tagged").alias("x"))


@dirty("str02_untagged", "SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '; ') AS x FROM (SELECT id, list_filter(string_split_regex(tagged, '<.*?>'), lambda x: trim(x) <> '') AS l FROM dirty)")
def _(d):
    return d.select("id", X.untagged("tagged").alias("x"))


@query("str08_wkt_points", "SELECT shipment_id, split_part(substr(port_of_fl_centroid, 8, length(port_of_fl_centroid) - 8), ' ', 2) AS lat, split_part(substr(port_of_fl_centroid, 8, length(port_of_fl_centroid) - 8), ' ', 1) AS lon FROM shipments")
def _(s):
    lat, lon = X.wkt_lat_lon("port_of_fl_centroid")
    return s.select("shipment_id", lat.alias("lat"), lon.alias("lon"))


@query("str09_location_text", "SELECT shipment_id, concat('{latitude: ', CAST(coalesce(port_of_lading_lat, 0) AS VARCHAR), ', longitude: ', CAST(coalesce(port_of_lading_lon, 0) AS VARCHAR), '}') AS location FROM shipments")
def _(s):
    return s.select("shipment_id", X.location_text("port_of_lading_lat", "port_of_lading_lon").alias("location"))


@query("mth01_half_even", "SELECT shipment_id, round_even(quantity / 4, 1) AS a, round_even(quantity / 2, 0) AS b, CASE WHEN arrival_date_delay <= 0 THEN 1.0 ELSE round_even(1 / arrival_date_delay, 4) END AS c FROM shipments")
def _(s):
    return s.select("shipment_id", X.half_even(F.col("quantity") / 4, 1).alias("a"), X.half_even(F.col("quantity") / 2).alias("b"), X.inverse_delay("arrival_date_delay").alias("c"))


@query("mrt09_vessel_utilization", "SELECT shipment_id, CASE WHEN containers_count IS NULL OR containers_count = 0 OR vessel_teu IS NULL OR vessel_teu = 0 THEN NULL WHEN containers_count > vessel_teu THEN 1.0 ELSE containers_count / vessel_teu END AS u FROM shipments")
def _(s):
    return s.select("shipment_id", X.utilization("containers_count", "vessel_teu").alias("u"))


@query("mth05_mape", "SELECT round(avg(abs(cif - quantity * 1500) / greatest(abs(cif), 2.220446049250313e-16)), 8) AS mape FROM shipments")
def _(s):
    return metrics.mape(s.withColumn("p", F.col("quantity") * 1500), "cif", "p").select(F.round("mape", 8).alias("mape"))


@query(
    "mth06_classifier_metrics",
    """, b AS (SELECT arrival_date_delay > 0 AS y, quantity > 25 AS p, quantity / 51 AS q FROM shipments),
  c AS (SELECT count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp, count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (NOT y AND NOT p) AS tn,
    avg(-CASE WHEN y THEN ln(q) ELSE ln(1 - q) END) AS ll, avg((q - CAST(y AS INT)) ** 2) AS br FROM b),
  h AS (SELECT q, count(*) FILTER (y) AS hits, count(*) AS m FROM b GROUP BY q), run AS (SELECT hits, sum(hits) OVER (ORDER BY q DESC) / sum(m) OVER (ORDER BY q DESC) AS pr FROM h), ap AS (SELECT sum(pr * hits) / sum(hits) AS ap FROM run),
  k AS (SELECT *, tp + fp + fn + tn AS n, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / ((tp + fp + fn + tn) ** 2) AS chance FROM c)
SELECT tp, fp, fn, tn, round(ll, 6) AS log_loss, round(br, 6) AS brier, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS auc, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp * tn - fp * fn) / (sqrt((tp + fp) * (tp + fn)) * sqrt((tn + fp) * (tn + fn))), 6) AS mcc,
  round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp), 6) AS precision, round(((tp + tn) / n - chance) / (1 - chance), 6) AS kappa, round(fp / (fp + tn), 6) AS fpr, round(fn / (fn + tp), 6) AS fnr, round(tn / (tn + fp), 6) AS tnr, round(tn / (tn + fn), 6) AS npv, round(fp / (fp + tp), 6) AS fdr, round(ap, 6) AS average_precision FROM k, ap""",
)
def _(s):
    rows = s.select((F.col("arrival_date_delay") > 0).cast("int").alias("y"), (F.col("quantity") > 25).cast("int").alias("p"), (F.col("quantity") / 51).alias("q"))
    m = metrics.binary_metrics(rows, "y", "p", "q")
    return m.select("tp", "fp", "fn", "tn", *(F.round(c, 6).alias(c) for c in m.columns if c not in ("tp", "fp", "fn", "tn")))


@query("out01_quantile_mask", "SELECT shipment_id, cif, cif > (SELECT quantile_cont(cif, 0.99) FROM shipments) AS cif_outlier FROM shipments")
def _(s):
    return C.quantile_mask(s.select("shipment_id", "cif"), ["cif"])[0]


@query("out02_drop_outliers", "SELECT shipment_id, cif FROM shipments WHERE NOT cif > (SELECT quantile_cont(cif, 0.99) FROM shipments)")
def _(s):
    return C.drop_outliers(C.quantile_mask(s.select("shipment_id", "cif"), ["cif"])[0])


@query("out03_winsorise", "SELECT shipment_id, abs(cif) AS cif, least(abs(cif), (SELECT quantile_cont(abs(cif), 0.99) FROM shipments)) AS cif_outliers_off FROM shipments")
def _(s):
    return C.winsorise(s.select("shipment_id", "cif"), ["cif"])


@query(
    "out04_winsorise_weights",
    """, q AS (SELECT quantile_cont(weight, 0.99) AS a, quantile_cont(weight_kg, 0.99) AS b FROM shipments)
SELECT shipment_id, weight, weight_kg, CASE WHEN weight > a THEN least(a, b) ELSE weight END AS weight_outliers_off, CASE WHEN weight_kg > b THEN least(a, b) ELSE weight_kg END AS weight_kg_outliers_off FROM shipments, q""",
)
def _(s):
    return C.winsorise_weights(s.select("shipment_id", "weight", "weight_kg"))


@query("exp01_null_profile", "SELECT \"column\", nulls, round(100 * nulls / n, 4) AS share FROM (SELECT count(*) AS n, count(*) FILTER (consignee_name IS NULL) AS a, count(*) FILTER (notify_party_name IS NULL) AS b, count(*) FILTER (container_id IS NULL) AS c FROM shipments), LATERAL (VALUES ('consignee_name', a), ('notify_party_name', b), ('container_id', c)) t(\"column\", nulls)")
def _(s):
    return C.null_profile(s.select("consignee_name", "notify_party_name", "container_id"))


@query("exp02_preclean", "SELECT shipment_id, cif, quantity FROM shipments WHERE NOT cif > (SELECT quantile_cont(cif, 0.995) FROM shipments)")
def _(s):
    return C.preclean(s.select("shipment_id", "cif", "quantity"), ["cif", "quantity"])


# -- names --------------------------------------------------------------------


def _vessels(spark: SparkSession, sf: str) -> DataFrame:
    s = V.shipments(spark, sf).select("shipment_id", "vessel_imo", "vessel_name", "vessel_type")
    return C.standardise_vessels(s, V.view(spark, sf, V.REGISTRY))


QUERIES["ves01_standardise_vessels"] = _vessels


def _fuzzy(scorer: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        names = V.view(spark, sf, "SELECT DISTINCT upper(p_name) AS vessel_name FROM {part}")
        return M.fuzzy_match(names, V.view(spark, sf, V.REGISTRY).select("vessel_name"), "vessel_name", scorer, 80)

    return run


QUERIES["fuz01_token_sort"] = _fuzzy("token_sort_ratio")
QUERIES["fuz02_two_rounds"] = lambda spark, sf: M.match_names(V.view(spark, sf, "SELECT DISTINCT upper(p_name) AS vessel_name FROM {part}"), V.view(spark, sf, V.REGISTRY).select("vessel_name"), "vessel_name")
#: A shop's client records against the master records: their names are misspelt, turned around, cut or abbreviated, and grow with the table.
CLIENT_RECORDS = "SELECT DISTINCT name FROM {clients} WHERE client_id <> master_id"
CLIENT_MASTERS = "SELECT DISTINCT name FROM {clients} WHERE client_id = master_id"


def _fuzzy_clients(match: Callable[..., DataFrame], *settings):
    return lambda spark, sf: match(V.view(spark, sf, CLIENT_RECORDS), V.view(spark, sf, CLIENT_MASTERS), "name", *settings)


QUERIES["fuz03_client_token_sort"] = _fuzzy_clients(M.fuzzy_match, "token_sort_ratio", 80)
QUERIES["fuz04_client_token_set"] = _fuzzy_clients(M.fuzzy_match, "token_set_ratio", 80)
QUERIES["fuz05_client_two_rounds"] = _fuzzy_clients(M.match_names)

#: Vessels named after the shop's vendors; shipments spell the names by rule: as they are, turned, cut, with a letter doubled, with a title.
FLEET = "SELECT upper(name) AS vessel_name, CAST(9100000 + vendor_id AS STRING) AS vessel_imo, 'container_ship' AS vessel_type FROM {vendors} WHERE name IS NOT NULL"
FLEET_SHIPMENTS = """
SELECT l_orderkey * 10 + l_linenumber AS shipment_id, CASE WHEN l_linenumber = 1 AND l_partkey % 3 = 0 THEN CAST(9100000 + l_suppkey AS STRING) END AS vessel_imo,
  CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN v.name IS NULL THEN upper(p_name) ELSE CASE l_partkey % 7
    WHEN 0 THEN upper(v.name) WHEN 1 THEN concat(split_part(upper(v.name), ' ', 2), ' ', split_part(upper(v.name), ' ', 1))
    WHEN 2 THEN concat(substr(upper(v.name), 1, 3), substr(upper(v.name), 5)) WHEN 3 THEN concat(substr(upper(v.name), 1, 6), substr(upper(v.name), 6))
    WHEN 4 THEN concat('MV ', upper(v.name)) WHEN 5 THEN concat(upper(v.name), ' ', CAST(l_partkey % 11 AS STRING)) ELSE substr(upper(v.name), 1, 9) END END AS vessel_name,
  CASE WHEN l_returnflag <> 'R' THEN 'container_ship' ELSE 'non_container_ship' END AS vessel_type
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey LEFT JOIN {vendors} v ON l_suppkey = v.vendor_id
"""
QUERIES["ves02_standardise_fleet"] = lambda spark, sf: C.standardise_vessels(V.view(spark, sf, FLEET_SHIPMENTS), V.view(spark, sf, FLEET))
QUERIES["str03_prepared_names"] = lambda spark, sf: _companies(spark, sf).select("company", M.prepared_name("company").alias("prepared"))
QUERIES["ngr01_ngram_groups"] = lambda spark, sf: M.ngram_groups(_companies(spark, sf).select(M.prepared_name("company").alias("name")), "name", 3, 0.8)
QUERIES["cmp01_group_companies"] = lambda spark, sf: M.group_companies(_companies(spark, sf), "company", "address")
QUERIES["cmp02_pool_names"] = lambda spark, sf: M.pool_names(_companies(spark, sf).toDF("shipper_name", "shipper_address"), "shipper")

COMPANIES = """
SELECT concat(upper(p_name), CASE p_partkey % 6 WHEN 0 THEN ' CO., LTD.' WHEN 1 THEN ' Company Limited' WHEN 2 THEN ' (HONG KONG) TRADING CO' WHEN 3 THEN ' INTERNATIONAL L.L.C.' WHEN 4 THEN ' S.A. DE C.V.' ELSE ' & SONS 2001' END) AS company,
  concat(p_brand, ' STREET') AS address FROM {part}
"""


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return V.view(spark, sf, COMPANIES).distinct()


def _prepared_sql(name: str, stop_words: bool) -> str:
    """Preparation of ASCII names, step by step."""
    x = f"upper(trim({name}))"
    for pattern, new in ((r"\d{2,}", " "), (r"C\WO", " "), (r"S\W?A\W*DE\W?C\W?V", " SA DE CV "), (r"\W+L\W?L\W?C", " LLC "), (r"\W+U\W?S\W?A", " USA "), (r"\(.*\)", " "), ("&", " AND "), (r"\+", " AND "), ("[^0-9A-Z]", " "), (r"\s+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    if stop_words:
        words = "|".join(sorted(STOP_WORDS, key=lambda w: (-len(w), w))).replace("'", "''")
        x = f"regexp_replace({x}, '\\b(?:{words})\\b', ' ', 'g')"
    x = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    for word, short in LONG_WORDS.items():
        x = f"replace({x}, '{word}', '{short}')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def _prepared_oracle(view: str, stop_words: bool) -> str:
    return V.oracle(f""", p AS (SELECT company, {_prepared_sql('company', stop_words)} AS x FROM (SELECT DISTINCT * FROM companies))
SELECT company, CASE WHEN x <> '' AND x <> 'UNKNOWN' AND NOT regexp_matches(upper(trim(company)), '^\\d+$') THEN x END AS prepared FROM p""", companies=view)


ORACLE_SQL["str03_prepared_names"] = _prepared_oracle(COMPANIES, False)

#: Companies with words of the stop list before and after their names.
ORDERS = """
SELECT concat(CASE p_partkey % 5 WHEN 0 THEN 'TO THE ORDER OF ' WHEN 1 THEN 'ultimate consignee ' WHEN 2 THEN 'UNTO ' ELSE '' END, upper(p_name),
  CASE p_partkey % 4 WHEN 0 THEN ' LIMITED' WHEN 1 THEN ' TRANSITOS' WHEN 2 THEN ' UNLESSER' ELSE ' & VARIOUS CONSIGNEES + CO' END) AS company FROM {part}
"""
QUERIES["str04_stop_words"] = lambda spark, sf: V.view(spark, sf, ORDERS).distinct().select("company", M.prepared_name("company", faithful=False).alias("prepared"))
ORACLE_SQL["str04_stop_words"] = _prepared_oracle(ORDERS, True)

#: Names spelt in Cyrillic, Greek or accented letters, or as they are.
SCRIPTS = """
SELECT CASE p_partkey % 4 WHEN 0 THEN translate(upper(p_name), 'ABVGDJZKLMNOPRSTUFCWYQXE', 'АБВГДЖЗКЛМНОПРСТУФЧЩЯЮХЭ') WHEN 1 THEN translate(upper(p_name), 'ABGDEZHQIKLMNXOPRSTUFCYW', 'ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ')
  WHEN 2 THEN translate(upper(p_name), 'AEIOUCN', 'ÀÉÎÖÜÇÑ') ELSE concat(upper(p_name), ' GROẞ Æ') END AS name FROM {part}
"""
QUERIES["str07_transliterated"] = lambda spark, sf: V.view(spark, sf, SCRIPTS).distinct().select("name", F.upper(ascii_text(F.col("name"))).alias("latin"))
_SPELT = "translate(name, 'АБВГДЗКЛМНОПРСТУФЭΑΒΓΔΕΖΗΙΚΛΜΝΟΠΡΣΤΥΩÀÉÎÖÜÇÑ', 'ABVGDZKLMNOPRSTUFEABGDEZEIKLMNOPRSTUOAEIOUCN')"
for _letter, _text in (("Ж", "ZH"), ("Ч", "CH"), ("Щ", "SHCH"), ("Я", "IA"), ("Ю", "IU"), ("Х", "KH"), ("Θ", "TH"), ("Ξ", "KS"), ("Φ", "PH"), ("Χ", "KH"), ("Ψ", "PS"), ("ẞ", "SS"), ("Æ", "AE")):
    _SPELT = f"replace({_SPELT}, '{_letter}', '{_text}')"
ORACLE_SQL["str07_transliterated"] = V.oracle(f"SELECT DISTINCT name, {_SPELT} AS latin FROM spelt", spelt=SCRIPTS)


# -- graph tables -------------------------------------------------------------

_N = "arrival_date_actual"


def _arg_max(c: str) -> str:
    return f"arg_max({c}, {{'d': {_N}, 'x': {c}}}) FILTER ({c} IS NOT NULL)"


_CARGO_SQL = f"{_arg_max('cargo')} AS cargo_count_last, max(cargo) AS cargo_count_max, round_even(avg(cargo), 1) AS cargo_count_mean, min(cargo) AS cargo_count_min, CAST(sum(cargo) AS BIGINT) AS cargo_count_sum"
_BRIEF_SQL = "count(*) FILTER (arrival_date_delay > 0) AS delay_count, round_even(count(*) FILTER (arrival_date_delay > 0) / count(*), 4) AS delay_count_ratio, CAST(round_even(quantile_cont(arrival_date_delay, 0.5), 0) AS BIGINT) AS delay_days_q50, CAST(round_even(quantile_cont(arrival_date_delay, 0.95), 0) AS BIGINT) AS delay_days_q95, count(*) AS shipment_count, min(arrival_date_actual) AS shipment_date_first, max(arrival_date_actual) AS shipment_date_last"
_DELAYS_SQL = f"{_arg_max('arrival_date_delay')} AS delay_days_last, max(arrival_date_delay) AS delay_days_max, CAST(round_even(avg(arrival_date_delay), 0) AS BIGINT) AS delay_days_mean, min(arrival_date_delay) AS delay_days_min, {_BRIEF_SQL}"
_TEU_SQL = f"{_arg_max('teu')} AS teu_last, max(teu) AS teu_max, round_even(round(sum(teu), 6) / count(teu), 1) AS teu_mean, min(teu) AS teu_min, round(sum(teu), 4) AS teu_sum"
_EDGE_SQL = "CASE WHEN quantile_cont(arrival_date_delay, 0.95) <= 0 THEN 1.0 ELSE round_even(1 / quantile_cont(arrival_date_delay, 0.95), 4) END AS delay_days_q95i, CAST(date_trunc('month', min(arrival_date_actual) - 1) AS DATE) AS valid_from"


def _key_sql(column: str) -> str:
    return f"coalesce({column}, 'N/A')"


def _register_graph_tables() -> None:
    for i, (label, (key, attribute, last)) in enumerate(B.ENTITIES.items(), 1):
        name = f"nod{i:02d}_{label.lower()}"
        QUERIES[name] = lambda spark, sf, label=label: B.entity_nodes(V.shipments(spark, sf), label)
        rows = f"(SELECT *, {_key_sql(key)} AS id, {_key_sql(attribute)} AS attr, CAST(coalesce(cargo_count, 1) AS BIGINT) AS cargo {_CS})"
        ORACLE_SQL[name] = V.oracle(f"SELECT id, {_arg_max('attr')} AS {last}, {_CARGO_SQL}, {_DELAYS_SQL}, {_TEU_SQL}, '{label}' AS label FROM {rows} GROUP BY id")
    for i, (label, port) in enumerate(B.PORTS.items(), 5):
        name = f"nod{i:02d}_{label.lower()}"
        QUERIES[name] = lambda spark, sf, label=label: B.port_nodes(V.shipments(spark, sf), label)
        code = f"{port}_code"
        location = f"concat('{{latitude: ', CAST({port}_lat AS VARCHAR), ', longitude: ', CAST({port}_lon AS VARCHAR), '}}')"
        ORACLE_SQL[name] = V.oracle(
            f"SELECT a.*, container_count FROM (SELECT {code} AS id, {port}_continent AS loc_continent, {port}_country AS loc_country, {location} AS location, {_arg_max(port)} AS name, {_BRIEF_SQL}, round_even(sum(teu), 1) AS teu_sum, '{label}' AS label {_CS} GROUP BY 1, 2, 3, 4) a"
            f" LEFT JOIN (SELECT {code} AS k, count(*) AS container_count FROM ({_EXPLODED.format(keys=code, rows=_CS)}) GROUP BY 1) ON id = k"
        )
    for i, (kind, (source, target, template)) in enumerate(B.EDGES.items(), 1):
        name = f"edg{i:02d}_{kind.lower()}"
        QUERIES[name] = lambda spark, sf, kind=kind: B.edges(V.shipments(spark, sf), kind)
        a, b = _key_sql(B.KEYS[source]), _key_sql(B.KEYS[target])
        rows = f"(SELECT *, {a} AS src, {b} AS dst, CAST(coalesce(cargo_count, 1) AS BIGINT) AS cargo {_CS})"
        if template == "cargo":
            ORACLE_SQL[name] = V.oracle(f"SELECT src, dst, {_CARGO_SQL}, {_DELAYS_SQL}, {_TEU_SQL}, {_EDGE_SQL}, '{kind}' AS type FROM {rows} GROUP BY src, dst")
        else:
            counts = f"SELECT src AS s, dst AS d, count(*) AS container_count FROM ({_EXPLODED.format(keys='src, dst', rows='FROM ' + rows)}) GROUP BY 1, 2"
            ORACLE_SQL[name] = V.oracle(f"SELECT e.*, container_count FROM (SELECT src, dst, {_DELAYS_SQL}, round_even(sum(teu), 1) AS teu_sum, {_EDGE_SQL}, '{kind}' AS type FROM {rows} GROUP BY src, dst) e LEFT JOIN ({counts}) ON src = s AND dst = d")
    for kind, (a, b) in B.RELATIONS.items():
        name = f"ddp02_{kind.lower()}"
        QUERIES[name] = lambda spark, sf, kind=kind: B.relation(V.shipments(spark, sf), kind)
        ORACLE_SQL[name] = V.oracle(f"SELECT DISTINCT CAST({a} AS VARCHAR) AS src, CAST({b} AS VARCHAR) AS dst, '{kind}' AS type FROM shipments WHERE {a} IS NOT NULL AND {b} IS NOT NULL")


_register_graph_tables()

# -- graph algorithms ---------------------------------------------------------


def _graph(spark: SparkSession, sf: str, labels: tuple[str, ...] = (), kinds: tuple[str, ...] = (), weighted: bool = False) -> Projection:
    """Nodes and edges; only ``weighted`` edges have measures."""
    s = materialize(B.container_rows(V.shipments(spark, sf)).select("vessel_type", "consignee_name", "shipper_name", "carrier_code", "notify_party_name", "port_of_lading_code", "port_of_unlading_code", "arrival_date_delay"), "graph")
    edges = B.edge_list(s, *kinds) if weighted else B.edge_pairs(s, *kinds)
    return Projection(materialize(B.node_list(s, *labels), "nodes"), materialize(edges, "edges"))


_PARTIES, _PARTY_EDGES = ("Shipper", "Consignee", "NotifyParty"), ("SHIPS_FOR", "NOTIFY_FOR")


def _parties(spark: SparkSession, sf: str, weighted: bool = False) -> Projection:
    """Parties and their links over all container rows, without missing names."""
    g = _graph(spark, sf, _PARTIES, _PARTY_EDGES, weighted)
    # the nodes hold all ends, and those that stand for a missing name are one for each label
    named = lambda end: ~F.col(end).isin([f"{label}:{B.MISSING}" for label in _PARTIES])
    return Projection(g.nodes.filter(F.col("key") != B.MISSING), g.edges.filter(named("src") & named("dst")))


def _nodes_sql(labels: tuple[str, ...], rows: str = _CS) -> str:
    return " UNION ".join(f"SELECT concat('{x}:', {_key_sql(B.KEYS[x])}) AS id {rows}" for x in labels)


def _edges_sql(kinds: tuple[str, ...], rows: str = _CS) -> str:
    return " UNION ALL ".join(f"SELECT DISTINCT concat('{B.EDGES[k][0]}:', {_key_sql(B.KEYS[B.EDGES[k][0]])}) AS src, concat('{B.EDGES[k][1]}:', {_key_sql(B.KEYS[B.EDGES[k][1]])}) AS dst, '{k}' AS type {rows}" for k in kinds)


_PARTY_SQL = f", n0 AS ({_nodes_sql(_PARTIES)}), n AS (SELECT id FROM n0 WHERE NOT ends_with(id, ':N/A')), e AS (SELECT * FROM ({_edges_sql(_PARTY_EDGES)}) WHERE src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n))"

QUERIES["gra01_degree"] = lambda spark, sf: G.degree(_graph(spark, sf))
ORACLE_SQL["gra01_degree"] = V.oracle(f", n AS ({_nodes_sql(tuple(B.KEYS))}), e AS ({_edges_sql(tuple(B.EDGES))}) SELECT id, coalesce(d, 0) AS degree FROM n LEFT JOIN (SELECT v, count(*) AS d FROM (SELECT src AS v FROM e UNION ALL SELECT dst FROM e) GROUP BY v) ON id = v")

_WCC_SQL = """, b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"""
QUERIES["gra02_wcc"] = lambda spark, sf: G.wcc(_parties(spark, sf))
QUERIES["gra03_scc"] = lambda spark, sf: G.scc(_parties(spark, sf).with_reverse())
_RECURSIVE = _PARTY_SQL + _WCC_SQL + """, r AS (SELECT id, id AS c FROM n UNION SELECT b.dst, r.c FROM r JOIN b ON r.id = b.src WHERE r.c < b.dst)
SELECT id, component, count(*) OVER (PARTITION BY component) AS size FROM (SELECT id, min(c) AS component FROM r GROUP BY id)"""
ORACLE_SQL["gra02_wcc"] = V.oracle(_RECURSIVE).replace("WITH ", "WITH RECURSIVE ", 1)
ORACLE_SQL["gra03_scc"] = ORACLE_SQL["gra02_wcc"]  # with every edge reversed as well, both are the same
QUERIES["gra04_label_propagation"] = lambda spark, sf: G.label_propagation(_parties(spark, sf))
_LPA_ROUND = ", l{j} AS (SELECT id, coalesce(new, c) AS c FROM l{i} LEFT JOIN (SELECT v, arg_min(c, {{'n': -m, 'c': c}}) AS new FROM (SELECT dst AS v, c, count(*) AS m FROM both_ends JOIN l{i} ON src = id GROUP BY 1, 2) GROUP BY v) ON id = v)"
ORACLE_SQL["gra04_label_propagation"] = V.oracle(_PARTY_SQL + ", both_ends AS MATERIALIZED (SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e), l0 AS (SELECT id, id AS c FROM n)" + "".join(_LPA_ROUND.format(i=i, j=i + 1).replace(f"l{i + 1} AS (", f"l{i + 1} AS MATERIALIZED (") for i in range(10)) + " SELECT id, c AS community, count(*) OVER (PARTITION BY c) AS size FROM l10")


#: Ends of a level: sweeps and least growth of modularity, the published defaults of the method.
LEVEL_ENDS = {"sweeps": 10, "tolerance": 1e-4}
QUERIES["gra05_louvain"] = lambda spark, sf: K.louvain(_parties(spark, sf), **LEVEL_ENDS)
#: The reference's resolution for Leiden.
GAMMA = 5000.0
QUERIES["gra06_leiden"] = lambda spark, sf: K.leiden(_parties(spark, sf), gamma=GAMMA)
#: At the resolution 1, communities have many members.
QUERIES["gra06_leiden_wide"] = lambda spark, sf: K.leiden(_parties(spark, sf), levels=2, **LEVEL_ENDS)
QUERIES["gra10_betweenness"] = lambda spark, sf: paths.betweenness(_parties(spark, sf)).withColumn("betweenness", F.round("betweenness", 6))
QUERIES["gra14_without_missing_names"] = lambda spark, sf: _graph(spark, sf, _PARTIES, _PARTY_EDGES).named().nodes.select("id")
ORACLE_SQL["gra14_without_missing_names"] = V.oracle(f", n0 AS ({_nodes_sql(_PARTIES)}) SELECT id FROM n0 WHERE NOT ends_with(id, ':N/A')")
QUERIES["adm_counts_by_label"] = lambda spark, sf: _graph(spark, sf).nodes.groupBy("label").agg(F.count("*").alias("n"))
ORACLE_SQL["adm_counts_by_label"] = V.oracle(f", n0 AS ({_nodes_sql(tuple(B.KEYS))}) SELECT split_part(id, ':', 1) AS label, count(*) AS n FROM n0 GROUP BY 1")
QUERIES["adm_counts_by_type"] = lambda spark, sf: _graph(spark, sf).edges.groupBy("type").agg(F.count("*").alias("n"))
ORACLE_SQL["adm_counts_by_type"] = V.oracle(f"SELECT type, count(*) AS n FROM ({_edges_sql(tuple(B.EDGES))}) GROUP BY type")


def _ranked(kinds: tuple[str, ...], labels: tuple[str, ...], weight: str | None = None, scaled: bool = False, directed: bool = True):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = G.pagerank(_graph(spark, sf, labels, kinds, weighted=weight is not None), weight, directed=directed)
        out = G.min_max(out) if scaled else out
        return out.select("id", *(F.round(c, 6).alias(c) for c in out.columns if c != "id"))

    return run


_LADING = (("CARRIES_FROM", "SHIPS_FROM"), ("Carrier", "Shipper", "PortOfLading"))
_UNLADING = (("CARRIES_TO", "SHIPS_TO"), ("Carrier", "Shipper", "PortOfUnlading"))
for _side, _spec in (("lading", _LADING), ("unlading", _UNLADING)):
    QUERIES[f"gra07_pagerank_ports_{_side}"] = _ranked(*_spec)
    QUERIES[f"gra07_pagerank_ports_{_side}_weighted"] = _ranked(*_spec, weight="weight", scaled=True)
    # edges only run from carriers and shippers to ports, so one step is the fixed point
    ORACLE_SQL[f"gra07_pagerank_ports_{_side}"] = V.oracle(
        f""", n AS ({_nodes_sql(_spec[1])}), e AS ({_edges_sql(_spec[0])}), o AS (SELECT src AS s, count(*) AS k FROM e GROUP BY src)
SELECT id, round(0.15 + coalesce(g, 0), 6) AS rank FROM n LEFT JOIN (SELECT dst, sum(0.85 * 0.15 / k) AS g FROM e JOIN o ON src = s GROUP BY dst) ON id = dst"""
    )
    # weighted: a carrier's or shipper's rank is shared by weight; scaled over all nodes
    _shares = " UNION ALL ".join(f"SELECT concat('{B.EDGES[k][0]}:', {_key_sql(B.KEYS[B.EDGES[k][0]])}) AS src, concat('{B.EDGES[k][1]}:', {_key_sql(B.KEYS[B.EDGES[k][1]])}) AS dst, CASE WHEN quantile_cont(arrival_date_delay, 0.95) <= 0 THEN 1.0 ELSE round_even(1 / quantile_cont(arrival_date_delay, 0.95), 4) END AS w {_CS} GROUP BY 1, 2" for k in _spec[0])
    ORACLE_SQL[f"gra07_pagerank_ports_{_side}_weighted"] = V.oracle(
        f""", n AS ({_nodes_sql(_spec[1])}), e AS ({_shares}), o AS (SELECT src AS s, sum(w) AS k FROM e GROUP BY src),
  r AS (SELECT id, 0.15 + coalesce(g, 0) AS rank FROM n LEFT JOIN (SELECT dst, sum(0.85 * 0.15 * w / k) AS g FROM e JOIN o ON src = s GROUP BY dst) ON id = dst)
SELECT id, round(rank, 6) AS rank, round((rank - (SELECT min(rank) FROM r)) / (SELECT max(rank) - min(rank) FROM r), 6) AS rank_scaled FROM r"""
    )
_CARRIERS = (("Carrier", "Shipper", "PortOfLading", "PortOfUnlading"), ("CARRIES_FROM", "CARRIES_TO", "SHIPS_BY"))
QUERIES["gra08_pagerank_carriers"] = lambda spark, sf: G.pagerank_if_connected(_graph(spark, sf, *_CARRIERS), directed=False)
#: Rounds of the queries whose SQL is unrolled.
RANK_ROUNDS = 6


def _rank_rounds_sql(rounds: int = RANK_ROUNDS, weight: str = "1.0") -> str:
    """PageRank from the CTEs n(id) and e(src, dst, ...), both directions counted, round by round."""
    both = f", w AS MATERIALIZED (SELECT src, dst, sum(w) AS w FROM (SELECT src, dst, {weight} AS w FROM e UNION ALL SELECT dst, src, {weight} FROM e) GROUP BY 1, 2), o AS MATERIALIZED (SELECT src AS s, sum(w) AS k FROM w GROUP BY 1), r0 AS (SELECT id, 0.15 AS rank FROM n)"
    step = ", r{j} AS MATERIALIZED (SELECT id, 0.15 + coalesce(g, 0) AS rank FROM n LEFT JOIN (SELECT dst, sum(0.85 * rank * w / k) AS g FROM w JOIN o ON src = s JOIN r{i} ON src = id GROUP BY dst) ON id = dst)"
    return both + "".join(step.format(i=i, j=i + 1) for i in range(rounds))


#: Carriers, shippers and ports, ranked in rounds over links of both directions: nodes pass on what they got.
QUERIES["gra08_pagerank_rounds"] = lambda spark, sf: G.pagerank(_graph(spark, sf, *_CARRIERS), directed=False, iterations=RANK_ROUNDS, tolerance=0.0).withColumn("rank", F.round("rank", 6))
ORACLE_SQL["gra08_pagerank_rounds"] = V.oracle(f", n AS ({_nodes_sql(_CARRIERS[0])}), e AS ({_edges_sql(_CARRIERS[1])}){_rank_rounds_sql()} SELECT id, round(rank, 6) AS rank FROM r{RANK_ROUNDS}")

#: Parties in communities that SQL can find and that aren't trivial: the last digits of their names.
_DIGIT = "substr(id, length(id) - 1, 1)"


def _ranked_by_digit(spark: SparkSession, sf: str) -> DataFrame:
    g = _parties(spark, sf)
    return G.pagerank_in_communities(g, g.nodes.select("id", F.expr(_DIGIT).alias("community")), directed=False, iterations=RANK_ROUNDS, tolerance=0.0)


_BY_DIGIT = V.oracle(
    _PARTY_SQL.replace(", e AS (", ", e0 AS (") + f", e AS (SELECT * FROM e0 WHERE {_DIGIT.replace('id', 'src')} = {_DIGIT.replace('id', 'dst')}){_rank_rounds_sql()}"
    f", c AS (SELECT id, rank, {_DIGIT} AS community FROM r{RANK_ROUNDS}), z AS (SELECT community, count(*) AS size, min(rank) AS lo, max(rank) AS hi FROM c GROUP BY 1)"
    ", s AS (SELECT id, community, size, CASE WHEN size > 1 THEN rank ELSE 0 END AS rank, CASE WHEN size > 1 AND hi > lo THEN (rank - lo) / (hi - lo) ELSE 0 END AS rank_scaled FROM c JOIN z USING (community))"
)
QUERIES["gra09_ranked_by_digit"] = lambda spark, sf: _ranked_by_digit(spark, sf).select("id", "community", F.round("rank", 6).alias("rank"), F.round("rank_scaled", 5).alias("rank_scaled"))
ORACLE_SQL["gra09_ranked_by_digit"] = f"{_BY_DIGIT} SELECT id, community, round(rank, 6) AS rank, round(rank_scaled, 5) AS rank_scaled FROM s"
QUERIES["gra16_ranks_by_digit"] = lambda spark, sf: G.community_ranks(_ranked_by_digit(spark, sf)).select("community", "size", F.round("rank_min", 6).alias("rank_min"), F.round("rank_max", 6).alias("rank_max"))
ORACLE_SQL["gra16_ranks_by_digit"] = f"{_BY_DIGIT} SELECT community, count(*) AS size, round(min(rank), 6) AS rank_min, round(max(rank), 6) AS rank_max FROM s GROUP BY 1"
QUERIES["gra17_average_by_digit"] = lambda spark, sf: G.community_average(_ranked_by_digit(spark, sf)).select("id", "community", "size", F.round("rank_avg", 0).alias("rank_avg"))
ORACLE_SQL["gra17_average_by_digit"] = f"{_BY_DIGIT} SELECT id, community, size, round(avg(rank) OVER (PARTITION BY community) * 1e6, 0) AS rank_avg FROM s"


def _communities(spark: SparkSession, sf: str) -> tuple[Projection, DataFrame]:
    g = _parties(spark, sf, weighted=True)
    return g, K.leiden(g, gamma=GAMMA).select("id", "community")


QUERIES["gra09_pagerank_entities"] = lambda spark, sf: (lambda gc: G.pagerank_in_communities(*gc, weight="weight"))(_communities(spark, sf))
QUERIES["gra16_community_ranks"] = lambda spark, sf: G.community_ranks(QUERIES["gra09_pagerank_entities"](spark, sf))
QUERIES["gra17_community_average"] = lambda spark, sf: G.community_average(QUERIES["gra09_pagerank_entities"](spark, sf))
#: The reference numbers communities by nodes; of so many there, the ranges of its score go by them.
COMMUNITY_NUMBERS = 2_960_487


def _scored(placed: DataFrame) -> DataFrame:
    """The financial score of the consignees; a community's number is taken from its name."""
    number = F.conv(F.substring(F.md5("community"), 1, 8), 16, 10).cast("long") % COMMUNITY_NUMBERS
    consignees = placed.filter(F.startswith("id", F.lit("Consignee:")))
    return G.financial_score(consignees.select("id", number.alias("community"), F.split_part("id", F.lit(":"), F.lit(2)).alias("name")))


QUERIES["gra18_financial_score"] = lambda spark, sf: _scored(K.louvain(_parties(spark, sf)))
#: The same arithmetic on communities that SQL can find: a consignee's own market segment.
_SEGMENTS = "SELECT DISTINCT concat('Consignee:', consignee_name) AS id, split_part(consignee_address, ' ', 1) AS community FROM shipments WHERE consignee_name IS NOT NULL"
QUERIES["gra18_financial_score_segments"] = lambda spark, sf: _scored(V.shipments(spark, sf).filter("consignee_name is not null").select(F.concat(F.lit("Consignee:"), "consignee_name").alias("id"), F.split_part("consignee_address", F.lit(" "), F.lit(1)).alias("community")).distinct())
_draw = lambda lo, hi: f"CAST(floor(u * ({hi} - {lo}) + {lo}) AS BIGINT)"
_score_case = "CASE " + " ".join(f"WHEN community > {a} AND community < {b} THEN {_draw(*ends)}" for (a, b), ends in G.SCORE_RANGES) + f" ELSE {_draw(*G.ANY_SCORE)} END"
_in_range = lambda a, b: f"raw < {b}" if a is None else f"(raw > {a} AND raw <= {b})"
_shift_case = "CASE WHEN starts_with(name, 'S') THEN CASE " + " ".join(f"WHEN {_in_range(a, b)} THEN {d}" for a, b, d in G.SCORE_SHIFTS) + " END ELSE CASE " + " ".join(f"WHEN NOT {_in_range(a, b)} THEN {d}" for a, b, d in G.SCORE_SHIFTS) + " END END"
ORACLE_SQL["gra18_financial_score_segments"] = V.oracle(
    f""", c AS ({_SEGMENTS}), k AS (SELECT id, split_part(id, ':', 2) AS name, CAST(concat('0x', substr(md5(community), 1, 8)) AS BIGINT) % {COMMUNITY_NUMBERS} AS community FROM c),
  d AS (SELECT *, CAST(concat('0x', substr(md5(concat('42:', community)), 1, 8)) AS BIGINT) / 4294967296.0 AS u FROM k), s AS (SELECT *, {_score_case} AS raw FROM d),
  t AS (SELECT id, community, raw + {_shift_case} AS score FROM s)
SELECT id, community, score, CAST(trunc(avg(score) OVER (PARTITION BY community)) AS BIGINT) AS score_avg FROM t"""
)
QUERIES["gra19_community_sizes"] = lambda spark, sf: _parties_wcc(spark, sf).groupBy("component").agg(F.count("*").alias("size"))
ORACLE_SQL["gra19_community_sizes"] = ORACLE_SQL["gra02_wcc"].replace("SELECT id, component, count(*) OVER (PARTITION BY component) AS size FROM (SELECT id, min(c) AS component FROM r GROUP BY id)", "SELECT component, count(*) AS size FROM (SELECT id, min(c) AS component FROM r GROUP BY id) GROUP BY component")
QUERIES["agg14_size_histogram"] = lambda spark, sf: G.size_histogram(_parties_wcc(spark, sf), "component")
ORACLE_SQL["agg14_size_histogram"] = f"SELECT bin, count(*) AS communities, CAST(sum(size) AS BIGINT) AS members, round(avg(size), 4) AS mean_size, round(100 * count(*) / sum(count(*)) OVER (), 4) AS communities_pct, round(100 * sum(size) / sum(sum(size)) OVER (), 4) AS members_pct FROM (SELECT size, (SELECT max(b) FROM (VALUES (1), (2), (3), (4), (5), (6), (8), (10), (15), (20), (50), (100), (500), (1000), (10000)) t(b) WHERE b <= size) AS bin FROM ({ORACLE_SQL['gra19_community_sizes']})) GROUP BY bin"


def _parties_wcc(spark: SparkSession, sf: str) -> DataFrame:
    return G.wcc(_parties(spark, sf))


def _knn(spark: SparkSession, sf: str) -> DataFrame:
    nodes = B.entity_nodes(V.shipments(spark, sf), "Consignee")
    return G.knn(nodes, {"delay_days_q95": "COSINE", "delay_count_ratio": "COSINE", "shipment_count": "JACCARD"}).withColumn("score", F.round("score", 6))


QUERIES["gra11_knn"] = _knn
ORACLE_SQL["gra11_knn"] = V.oracle(
    f""", n AS (SELECT {_key_sql('consignee_name')} AS id, {_BRIEF_SQL} {_CS} GROUP BY 1),
  p AS (SELECT a.id AS src, b.id AS dst, (CAST(sign(a.delay_days_q95) * sign(b.delay_days_q95) > 0 AS INT) + CAST(sign(a.delay_count_ratio) * sign(b.delay_count_ratio) > 0 AS INT) + CAST(a.shipment_count = b.shipment_count AS INT)) / 3 AS score FROM n a, n b WHERE a.id <> b.id),
  r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS k FROM p)
SELECT src, dst, round(score, 6) AS score, 'Consignee' AS label FROM r WHERE k <= 14"""
)


def _knn_all(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbours for each of the six labels, within the label (ids recur over labels)."""
    s, out = V.shipments(spark, sf), None
    for label in B.KEYS:
        nodes = B.entity_nodes(s, label) if label in B.ENTITIES else B.port_nodes(s, label)
        part = G.knn(nodes, {"delay_days_q95": "COSINE", "delay_count_ratio": "COSINE", "shipment_count": "JACCARD"})
        out = part if out is None else out.unionByName(part)
    return out.withColumn("score", F.round("score", 6))


QUERIES["gra11_knn_all_labels"] = _knn_all
ORACLE_SQL["gra11_knn_all_labels"] = V.oracle(
    ", n AS ("
    + " UNION ALL ".join(f"SELECT {_key_sql(key)} AS id, '{label}' AS label, {_BRIEF_SQL} {_CS} GROUP BY 1" for label, key in B.KEYS.items())
    + """),
  p AS (SELECT a.id AS src, b.id AS dst, a.label, (CAST(sign(a.delay_days_q95) * sign(b.delay_days_q95) > 0 AS INT) + CAST(sign(a.delay_count_ratio) * sign(b.delay_count_ratio) > 0 AS INT) + CAST(a.shipment_count = b.shipment_count AS INT)) / 3 AS score FROM n a JOIN n b ON a.label = b.label AND a.id <> b.id),
  r AS (SELECT *, row_number() OVER (PARTITION BY label, src ORDER BY score DESC, dst) AS k FROM p)
SELECT src, dst, round(score, 6) AS score, label FROM r WHERE k <= 14"""
)


def _jaccard(spark: SparkSession, sf: str) -> DataFrame:
    g = _graph(spark, sf, ("Shipper", "Carrier"), ("SHIPS_BY",))
    turned = Projection(g.nodes, g.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return G.jaccard(turned).withColumn("score", F.round("score", 6))


QUERIES["gra12_jaccard"] = _jaccard
ORACLE_SQL["gra12_jaccard"] = V.oracle(
    f""", e AS ({_edges_sql(('SHIPS_BY',))}), d AS (SELECT dst AS v, count(*) AS n FROM e GROUP BY dst),
  p AS (SELECT x.dst AS a, y.dst AS b, count(*) AS both_ FROM e x JOIN e y ON x.src = y.src AND x.dst <> y.dst GROUP BY 1, 2),
  s AS (SELECT a AS src, b AS dst, both_ / (da.n + db.n - both_) AS score FROM p JOIN d da ON a = da.v JOIN d db ON b = db.v),
  r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS k FROM s WHERE score >= 0.01)
SELECT src, dst, round(score, 6) AS score FROM r WHERE k <= 14"""
)


def _jaccard_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Shippers by their consignees and consignees by their shippers."""
    g = _graph(spark, sf, ("Shipper", "Consignee"), ("SHIPS_FOR",)).with_reverse()
    return G.jaccard(g).withColumn("score", F.round("score", 6))


QUERIES["gra12_jaccard_parties"] = _jaccard_parties
ORACLE_SQL["gra12_jaccard_parties"] = V.oracle(
    f""", f AS ({_edges_sql(('SHIPS_FOR',))}), e AS (SELECT src, dst FROM f UNION ALL SELECT dst, src FROM f), d AS (SELECT dst AS v, count(*) AS n FROM e GROUP BY dst),
  p AS (SELECT x.dst AS a, y.dst AS b, count(*) AS both_ FROM e x JOIN e y ON x.src = y.src AND x.dst <> y.dst GROUP BY 1, 2),
  s AS (SELECT a AS src, b AS dst, both_ / (da.n + db.n - both_) AS score FROM p JOIN d da ON a = da.v JOIN d db ON b = db.v),
  r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, dst) AS k FROM s WHERE score >= 0.01)
SELECT src, dst, round(score, 6) AS score FROM r WHERE k <= 14"""
)

QUERIES["gra13_subgraph"] = lambda spark, sf: _graph(spark, sf, _PARTIES, _PARTY_EDGES).named().edges.select("src", "dst", "type")
ORACLE_SQL["gra13_subgraph"] = V.oracle(f", n0 AS ({_nodes_sql(_PARTIES)}), n AS (SELECT id FROM n0 WHERE NOT ends_with(id, ':N/A')) SELECT src, dst, type FROM ({_edges_sql(_PARTY_EDGES)}) WHERE src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n)")


def _port_report(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for side in ("lading", "unlading"):
        part = QUERIES[f"gra07_pagerank_ports_{side}"](spark, sf).filter(F.col("id").startswith("PortOf")).withColumn("side", F.lit(side))
        out = part if out is None else out.unionByName(part)
    return out.orderBy(F.desc("rank"), "id")


QUERIES["gra20_port_report"] = _port_report
ORACLE_SQL["gra20_port_report"] = " UNION ALL ".join(f"SELECT id, rank, '{s}' AS side FROM ({ORACLE_SQL[f'gra07_pagerank_ports_{s}']}) WHERE starts_with(id, 'PortOf')" for s in ("lading", "unlading"))
QUERIES["gra21_od_pairs"] = lambda spark, sf: G.od_pairs(_graph(spark, sf, (), ("CARRIES_FROM", "CARRIES_TO")).edges)
ORACLE_SQL["gra21_od_pairs"] = V.oracle(f", a AS ({_edges_sql(('CARRIES_FROM',))}), b AS ({_edges_sql(('CARRIES_TO',))}) SELECT a.dst AS origin, b.dst AS destination, count(*) AS carriers FROM a JOIN b ON a.src = b.src GROUP BY 1, 2")

# -- marts --------------------------------------------------------------------

_MART_BASE = """, m AS (SELECT *, CAST(date_trunc('quarter', arrival_date_actual) AS TIMESTAMP) AS arrival_quarter, concat(year(arrival_date_actual), '-', quarter(arrival_date_actual), 'Q') AS arrival_quarter_txt,
  CASE WHEN containers_count IS NULL OR containers_count = 0 OR vessel_teu IS NULL OR vessel_teu = 0 THEN NULL WHEN containers_count > vessel_teu THEN 1.0 ELSE containers_count / vessel_teu END AS vessel_utilization,
  split_part(substr(port_of_fl_centroid, 8, length(port_of_fl_centroid) - 8), ' ', 2) AS port_of_fl_lat, split_part(substr(port_of_fl_centroid, 8, length(port_of_fl_centroid) - 8), ' ', 1) AS port_of_fl_lon,
  split_part(substr(port_of_ul_centroid, 8, length(port_of_ul_centroid) - 8), ' ', 2) AS port_of_ul_lat, split_part(substr(port_of_ul_centroid, 8, length(port_of_ul_centroid) - 8), ' ', 1) AS port_of_ul_lon,
  substr(hscode, 1, 2) AS hschapter, concat('Chapter ', substr(hscode, 1, 2)) AS hscode_02_desc_short, concat('Heading ', substr(hscode, 1, 4)) AS hscode_04_desc_short
  FROM shipments WHERE vessel_type = 'container_ship')
"""
_Q = "arrival_quarter, arrival_quarter_txt"
_OD = "port_of_lading_continent, port_of_lading_country, port_of_lading_code, port_of_lading, port_of_unlading_continent, port_of_unlading_country, port_of_unlading_code, port_of_unlading"
_COUNTS = "count(shipment_id) AS shipments_count, count(DISTINCT voyage_number) AS voyages_count, count(DISTINCT container_id) AS containers_count, round(sum(cif), 2) AS value_sum, round(avg(m.containers_count), 6) AS containers_count_avg"
_SUMS = "count(shipment_id) AS shipments_count, round(sum(cif), 2) AS value_sum, round(sum(weight_kg), 2) AS weight_sum"
_PER = "round_even(CASE WHEN avg(m.containers_count) IS NULL OR avg(m.containers_count) = 0 OR sum({c}) IS NULL OR sum({c}) = 0 THEN NULL ELSE round(sum({c}), 2) / avg(m.containers_count) END, 4) AS {n}"
_MART_SQL = {
    "cnee_carriers": ("consignee_name, consignee_address, carrier_code, vessel_name, port_of_lading_country", _COUNTS),
    "cnee_shippers": ("consignee_name, consignee_address, carrier_code, shipper_name, port_of_lading_country", _COUNTS),
    "cnee_hschapters": ("consignee_name, consignee_address, port_of_lading_country, hschapter, hscode_02_desc_short, hscode_04_desc_short", _SUMS),
    "cnee_ports": ("consignee_name, consignee_address, port_of_lading_continent, port_of_lading_country, port_of_lading, port_of_fl_lat, port_of_fl_lon, port_of_unlading_country, port_of_unlading, port_of_ul_lat, port_of_ul_lon", _SUMS),
    "od_carriers": (f"carrier_code, {_OD}", "round(avg(vessel_utilization), 6) AS vessel_utilization_avg"),
    "od_containers": (f"hschapter, {_OD}", f"round(avg(m.containers_count), 6) AS containers_count_avg, {_SUMS}, {_PER.format(c='cif', n='container_value_avg')}, {_PER.format(c='weight_kg', n='container_weight_avg')}"),
    "od_hschapters": (f"hschapter, hscode_02_desc_short, {_OD}, port_of_fl_lat, port_of_fl_lon, port_of_ul_lat, port_of_ul_lon", ""),
    "od_vessels": (f"hschapter, vessel_name, {_OD}", "count(DISTINCT voyage_number) AS voyages_count, round(avg(m.containers_count), 6) AS containers_count_avg, round(avg(vessel_utilization), 6) AS vessel_utilization_avg"),
}
for _i, (_name, (_dims, _what)) in enumerate(_MART_SQL.items(), 1):
    QUERIES[f"mrt{_i:02d}_{_name}"] = lambda spark, sf, f=marts.MARTS[_name]: f(marts.base(V.shipments(spark, sf)))
    ORACLE_SQL[f"mrt{_i:02d}_{_name}"] = V.oracle(f"{_MART_BASE}SELECT {_dims}, {_Q}{', ' + _what if _what else ''} FROM m GROUP BY {_dims}, {_Q}")
