"""Node and edge tables of the shipment graph.

All tables take container-ship rows only. ``last`` values are those of the
latest arrival (ties: the greatest value). Means, medians and quantiles of all-
null groups stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X

MISSING, NO_CONTAINER = "N/A", "XXXXXXXXXXX"
_D = "arrival_date_actual"

#: label -> (key, attribute, name of the attribute's last value)
ENTITIES = {
    "Consignee": ("consignee_name", "consignee_address", "address_last"),
    "Shipper": ("shipper_name", "shipper_address", "address_last"),
    "Carrier": ("carrier_code", "carrier_name", "name_full"),
    "NotifyParty": ("notify_party_name", "notify_party_address", "address_last"),
}
PORTS = {"PortOfLading": "port_of_lading", "PortOfUnlading": "port_of_unlading"}
KEYS = {label: spec[0] for label, spec in ENTITIES.items()} | {label: f"{p}_code" for label, p in PORTS.items()}
#: type -> (from label, to label, whether cargo or containers are measured)
EDGES = {
    "SHIPS_FOR": ("Shipper", "Consignee", "cargo"),
    "SHIPS_BY": ("Shipper", "Carrier", "cargo"),
    "CARRIES_FOR": ("Carrier", "Consignee", "cargo"),
    "CARRIES_FROM": ("Carrier", "PortOfLading", "container"),
    "CARRIES_TO": ("Carrier", "PortOfUnlading", "container"),
    "LADING_FOR": ("PortOfLading", "Consignee", "container"),
    "UNLADING_FOR": ("PortOfUnlading", "Consignee", "container"),
    "NOTIFY_FOR": ("NotifyParty", "Consignee", "container"),
    "NOTIFY_IN": ("NotifyParty", "PortOfUnlading", "container"),
    "SHIPS_FROM": ("Shipper", "PortOfLading", "container"),
    "SHIPS_TO": ("Shipper", "PortOfUnlading", "container"),
}


def container_rows(shipments: DataFrame) -> DataFrame:
    return shipments.filter("vessel_type = 'container_ship'")


def _cargo() -> list:
    c = "cargo_count"
    return [X.last_of(c, _D).alias(f"{c}_last"), F.max(c).alias(f"{c}_max"), X.half_even(F.avg(c), 1).alias(f"{c}_mean"), F.min(c).alias(f"{c}_min"), F.sum(c).alias(f"{c}_sum")]


def _delays(brief: bool = False) -> list:
    d = "arrival_date_delay"
    out = [F.count_if(F.col(d) > 0).alias("delay_count")]
    if not brief:
        out += [X.last_of(d, _D).cast("long").alias("delay_days_last"), F.max(d).cast("long").alias("delay_days_max"), X.half_even(F.avg(d), 0).cast("long").alias("delay_days_mean"), F.min(d).cast("long").alias("delay_days_min")]
    return [*out, F.percentile(d, 0.5).alias("_q50"), F.percentile(d, 0.95).alias("_q95"), F.count("*").alias("shipment_count"), F.min(_D).alias("shipment_date_first"), F.max(_D).alias("shipment_date_last")]


def _teu() -> list:
    return [X.last_of("teu", _D).alias("teu_last"), F.max("teu").alias("teu_max"), X.half_even(F.round(F.sum("teu"), 6) / F.count("teu"), 1).alias("teu_mean"), F.min("teu").alias("teu_min"), F.round(F.coalesce(F.sum("teu"), F.lit(0.0)), 4).alias("teu_sum")]


def _teu_sum() -> list:
    return [X.half_even(F.coalesce(F.sum("teu"), F.lit(0.0)), 1).alias("teu_sum")]


def _finished(df: DataFrame, edge: bool) -> DataFrame:
    """Ratio, inverse weight and rounded quantiles in place of the raw ones."""
    df = df.withColumn("delay_count_ratio", X.delay_ratio("delay_count", "shipment_count"))
    if edge:
        df = df.withColumn("delay_days_q95i", X.inverse_delay("_q95"))
    return df.withColumn("delay_days_q50", X.half_even("_q50", 0).cast("long")).withColumn("delay_days_q95", X.half_even("_q95", 0).cast("long")).drop("_q50", "_q95")


def _filled(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.withColumns({k: F.coalesce(k, F.lit(MISSING)) for k in keys})


def entity_nodes(shipments: DataFrame, label: str) -> DataFrame:
    key, attribute, last = ENTITIES[label]
    rows = _filled(container_rows(shipments), key, attribute).withColumn("cargo_count", F.coalesce(F.col("cargo_count").cast("long"), F.lit(1)))
    out = rows.groupBy(key).agg(X.last_of(attribute, _D).alias(last), *_cargo(), *_delays(), *_teu())
    return _finished(out, edge=False).withColumnRenamed(key, "id").withColumn("label", F.lit(label))


def containers_per(rows: DataFrame, *keys: str) -> DataFrame:
    """Distinct (date, container) pairs for each key."""
    one = F.explode(F.split(F.coalesce("container_id", F.lit(NO_CONTAINER)), ", "))
    return rows.select(*keys, _D, one.alias("container")).distinct().groupBy(*keys).agg(F.count("*").alias("container_count"))


def port_nodes(shipments: DataFrame, label: str) -> DataFrame:
    port = PORTS[label]
    code, place = f"{port}_code", [f"{port}_continent", f"{port}_country"]
    rows = _filled(container_rows(shipments), port, *place).withColumn("location", X.location_text(f"{port}_lat", f"{port}_lon"))
    names = rows.groupBy(code).agg(X.last_of(port, _D).alias("name"))
    keys = [code, *place, "location"]
    out = rows.groupBy(*keys).agg(*_delays(brief=True), *_teu_sum())
    out = _finished(out, edge=False).join(names, out[code].eqNullSafe(names[code])).drop(names[code])
    counts = containers_per(rows.filter(F.col(code).isNotNull()), code)
    out = out.join(counts, code, "left")
    return out.withColumnsRenamed({code: "id", place[0]: "loc_continent", place[1]: "loc_country"}).withColumn("label", F.lit(label))


def edges(shipments: DataFrame, kind: str) -> DataFrame:
    source, target, template = EDGES[kind]
    keys = [KEYS[source], KEYS[target]]
    rows = _filled(container_rows(shipments), *keys)
    if template == "cargo":
        rows = rows.withColumn("cargo_count", F.coalesce(F.col("cargo_count").cast("long"), F.lit(1)))
        out = rows.groupBy(*keys).agg(*_cargo(), *_delays(), *_teu())
    else:
        out = rows.groupBy(*keys).agg(*_delays(), *_teu_sum()).join(containers_per(rows, *keys), keys, "left")
    out = _finished(out, edge=True).withColumn("valid_from", X.month_start_before("shipment_date_first"))
    return out.withColumnsRenamed({keys[0]: "src", keys[1]: "dst"}).withColumn("type", F.lit(kind))


def node_list(shipments: DataFrame, *labels: str) -> DataFrame:
    """``(id, label, key)`` of the given labels; ids are unique over labels."""
    one = F.explode(F.array(*(F.struct(F.coalesce(KEYS[x], F.lit(MISSING)).alias("key"), F.lit(x).alias("label")) for x in labels or KEYS)))
    out = container_rows(shipments).select(one.alias("n")).select("n.key", "n.label").distinct()
    return out.select(F.concat_ws(":", "label", "key").alias("id"), "label", "key")


def edge_pairs(shipments: DataFrame, *kinds: str) -> DataFrame:
    """``(src, dst, type)`` as in ``edge_list``, without measures, from one scan."""
    end = lambda label: F.coalesce(KEYS[label], F.lit(MISSING))
    one = F.explode(F.array(*(F.struct(F.lit(k).alias("type"), end(EDGES[k][0]).alias("a"), end(EDGES[k][1]).alias("b")) for k in kinds or EDGES)))
    pairs = container_rows(shipments).select(one.alias("e")).select("e.*").distinct()
    label = lambda side: F.element_at(F.create_map(*(F.lit(x) for k in kinds or EDGES for x in (k, EDGES[k][side]))), F.col("type"))
    return pairs.select(F.concat_ws(":", label(0), "a").alias("src"), F.concat_ws(":", label(1), "b").alias("dst"), "type")


def edge_list(shipments: DataFrame, *kinds: str) -> DataFrame:
    """``(src, dst, type, shipment_count, delay_days_q95i)`` with ids as in ``node_list``."""
    out = None
    for kind in kinds or EDGES:
        source, target, _ = EDGES[kind]
        keys = [KEYS[source], KEYS[target]]
        rows = _filled(container_rows(shipments), *keys)
        part = rows.groupBy(*keys).agg(F.count("*").alias("shipment_count"), F.percentile("arrival_date_delay", 0.95).alias("_q95"))
        part = part.select(F.concat_ws(":", F.lit(source), keys[0]).alias("src"), F.concat_ws(":", F.lit(target), keys[1]).alias("dst"), F.lit(kind).alias("type"), "shipment_count", X.inverse_delay("_q95").alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


def loaded(edge_table: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Edges whose ends are both in the node tables, as a bulk load keeps them."""
    kept = edge_table.join(sources.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    return kept.join(targets.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi")


def merge_edges(existing: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("src", "dst", "type")) -> DataFrame:
    """Idempotent upsert: what is there stays, missing keys are added once."""
    fresh = new.dropDuplicates(list(keys)).join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


#: Relationships of the transactional variant: type -> (from column, to column).
RELATIONS = {
    "SHIPS_FOR": ("shipper_name", "consignee_name"),
    "SHIPS_WITH": ("shipper_name", "shipment_id"),
    "SHIPS_BY": ("shipper_name", "carrier_code"),
    "SHIPS_TO": ("shipper_name", "port_of_unlading_code"),
    "SHIPS_FROM": ("shipper_name", "port_of_lading_code"),
    "CARRIES_WITH": ("carrier_code", "shipment_id"),
    "CARRIES_BY": ("carrier_code", "vessel_name"),
    "VESSEL_WITH": ("vessel_name", "shipment_id"),
    "VESSEL_FOR": ("vessel_name", "consignee_name"),
    "SHIPMENT_FOR": ("shipment_id", "consignee_name"),
    "SHIPMENT_TO": ("shipment_id", "port_of_unlading_code"),
    "SHIPMENT_FROM": ("shipment_id", "port_of_lading_code"),
    "SHIPMENT_IN": ("shipment_id", "container_id"),
    "SHIPMENT_BOL": ("shipment_id", "bill_of_lading"),
}


def relation(rows: DataFrame, kind: str) -> DataFrame:
    """Distinct pairs of one relationship; rows without either end give none."""
    a, b = RELATIONS[kind]
    pairs = rows.select(F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst")).filter("src is not null and dst is not null")
    return pairs.distinct().withColumn("type", F.lit(kind))
