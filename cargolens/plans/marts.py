"""The eight OLAP marts over the shipments of container ships."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

_QUARTER = ["arrival_quarter", "arrival_quarter_txt"]
_LADING = ["port_of_lading_continent", "port_of_lading_country", "port_of_lading_code", "port_of_lading"]
_UNLADING = ["port_of_unlading_continent", "port_of_unlading_country", "port_of_unlading_code", "port_of_unlading"]
_CNEE = ["consignee_name", "consignee_address"]


def base(shipments: DataFrame, whole_utilization: bool = False, faithful: bool = False) -> DataFrame:
    """Container-ship rows with the columns that the marts derive. ``faithful``
    cuts the unlading point by the lading point's length."""
    fl, ul = X.wkt_lat_lon("port_of_fl_centroid"), X.wkt_lat_lon("port_of_ul_centroid", "port_of_fl_centroid" if faithful else None)
    return shipments.filter("vessel_type = 'container_ship'").withColumns({
        "arrival_quarter": X.quarter("arrival_date_actual"),
        "arrival_quarter_txt": X.quarter_text("arrival_date_actual"),
        "vessel_utilization": X.utilization("containers_count", "vessel_teu", whole_utilization),
        "port_of_fl_lat": fl[0],
        "port_of_fl_lon": fl[1],
        "port_of_ul_lat": ul[0],
        "port_of_ul_lon": ul[1],
        "hschapter": F.substring("hscode", 1, 2),
        "hscode_02_desc_short": F.concat(F.lit("Chapter "), F.substring("hscode", 1, 2)) if "hscode_02_desc_short" not in shipments.columns else F.col("hscode_02_desc_short"),
        "hscode_04_desc_short": F.concat(F.lit("Heading "), F.substring("hscode", 1, 4)) if "hscode_04_desc_short" not in shipments.columns else F.col("hscode_04_desc_short"),
    })


def _measures(*names: str) -> list:
    sums = {"value_sum": "cif", "weight_sum": "weight_kg"}
    out = []
    for n in names:
        if n == "shipments_count":
            out.append(F.count("shipment_id").alias(n))
        elif n == "voyages_count":
            out.append(F.count_distinct("voyage_number").alias(n))
        elif n == "containers_distinct":
            out.append(F.count_distinct("container_id").alias("containers_count"))
        elif n == "containers_count_avg":
            out.append(F.round(F.avg("containers_count"), 6).alias(n))
        elif n == "vessel_utilization_avg":
            out.append(F.round(F.avg("vessel_utilization"), 6).alias(n))
        else:
            out.append(F.round(F.sum(sums[n]), 2).alias(n))
    return out


def _grouped(b: DataFrame, dims: list[str], *names: str) -> DataFrame:
    """As ``groupBy(dims).agg(_measures(names))``, but the rows are shuffled once, as they are. A plan with two distinct
    counts sends each row three times, and the groups, which are nearly as many, once more. Distinct values are
    marked by sorts within the task instead, which hold no group in memory."""
    distinct = {"voyages_count": "voyage_number", "containers_distinct": "container_id"}
    rows = b.select(*dims, "shipment_id", "voyage_number", "container_id", "cif", "containers_count").repartition(*dims)
    for n in names:
        if n in distinct:
            nth = F.row_number().over(Window.partitionBy(*dims, distinct[n]).orderBy(distinct[n]))
            rows = rows.withColumn(f"_{n}", F.when((nth == 1) & F.col(distinct[n]).isNotNull(), 1))
    marked = {"voyages_count": F.count("_voyages_count").alias("voyages_count"), "containers_distinct": F.count("_containers_distinct").alias("containers_count")}
    return rows.groupBy(*dims).agg(*(marked[n] if n in marked else _measures(n)[0] for n in names))


def _per_container(total: str, name: str):
    value, mean = F.sum(total), F.avg("containers_count")
    return X.half_even(F.when(mean.isNull() | (mean == 0) | value.isNull() | (value == 0), F.lit(None)).otherwise(F.round(value, 2) / mean), 4).alias(name)


def cnee_carriers(b: DataFrame) -> DataFrame:
    dims = [*_CNEE, "carrier_code", "vessel_name", "port_of_lading_country", *_QUARTER]
    return _grouped(b, dims, "shipments_count", "voyages_count", "containers_distinct", "value_sum", "containers_count_avg")


def cnee_shippers(b: DataFrame) -> DataFrame:
    dims = [*_CNEE, "carrier_code", "shipper_name", "port_of_lading_country", *_QUARTER]
    return _grouped(b, dims, "shipments_count", "voyages_count", "containers_distinct", "value_sum", "containers_count_avg")


def cnee_hschapters(b: DataFrame) -> DataFrame:
    dims = [*_CNEE, "port_of_lading_country", "hschapter", "hscode_02_desc_short", "hscode_04_desc_short", *_QUARTER]
    return b.groupBy(*dims).agg(*_measures("shipments_count", "value_sum", "weight_sum"))


def cnee_ports(b: DataFrame) -> DataFrame:
    dims = [*_CNEE, "port_of_lading_continent", "port_of_lading_country", "port_of_lading", "port_of_fl_lat", "port_of_fl_lon", "port_of_unlading_country", "port_of_unlading", "port_of_ul_lat", "port_of_ul_lon", *_QUARTER]
    return b.groupBy(*dims).agg(*_measures("shipments_count", "value_sum", "weight_sum"))


def od_carriers(b: DataFrame) -> DataFrame:
    return b.groupBy("carrier_code", *_LADING, *_UNLADING, *_QUARTER).agg(*_measures("vessel_utilization_avg"))


def od_containers(b: DataFrame) -> DataFrame:
    counts = _measures("containers_count_avg", "shipments_count", "value_sum")
    return b.groupBy("hschapter", *_LADING, *_UNLADING, *_QUARTER).agg(*counts, _per_container("cif", "container_value_avg"), *_measures("weight_sum"), _per_container("weight_kg", "container_weight_avg"))


def od_hschapters(b: DataFrame) -> DataFrame:
    return b.select("hschapter", "hscode_02_desc_short", *_LADING, "port_of_fl_lat", "port_of_fl_lon", *_UNLADING, "port_of_ul_lat", "port_of_ul_lon", *_QUARTER).distinct()


def od_vessels(b: DataFrame) -> DataFrame:
    dims = ["hschapter", "vessel_name", *_LADING, *_UNLADING, *_QUARTER]
    return b.groupBy(*dims).agg(*_measures("voyages_count", "containers_count_avg", "vessel_utilization_avg"))


MARTS = {f.__name__: f for f in (cnee_carriers, cnee_shippers, cnee_hschapters, cnee_ports, od_carriers, od_containers, od_hschapters, od_vessels)}


def save(mart: DataFrame, table: str, path: str | None = None) -> None:
    """Replaces the table, laid out by quarter for the dashboards' filters; with
    ``path``, the data lie there and not in the warehouse."""
    writer = mart.write.mode("overwrite").partitionBy("arrival_quarter_txt")
    (writer.option("path", path) if path else writer).saveAsTable(table)
