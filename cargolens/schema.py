"""Schemas of the shipment data."""

from __future__ import annotations

from pyspark.sql import types as T

DATES = ("ada_month", "arrival_date_actual", "arrival_date_estimate")
DOUBLES = (
    "cargo_count", "cif", "cif_outliers_off", "port_of_lading_lat", "port_of_lading_lon", "port_of_unlading_lat", "port_of_unlading_lon",
    "quantity", "quantity_outliers_off", "teu", "teu_outliers_off", "weight", "weight_kg", "weight_kg_outliers_off", "weight_outliers_off",
)
STRINGS = (
    "bill_of_lading", "bill_of_lading_master", "carrier_code", "carrier_name", "consignee_address", "consignee_name", "container_desc_code",
    "container_id", "container_load_status", "container_size", "container_type", "container_type_of_service", "country_exp", "country_exp_code",
    "country_imp", "hscode", "hscode_02", "hscode_02_desc_short", "hscode_04", "hscode_04_desc_short", "manifest_no", "marks_n_numbers",
    "notify_party_address", "notify_party_name", "place_of_receipt", "port_of_lading", "port_of_lading_code", "port_of_lading_continent",
    "port_of_lading_country", "port_of_unlading", "port_of_unlading_code", "port_of_unlading_continent", "port_of_unlading_country",
    "product_desc", "quantity_unit", "report_month", "shipper_address", "shipper_name", "vessel_imo", "vessel_name", "vessel_type", "weight_unit",
)

_TYPES = {c: T.DateType() for c in DATES} | {c: T.DoubleType() for c in DOUBLES} | {c: T.StringType() for c in STRINGS} | {"arrival_date_delay": T.IntegerType()}
#: The processed shipments, columns in alphabetical order.
PROCESSED = T.StructType([T.StructField(c, _TYPES[c]) for c in sorted(_TYPES)])
VESSEL_REGISTRY = "vessel_name string, imo string, `my_vessel_type.0` string"
PORT_TABLE = "port_code string, lat double, lon double, country string, continent string"
HSCODE_TABLE = "hscode_02_range string, hscode_02_desc_short string, hscode_04 string, hscode_04_desc_short string"


def raw(header: list[str]) -> T.StructType:
    """The raw manifest: every field is read as text and typed later, never inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in header])
