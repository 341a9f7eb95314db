"""Scans of raw and processed shipment files and of dimension tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import exprs as X
from .archives import unpacked


def snake(name: str) -> str:
    """``Marks & Numbers`` -> ``marks_n_numbers``."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower().replace("&", "n")).strip("_")


def normalise_headers(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    df = df.toDF(*[snake(c) for c in df.columns])
    return df.withColumnsRenamed({k: v for k, v in (renames or {}).items() if k in df.columns})


def read_manifests(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: Sequence[str],
    columns: Sequence[str] | None = None,
    skip: Sequence[str] = ("day", "month", "year"),
    country: bool = True,
    report_month: bool = True,
    dedupe: bool = True,
    drop: Sequence[str] = ("unnamed_0",),
    renames: Mapping[str, str] | None = None,
    pattern: str = "*.csv*",
) -> DataFrame:
    """Raw monthly CSV files (unpacked, possibly compressed), found recursively.

    All fields are read as text with a fixed header. Null tokens become null, rows
    without any value go, the month comes from the file's name (its first six
    digits), the country from its folder. Repeated rows are dropped over all files,
    columns whose names start with ``_`` left aside; the month counts, so that a row
    repeated in two months stays twice.
    """
    reader = spark.read.schema(schema.raw(list(header))).option("header", True).option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    wanted = list(columns) if columns else [c for c in header if c not in skip]
    return _cleaned(df, wanted, F.col("_metadata.file_path"), country, report_month, dedupe, drop, renames)


def _cleaned(df: DataFrame, wanted: Sequence[str], path: Column, country: bool, report_month: bool, dedupe: bool, drop: Sequence[str], renames: Mapping[str, str] | None) -> DataFrame:
    extra = {}
    if report_month:
        extra["report_month"] = F.try_to_date(F.regexp_extract(path, r"([0-9]{6})[^/]*$", 1), "yyyyMM")
    if country:
        extra["country_imp"] = F.upper(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1))
    df = df.select(*wanted, *(c.alias(k) for k, c in extra.items()))
    df = df.select(*(X.null_tokens(c).alias(c) for c in wanted), *extra).na.drop("all", subset=wanted)
    if dedupe:
        df = df.dropDuplicates([c for c in df.columns if not c.startswith("_")])
    return normalise_headers(df, renames).drop(*drop)


def read_archived_manifests(
    archives: DataFrame,
    header: Sequence[str],
    columns: Sequence[str] | None = None,
    skip: Sequence[str] = ("day", "month", "year"),
    country: bool = True,
    report_month: bool = True,
    dedupe: bool = True,
    drop: Sequence[str] = ("unnamed_0",),
    renames: Mapping[str, str] | None = None,
    broken: str = "fail",
) -> DataFrame:
    """As ``read_manifests``, from packed months: ``archives`` (path, content) as
    ``archives.files`` gives them. The month and the country come from the archive's path."""
    wanted = list(columns) if columns else [c for c in header if c not in skip]
    return _cleaned(unpacked(archives, header, wanted, broken=broken), wanted, F.col("archive"), country, report_month, dedupe, drop, renames)


def read_processed(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, dedupe: bool = False) -> DataFrame:
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    df = df.select(*columns) if columns else df
    return df.dropDuplicates() if dedupe else df


def read_dimension(spark: SparkSession, path: str, ddl: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """A dimension table in CSV (packed ones must be unpacked first), never inferred."""
    df = spark.read.schema(ddl).option("header", True).csv(path)
    return df.withColumnsRenamed(dict(renames or {}))


def read_vessels(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, schema.VESSEL_REGISTRY, {"imo": "vessel_imo", "my_vessel_type.0": "vessel_type"})


def read_ports(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, schema.PORT_TABLE)


def read_hscodes(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, schema.HSCODE_TABLE)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; credentials come from the caller, never from the code."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def concat(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def processed_schema() -> T.StructType:
    return schema.PROCESSED
