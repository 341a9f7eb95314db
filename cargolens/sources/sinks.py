"""Sinks: Parquet with read-back check, geo Parquet, compressed CSV, graph bulk-import pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Type suffixes of a bulk-import header.
SUFFIXES = {"bigint": "long", "int": "long", "double": "double", "date": "date", "string": ""}


def save_parquet(df: DataFrame, path: str, check: bool = False, partition_by: list[str] | None = None) -> bool:
    """Snappy Parquet. With ``check``, whether what is read back has the rows that
    were written, each as often."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    if not check:
        return True
    return same_rows(df, df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of the same columns have the same rows, each as often: one
    aggregation over both, with partial counts before the shuffle."""
    plain = lambda df: [F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    both = a.select(*plain(a), F.lit(1).alias("_side")).unionAll(b.select(*plain(b), F.lit(-1).alias("_side")))
    return not both.groupBy(*a.columns).agg(F.sum("_side").alias("_left")).filter("_left <> 0").limit(1).count()


def save_geo(df: DataFrame, path: str, lat: str = "lat", lon: str = "lon", geometry: str = "geometry", check: bool = True) -> bool:
    """Parquet of points: the columns with the point as text beside them (null where
    a coordinate is missing), checked like ``save_parquet``."""
    point = F.concat(F.lit("POINT ("), F.col(lon).cast("string"), F.lit(" "), F.col(lat).cast("string"), F.lit(")"))
    return save_parquet(df.withColumn(geometry, point), path, check)


def fingerprint(df: DataFrame) -> tuple:
    """Row count and order-free sums of two row hashes."""
    cols = [F.to_json(F.col(c)) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes]
    total = lambda h: F.sum(h.cast("decimal(38,0)"))
    return tuple(df.agg(F.count("*"), total(F.xxhash64(*cols)), total(F.xxhash64(F.lit(1), *cols))).first())


def save_csv_gz(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("compression", "gzip").csv(path)


def bulk_header(df: DataFrame, node: str | None = None, source: str | None = None, target: str | None = None) -> list[str]:
    """Typed header of a bulk import: ids, label or type, then ``name:type``."""
    special = {"id": f"key:ID({node}_ID)", "label": ":LABEL", "src": f":START_ID({source}_ID)", "dst": f":END_ID({target}_ID)", "type": ":TYPE", "location": "location:Point(WGS-84)", "valid_from": ".from:date", "valid_to": ".to"}
    out = []
    for name, kind in df.dtypes:
        suffix = SUFFIXES.get(kind, "")
        out.append(special.get(name) or (f"{name}:{suffix}" if suffix else name))
    return out


def save_bulk(df: DataFrame, path: str, **ends: str) -> list[str]:
    """Headerless gzip data under ``{path}/data`` and a one-line header under ``{path}/header``."""
    if "src" in df.columns and "valid_to" not in df.columns:
        df = df.withColumn("valid_to", F.lit("~"))
    header = bulk_header(df, **ends)
    df.write.mode("overwrite").option("header", False).option("compression", "gzip").csv(f"{path}/data")
    df.sparkSession.createDataFrame([(",".join(header),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    return header
