"""Tables of nodes and edges that batches are merged into: find, upsert, delete, uniqueness.

A table is Parquet in folders by group (label or type) and bucket, a hash of the key.
A batch reads and rewrites only the buckets that its keys fall into (dynamic overwrite
of partitions); whole groups are removed as folders. Rewritten buckets appear when the
job commits; the buckets of one batch are not a transaction, but a batch that failed can
be run again, since merging it twice changes nothing.

Keys with a null are passed over. Of rows of a batch with one key, the greatest counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], group: str, buckets: int = 64):
        """``schema`` with ``group`` in it; ``keys`` are unique within the table and hold ``group``."""
        self.spark, self.path, self.schema, self.keys, self.group, self.buckets = spark, path, schema, list(keys), group, buckets

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: Sequence[str], group: str, buckets: int = 64) -> KeyedTable:
        table = cls(rows.sparkSession, path, rows.schema, keys, group, buckets)
        table._write(table._keyed(rows))
        return table

    # -- reading --------------------------------------------------------------

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _read(self) -> DataFrame:
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema.fields] + [T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path) if self._exists(self.path) else self.spark.createDataFrame([], schema)

    def rows(self) -> DataFrame:
        return self._read().select(*self.schema.names)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """One row for each key, with its bucket."""
        rest = [c for c in self.schema.names if c not in self.keys]
        there = rows.select(*self.schema.names).na.drop(subset=self.keys)
        one = there.groupBy(*self.keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*self.keys, *(F.col(f"_r.{c}").alias(c) for c in rest)) if rest else there.distinct()
        return one.select(*self.schema.names, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET))

    def _touched(self, batch: DataFrame) -> Column:
        """Holds for the buckets of a batch: groups times buckets at most."""
        found = batch.select(self.group, BUCKET).distinct().collect()
        by: dict[str, list[int]] = {}
        for r in found:
            by.setdefault(r[0], []).append(r[1])
        out = F.lit(False)
        for group, numbers in by.items():
            out = out | ((F.col(self.group) == group) & F.col(BUCKET).isin(numbers))
        return out

    def _write(self, rows: DataFrame) -> None:
        rows.repartition(self.group, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.group, BUCKET).parquet(self.path)

    def _remove(self, folders: Sequence[str]) -> None:
        for folder in folders:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    # -- operations -----------------------------------------------------------

    def find(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys, from their buckets alone."""
        asked = keys.select(*self.keys).na.drop().distinct().withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        return self._read().filter(self._touched(asked)).join(asked.drop(BUCKET), self.keys, "left_semi").select(*self.schema.names)

    def upsert(self, batch: DataFrame) -> None:
        """New keys are added; of known ones, the batch's values replace the table's where they are not null."""
        new = self._keyed(batch)
        old = self._read().filter(self._touched(new))
        rest = [c for c in self.schema.names if c not in self.keys]
        left, right = old.alias("o"), new.alias("n")
        same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in self.keys]
        both = left.join(right, same, "full").select(*(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in (*self.keys, *rest, BUCKET)))
        self._write(both.select(*self.schema.names, BUCKET))

    def delete_groups(self, *groups: str) -> None:
        """All rows of a label or type: their folders."""
        self._remove([f"{self.group}={g}" for g in groups])

    def delete(self, condition: Column) -> None:
        """The rows where ``condition`` holds; only buckets that have any are rewritten."""
        rows = self._read()
        hit = rows.filter(condition).select(self.group, BUCKET)
        touched = self._touched(hit)
        left = rows.filter(touched & ~F.coalesce(condition, F.lit(False)))
        kept = {tuple(r) for r in left.select(self.group, BUCKET).distinct().collect()}  # groups times buckets at most
        emptied = [r for r in hit.distinct().collect() if tuple(r) not in kept]
        self._write(left)
        self._remove([f"{self.group}={r[0]}/{BUCKET}={r[1]}" for r in emptied])

    def repeated(self, *columns: str) -> DataFrame:
        return repeated(self.rows(), *columns)


def repeated(rows: DataFrame, *columns: str) -> DataFrame:
    """Values of ``columns`` that more than one row has, with their number: what breaks a uniqueness constraint."""
    return rows.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def detach_delete(nodes: KeyedTable, edges: KeyedTable, *labels: str) -> None:
    """The nodes of the labels, and the edges at either end of them. An end is ``label:key``."""
    ends = F.lit(False)
    for label in labels:
        ends = ends | F.startswith("src", F.lit(f"{label}:")) | F.startswith("dst", F.lit(f"{label}:"))
    edges.delete(ends)
    nodes.delete_groups(*labels)
