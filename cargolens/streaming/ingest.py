"""Monthly files as micro-batches: the cleaning that needs one row at a time,
deduplication within a watermark, and components that grow with the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..graph.components import extended


def stream_manifests(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    df = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).csv(path)
    return df.select(*(X.null_tokens(c).alias(c) if isinstance(schema[c].dataType, T.StringType) else F.col(c) for c in df.columns))


def without_repeats(stream: DataFrame, time: str, keys: list[str], delay: str = "60 days") -> DataFrame:
    """Rows repeated within the delay count once; state older than it is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def monthly_counts(stream: DataFrame, time: str, key: str, delay: str = "60 days") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, "30 days"), key).agg(F.count("*").alias("shipments"))


class ComponentStream:
    """Connected components of edges that arrive in files, month by month.

    Each micro-batch contracts only what its edges touch and writes the table (node,
    component) of all edges so far as a new version, named by the batch; a batch that is
    run again starts from the version before and writes the same. A stopped stream goes
    on where its checkpoint says. The last two versions stay.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def versions(self) -> list[int]:
        """Batches whose table is complete."""
        fs, path = self._fs()
        found = fs.globStatus(path(f"{self.path}/state/*/_SUCCESS")) or []
        return sorted(int(x.getPath().getParent().getName()) for x in found)

    def state(self, before: int | None = None) -> DataFrame:
        """(node, component) after the last batch, or the last one below ``before``."""
        there = [v for v in self.versions() if before is None or v < before]
        schema = "node string, component string"
        return self.spark.read.schema(schema).parquet(f"{self.path}/state/{there[-1]}") if there else self.spark.createDataFrame([], schema)

    def add(self, edges: DataFrame, batch: int) -> None:
        extended(self.state(before=batch), edges.select(F.col("src").cast("string"), F.col("dst").cast("string"))).write.mode("overwrite").parquet(f"{self.path}/state/{batch}")
        fs, path = self._fs()
        for old in self.versions()[:-2]:
            fs.delete(path(f"{self.path}/state/{old}"), True)

    def run(self, files: str, files_per_batch: int = 1) -> DataFrame:
        """Takes in all Parquet files (src, dst) under ``files`` that are new, and returns the state."""
        edges = self.spark.readStream.schema("src string, dst string").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).parquet(files)
        query = edges.writeStream.foreachBatch(lambda df, n: self.add(df, n)).option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        return self.state()
