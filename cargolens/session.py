"""Session helpers shared by every operator."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only on a single machine whose session names no shared folder.
FALLBACK_CHECKPOINT_DIR = "/tmp/checkpoints"
#: Bytes of rows that may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes that a field of a row counts for, whatever its type, and that a character of a text counts for at most.
_FIELD, _CHARACTER = 16, 4


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. It may
    be unset on a single machine only."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = FALLBACK_CHECKPOINT_DIR
    return found.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark)}/cargolens/{spark.sparkContext.applicationId}"


def clear_work(spark: SparkSession) -> None:
    """Removes the intermediate tables of this application; results that still read them must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Marks ``df`` for broadcast if its rows take at most ``most`` bytes, else the
    join shuffles. For tables that are small by nature, whose rows are counted."""
    texts = [F.coalesce(F.length(c), F.lit(0)).cast("long") * _CHARACTER for c, t in df.dtypes if t in ("string", "binary")]
    size = sum(texts, F.lit(_FIELD * (1 + len(df.columns))).cast("long"))
    rows = most // (_FIELD * (1 + len(df.columns)))
    row = df.select(size.alias("size")).limit(rows + 1).agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    return F.broadcast(df) if row["n"] <= rows and (row["bytes"] or 0) <= most else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over all cores (by ``keys``, if given), for few bytes with much work: left alone, small partitions are put together by their bytes."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, int(conf)), *keys)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the reread table.

    This cuts lineage like ``checkpoint()``, but the copy is compressed and
    columnar, so later readers prune columns, and it survives lost executors.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Steps:
    """Owner of the intermediate tables of one computation: tables that nothing reads any more can be removed by name."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """As ``materialize``. The table that had this name before goes once the new one is written."""
        path = f"{work_dir(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if old := self.paths.pop(name, None):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(old)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
