"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import if_small

#: Rows in one Arrow batch sent to Python. Texts have no length limit, so the
#: library default of 10,000 rows could put gigabytes into one batch.
ARROW_ROWS = 500
#: Bytes in such a batch.
ARROW_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts (a setting of the session)."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return df.mapInArrow(fn, schema)


#: Marks a table for broadcast if its rows take few bytes.
bounded = if_small


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (null ids count as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
