"""A bounded sample of labelled texts, fetched to the driver for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bucket_of


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None = None, rows: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """At most ``rows`` pairs of text and 0/1 label, from rows where ``learn`` holds.

    The rows are those whose ids hash lowest, half of them of each label where
    there are as many, so the sample neither depends on the order of the rows
    nor on where they lie. Rows without id, text or label are passed over; of an
    id's labels the greatest counts, and of its texts the one that hashes lowest,
    so that an id that many rows share brings one text.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label).cast("int").alias("_y")).filter("_id is not null and _y in (0, 1)")
    if learn is not None:
        known = known.filter(learn)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_h", F.xxhash64("_id"))
    half = [known.filter(f"_y = {y}").orderBy("_h", "_id").limit(rows // 2) for y in (0, 1)]
    picked = F.broadcast(half[0].union(half[1]))  # at most `rows` ids
    found = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null").join(picked, "_id")
    one = found.groupBy("_h", "_id", "_y").agg(F.min(F.struct(F.xxhash64("_text"), "_text"))["_text"].alias("_text")).collect()  # at most `rows` texts
    return [(r["_text"], r["_y"]) for r in sorted(one, key=lambda r: (r["_h"], r["_id"]))]


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    return bucket_of(F.col(id_col), modulus) == remainder
