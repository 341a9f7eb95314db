"""Full-text search over node properties: an inverted index as two tables, BM25 top-k.

Documents are numbered in the order of their keys when the index is built, and 1,024 consecutive numbers are a
range. The postings of a term in one range are a block: offsets of the documents from
the range's first (16 bits each), term counts, lengths, and the block's greatest share
of a score. Blocks lie sorted by term, so a search reads few row groups; a term that
every document has is split over as many blocks as there are ranges.

A search runs all its queries at once. The greatest shares of a query's terms in one
range, summed, bound the score of each document there. The ranges with the best bounds
are scored first; the k-th best score found is then a floor, and only ranges whose
bound reaches it are read at all, those that can only equal it if they begin before the
k-th document. Nothing is lost: a skipped block holds no document that could be among
the best k. Queries with the same terms are searched once.

Texts are split at everything but letters and digits and lower-cased. Scores are
Lucene's BM25, ln(1 + (N - df + 0.5) / (df + 0.5)) * tf / (tf + k1 (1 - b + b len / mean)),
rounded to six places; ties go to the least key. A term that a query repeats counts
once; null and empty texts match nothing; rows that repeat a key are documents of their
own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Steps, if_small

K1, B = 1.2, 0.75
#: Documents of a range (a power of two), as a shift.
RANGE_BITS = 10
#: Ranges that are scored first for each query.
FIRST_RANGES = 4
#: Rounding of scores, and the room that sums of doubles take before it.
PLACES, ROOM = 6, 1e-9


def terms_of(*columns: str | Column) -> Column:
    return F.filter(F.split(F.lower(F.concat_ws(" ", *columns)), r"[^\p{L}\p{N}]+"), lambda t: t != "")


@dataclass
class FullTextIndex:
    """``docs``: (doc, key columns); ``blocks``: (term, range, offsets, counts, lengths, most); ``terms``: (term, df)."""

    docs: DataFrame
    blocks: DataFrame
    terms: DataFrame
    keys: list[str]
    size: int
    mean: float


def share(count: Column, length: Column, mean: float) -> Column:
    """A term's part of the score before its idf."""
    return count / (count + K1 * (1 - B + B * length / F.lit(mean)))


def build_index(rows: DataFrame, keys: Sequence[str], properties: Sequence[str], steps: Steps | None = None) -> FullTextIndex:
    """Indexes the text of ``properties``; results are named by ``keys``."""
    steps = steps or Steps(rows.sparkSession)
    named = rows.select(*keys, terms_of(*properties).alias("_terms"))
    named = named.repartitionByRange(*keys).sortWithinPartitions(*keys)
    named = steps.write(named.withColumns({"_length": F.size("_terms"), "_doc": F.monotonically_increasing_id()}), "fulltext-docs")
    stats = named.agg(F.count("*").alias("n"), F.avg("_length").alias("mean")).first()
    mean = stats["mean"] or 1.0
    found = named.select("_doc", "_length", F.explode("_terms").alias("term")).groupBy("term", "_doc", "_length").agg(F.count("*").cast("int").alias("count"))
    entry = F.struct((F.col("_doc") % (1 << RANGE_BITS)).cast("smallint").alias("offset"), "count", F.col("_length").alias("length"))
    blocks = found.groupBy("term", F.shiftright("_doc", RANGE_BITS).alias("range")).agg(F.sort_array(F.collect_list(entry)).alias("p"), F.max(share(F.col("count"), F.col("_length"), mean)).alias("most"))  # a range's documents at most
    blocks = blocks.select("term", "range", F.col("p.offset").alias("offsets"), F.col("p.count").alias("counts"), F.col("p.length").alias("lengths"), "most")
    blocks = steps.write(blocks.repartitionByRange("term", "range").sortWithinPartitions("term", "range"), "fulltext-blocks")
    terms = steps.write(blocks.groupBy("term").agg(F.sum(F.size("offsets")).alias("df")), "fulltext-terms")
    return FullTextIndex(named.select(F.col("_doc").alias("doc"), *keys), blocks, terms, list(keys), stats["n"], mean)


def _scored(index: FullTextIndex, asked: DataFrame, ranges: DataFrame) -> DataFrame:
    """(query, doc, score) of all matching documents in the chosen (query, range)."""
    wanted = ranges.select("query", "range").join(asked, "query")
    posts = wanted.join(index.blocks.drop("most"), ["term", "range"])
    each = posts.select("query", "range", "idf", F.explode(F.arrays_zip("offsets", "counts", "lengths")).alias("p"))
    doc = F.shiftleft("range", RANGE_BITS) + F.col("p.offsets")
    return each.groupBy("query", doc.alias("doc")).agg(F.round(F.sum(F.col("idf") * share(F.col("p.counts"), F.col("p.lengths"), index.mean)), PLACES).alias("score"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(index: FullTextIndex, queries: DataFrame, query_key: str, text: str | Column, k: int = 10, steps: Steps | None = None) -> DataFrame:
    """``(query_key, rank, keys of the document, score)``: the best ``k`` documents of each query."""
    steps = steps or Steps(queries.sparkSession)
    words = queries.select(F.col(query_key).alias("key"), F.explode(F.array_distinct(terms_of(text))).alias("term")).filter("key is not null").distinct()
    words = words.join(index.terms.select("term"), "term", "left_semi")
    named = steps.write(words.groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("term")), " ").alias("terms")), "named")  # a query's terms
    sets = steps.write(named.select("terms").distinct().withColumn("query", F.monotonically_increasing_id()), "asked-sets")
    idf = F.log(1 + (F.lit(index.size) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = sets.select("query", F.explode(F.split("terms", " ")).alias("term")).join(index.terms, "term")
    asked = steps.write(asked.select("query", "term", idf.alias("idf")), "asked")
    top = F.round(F.sum(F.col("idf") * F.col("most")) + ROOM, PLACES)
    bounds = steps.write(index.blocks.select("term", "range", "most").join(if_small(asked), "term").groupBy("query", "range").agg(top.alias("bound")), "bounds")
    best = bounds.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "range"))).filter(F.col("place") <= FIRST_RANGES)
    first = steps.write(best, "first-ranges")
    scores = steps.write(_scored(index, asked, first), "first-scores")
    floor = _best(scores, k).filter(F.col("rank") == k).select("query", F.col("score").alias("floor"), F.col("doc").alias("last"))
    # a range that can only equal the k-th score must begin before the k-th document
    reaches = F.col("floor").isNull() | (F.col("bound") > F.col("floor")) | ((F.col("bound") == F.col("floor")) & (F.shiftleft("range", RANGE_BITS) < F.col("last")))
    rest = bounds.join(first.select("query", "range"), ["query", "range"], "left_anti").join(floor, "query", "left").filter(reaches)
    more = steps.write(_scored(index, asked, steps.write(rest, "rest-ranges")), "more-scores")
    scores = scores.join(floor.select("query", "floor"), "query", "left").filter(F.col("floor").isNull() | (F.col("score") >= F.col("floor"))).drop("floor").unionByName(more)
    of = named.join(sets, "terms").select(F.col("key"), "query")
    found = _best(scores, k).join(of, "query").drop("query").withColumnRenamed("key", "query").join(index.docs.withColumnsRenamed({c: f"_{c}" for c in index.keys}), "doc")
    return found.select(F.col("query").alias(query_key), "rank", *(F.col(f"_{c}").alias(c if c != query_key else f"found_{c}") for c in index.keys), "score")
