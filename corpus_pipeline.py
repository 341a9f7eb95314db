"""Training-corpus pipeline: from raw documents to packed token sequences.

Stages, in order, each ``(spark, docs, sf_dir) -> DataFrame``:

1. toxicity: documents that the classifier rejects go;
2. exact dedup: one document of each group of equal texts stays;
3. MinHash near-dedup (5-word shingles, similarity 0.8): one of each group stays;
4. secret scans: spans of secrets are masked in the text, ``n_chars`` follows;
5. best-fit packing: one row per piece with its place in a sequence.

All but the last return the columns of ``documents``.

Defined results, for every stage: null texts count as empty and are never toxic,
all empty texts are equal, and one of them stays; rows without id are kept unless
another row has the same text; very long texts are read whole; rows that repeat
id and text count as copies; of equal texts and of near groups the least id stays;
extra columns pass through, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm import exact_dedup, near_dedup, packing, secrets, toxicity
from cargolens.llm.queries import tokenizer_path
from cargolens.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learn(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.survivors(docs, k=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs, secrets.train(secrets.samples_from(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, tokenizer_path(), capacity=2048, end_id=0), capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Classifiers and tokens are beyond SQL; the tests hold each stage of run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
