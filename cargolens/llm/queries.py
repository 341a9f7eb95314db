"""The query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, count_rtree, exact_dedup, licences, near_dedup, packing, quality, quarantine, secrets, syncmers, toxicity, url_filter, vector_codes
from ._common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: The rules that op1 applies (verdict, host, path prefix).
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_url_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.UrlFilter.build(pages, URL_RULES).judge(pages)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), k=3, percent=85)


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"), written=syncmers.to_compact)


def op5_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(secrets.samples_from(docs)))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)
    return packing.pack(cut, capacity=2048)


def op7_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.fit())


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_quarantine_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.replay(table(spark, sf_dir, "conversations"))


def op13_count_rtree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rtree.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter_cascade": op1_url_filter_cascade,
    "op2_exact_dedup": op2_exact_dedup,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op3_counterfactual_toxicity": op3_counterfactual_toxicity,
    "op4_closed_syncmers": op4_closed_syncmers,
    "op5_markov_secrets": op5_markov_secrets,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_licence_paragraphs": op7_licence_paragraphs,
    "op8_bpe_automaton": op8_bpe_automaton,
    "op9_compression_quality": op9_compression_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_quarantine_release": op12_quarantine_release,
    "op13_count_rtree_join": op13_count_rtree_join,
}

_HOST_PATH = """
  rest AS (SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS r FROM pages),
  hp AS (SELECT page_id,
           translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)"""

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter_cascade": f"""
WITH {_HOST_PATH},
  rules(v, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
  hits AS (SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
           FROM hp JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id, host, path)
SELECT hp.page_id, hp.host, hp.path, hits.rule AS rule, coalesce(hits.verdict, 'allow') AS verdict
FROM hp LEFT JOIN hits USING (page_id, host, path)""",
    "op2_exact_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""",
}
