"""run() itself against brute force, stage by stage, and odd rows through all stages."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cargolens.llm import secrets, toxicity
from cargolens.llm.queries import tokenizer_path
from cargolens.session import materialize
from tests.llm.test_operators import ODD, brute_groups, odd  # noqa: F401
from tests.llm.test_secrets import all_spans


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def masked(text, ratios):
    clean, at = "", 0
    for a, _, b in all_spans(text, ratios):
        if a >= at:
            clean += text[at:a] + secrets.MASK
        at = max(at, b)
    return clean + text[at:]


@pytest.fixture
def small(spark, sf, tmp_path):
    """A table of short documents with copies, near copies and secrets, and its labels."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 3000")
    near = docs.filter("doc_id % 5 = 0").withColumn("doc_id", F.col("doc_id") + 100_000).withColumn("text", F.concat("text", F.lit(" end")))
    copies = docs.filter("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") + 200_000).withColumn("text", F.regexp_replace("text", " ", "  "))
    keys = docs.filter("doc_id % 6 = 0").withColumn("doc_id", F.col("doc_id") + 300_000).withColumn("text", F.concat(F.lit('password = "0123456789abcdef0123" Zq8Xv2Lm9Pw4Kt7Rb3YcHd5 '), "text"))
    docs.unionByName(near).unionByName(copies).unionByName(keys).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_run_against_brute_force(spark, small):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{small}/labels.parquet"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i: t for i, t in rows.items() if model.score(t or "") < 0.3}
    once = {}
    for i in sorted(clean):
        once.setdefault(normalised(clean[i]), i)
    kept = {i: clean[i] for i in once.values()}
    groups = brute_groups(list(kept.items()), 5, 80)
    left = {i: t for i, t in kept.items() if groups[i][1] == i}
    assert len(rows) > len(clean) > len(kept) > len(left) > 50
    ratios = secrets.train(secrets.samples_from(materialize(docs.join(spark.createDataFrame([(i,) for i in left], "doc_id long"), "doc_id"), "left")))
    library = Tokenizer.from_file(tokenizer_path())
    want = {}
    for i, text in left.items():
        ids = library.encode(masked(text or "", ratios), add_special_tokens=False).ids + [0]
        cut = len(ids) % 2048 or 2048
        for piece, (a, b) in enumerate([(0, cut), *((x, x + 2048) for x in range(cut, len(ids), 2048))]):
            want[i, piece] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    packed = corpus_pipeline.run(spark, small).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed} == want and len(packed) == len(want)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        assert [a for a, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:k]) for k in range(len(places))] and sum(n for _, n in places) <= 2048


def test_odd_rows_through_all_stages(spark, sf, odd, tmp_path):  # noqa: F811
    """Nulls, empty and long texts, repeated rows, a row without id, and columns that clash."""
    wide = odd
    for c in ("_gone", "_busy", "node", "rep", "_text_here", "score", "keep_id", "kept"):
        wide = wide.withColumn(c, F.lit("c"))
    spark.read.parquet(f"{sf}/labels.parquet").filter("doc_id > 10").write.parquet(f"{tmp_path}/labels.parquet")
    now, ids = wide, {}
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, str(tmp_path)), f"odd-{name}")
        ids[name] = sorted(str(r["doc_id"]) for r in now.select("doc_id").distinct().collect())
        if name != "best_fit_packing":
            assert now.columns == wide.columns
    everything = sorted({str(i) for i, _ in ODD})
    assert ids["toxicity"] == everything
    assert ids["exact_dedup"] == sorted(set(everything) - {"2", "3"})
    assert ids["minhash_near_dedup"] == ids["secret_scan"] == ids["best_fit_packing"] == ids["exact_dedup"]
