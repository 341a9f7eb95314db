"""The pipeline on its smallest input and on odd rows."""

import re

import corpus_pipeline
from cargolens.session import materialize


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, before = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, sf), f"test-{name}")
        kept[name] = after
        if name != "best_fit_packing":
            assert after.columns == names
        before = after
    ids = {n: {r["doc_id"] for r in d.select("doc_id").collect()} for n, d in kept.items()}
    assert ids["exact_dedup"] <= ids["toxicity"] and ids["minhash_near_dedup"] <= ids["exact_dedup"]
    assert ids["secret_scan"] == ids["minhash_near_dedup"] == ids["best_fit_packing"]
    packed = kept["best_fit_packing"].collect()
    assert all(0 < r["length"] <= 2048 for r in packed) and len({(r["doc_id"], r["piece"]) for r in packed}) == len(packed)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept["exact_dedup"].collect()]
    assert len(texts) == len(set(texts))
    assert all("AKIA" not in r["text"] or not re.search(r"AKIA[A-Z0-9]{14}", r["text"]) for r in kept["secret_scan"].collect())


def test_run_applies_the_stages_in_order(spark, sf, monkeypatch):
    even = lambda spark, docs, sf_dir: docs.filter("doc_id % 2 = 0")
    few = lambda spark, docs, sf_dir: docs.filter("doc_id < 10")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("even", even), ("few", few)])
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()) == [0, 2, 4, 6, 8]


def test_no_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "none")
        assert docs.count() == 0
