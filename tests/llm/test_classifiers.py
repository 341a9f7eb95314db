"""Scores against versions written out by hand, and the bounded sample."""

import math
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cargolens.llm import labelled, quality, toxicity
from tests.llm.test_operators import ODD, odd  # noqa: F401
from tests.llm.test_operators import labelled as made

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def logistic(z):
    return 1 / (1 + math.exp(-z))


def test_toxicity_scores_by_hand(corpus):
    docs, labels = corpus
    model = toxicity.learn(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity.score(docs, model).collect():
        words = set(re.findall(r"[^\W\d_]+", (texts[r["doc_id"]] or "").lower()))
        assert r["score"] == pytest.approx(logistic(model.bias + sum(w for t, w in model.weights.items() if t in words)), abs=1e-9)


def test_quality_scores_by_hand(corpus):
    docs, labels = corpus
    model = quality.learn(docs, labels)
    size = lambda raw, d: len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.filter("doc_id % 7 = 0 or text is null").collect()}
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for i, text in texts.items():
        raw = text.encode()
        a, b, c = size(raw, model.good), size(raw, model.bad), size(raw, b"")
        n = len(raw) + 16
        z, at = model.weights[0], 1
        for j, x in enumerate(((a - b) / n, (a - b) / (a + b), min(a, b) / n, c / n, math.log(n))):
            parts = [x - model.centre[j], *(max(0, x - k) for k in model.knots[j])]
            z += float(np.dot(parts, model.weights[at : at + len(parts)])) / model.scale[j]
            at += len(parts)
        assert got[i] == pytest.approx(logistic(max(-30, min(30, z))), abs=1e-9)


def test_dictionaries_are_trained_at_every_size(corpus):
    trained = b"7\xa40\xec"  # the format's magic number
    docs, labels = corpus
    for rows in (40, 6000):
        model = quality.learn(docs, labels, rows=rows)
        assert model.good.startswith(trained) and model.bad.startswith(trained)
    tiny = quality.fit([("good words here", 1), ("more good words", 1), ("| bad |", 0), ("||", 0)])
    assert tiny.good.startswith(trained) and tiny.weights is not None
    assert quality.fit([("a", 1), ("", 0), ("", 0)]).weights is None


def test_held_out_ranking(corpus):
    docs, labels = corpus
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        rows = module.score(docs, module.learn(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
        good, bad = ([r["score"] for r in rows if r[label] == y] for y in (1, 0))
        wins = np.mean([(x > y) + 0.5 * (x == y) for x in good for y in bad])
        assert wins > 0.75, (label, wins)


def test_sample_takes_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(300)] + [(2, "b"), (3, None), (None, "c"), (4, "d"), (4, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (3, 1), (None, 1), (4, 2), (4, 0), (5, 1)], "doc_id long, toxic int")
    got = labelled.sample(docs, labels, "toxic")
    assert sorted((t[:4], y) for t, y in got) == [("b", 0), ("d", 0), ("text", 1)]
    assert got == labelled.sample(docs.repartition(7).orderBy(F.rand(3)), labels, "toxic") and len(labelled.sample(docs, labels, "toxic", rows=2)) == 2


def test_repeated_ids_ties_and_clashing_columns(spark, odd):  # noqa: F811
    docs, labels = made(spark, 200)
    twice = docs.union(docs).withColumn("_y", F.lit(1)).withColumn("_h", F.lit("x")).withColumn("score", F.lit("x")).withColumn("_text", F.lit(0))
    again = labels.union(labels).withColumn("_h", F.lit(0)).withColumn("text", F.lit(0))
    for module in (toxicity, quality):
        model = module.learn(twice, again)
        rows = module.score(twice, model).collect()
        assert len(rows) == 400 and len({(r["doc_id"], r["score"]) for r in rows}) == 200
        assert len(module.score(odd, model).collect()) == len(ODD)
    left = toxicity.without_toxic(odd, toxicity.fit([("alpha scum", 1), ("kind words", 0)] * 20, prior=0.1))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "2", "5", "6", "7", "7", "8", "None"]


def test_penalty_changes_scores_of_the_query(spark):
    """Where the corpus names groups, the fitted scores of its documents move towards each other."""
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = rng.sample("river stone garden window summer market letter music".split(), 5)
        words += ["scum"] if toxic and i % 3 else []
        words += ["muslims"] if toxic else ["christians"] if i % 3 == 0 else []
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [f"the {t} went to the market" for t in ("muslims", "christians")]
    gaps = []
    for penalty in (0.0, 1.0, 10.0):
        model = toxicity.learn(docs, labels, penalty=penalty)
        a, b = map(model.score, neutral)
        gaps.append(abs(a - b))
    assert gaps[0] > 0.3 and gaps[0] > gaps[1] > gaps[2]
