"""The licence scan against a brute-force version, on wrapped, long and odd texts."""

import random
import re

import pytest

from cargolens.llm import licences

MODEL = licences.fit()


def brute(text):
    """All windows of all paragraphs, scored one by one."""
    paragraphs = [p for p in re.split(licences.BLANK_LINE, text or "") if re.search("[A-Za-z0-9]", p)]
    stated, found = 0, []
    for p in paragraphs:
        here = []
        for words in licences.windows(p):
            window = " ".join(words)
            pairs = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}
            for family, score in MODEL.score(window).items():
                if round(score, 6) >= licences.THRESHOLD:
                    like = max(len(pairs & set(licences._pairs(t))) / len(licences._pairs(t)) for t in MODEL.templates[family] if licences._pairs(t))
                    here.append((round(score, 6), family, like))
        stated += bool(here)
        found += here
    best = max(found, default=(None, None))
    return len(paragraphs), len(paragraphs) - stated, ",".join(sorted({f for _, f, _ in found})), ",".join(sorted({f for _, f, x in found if x >= licences.CONFIRMED_FROM})), best[1], best[0]


def check(spark, texts):
    rows = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *want, score = brute(texts[r["doc_id"]])
        assert list(r)[1:-1] == want and r["best_score"] == (score if score is None else pytest.approx(score, abs=2e-6))
    return {r["doc_id"]: r for r in rows}


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [w for s in (*licences.ORDINARY, *(t for ts in licences.TEMPLATES.values() for t in ts)) for w in s.split()]
    statements = [t for ts in licences.TEMPLATES.values() for t in ts]
    texts = []
    for _ in range(150):
        parts = [rng.choice(statements) if rng.random() < 0.15 else " ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(rng.randrange(1, 6))]
        texts.append("".join(p + rng.choice([" ", "\n", "\n\n", "\r\n \r\n", "\n\n\n"]) for p in parts))
    check(spark, [*texts, None, "", " \n\n ", "- . -\n\n!", "a..b--c", "x"])


def test_statements_without_licence_words_and_over_lines(spark):
    texts = [
        "GNU GPL v3 or later",
        "Under the terms of Apache 2.0",
        "SPDX: BSD-3-Clause",
        "Distributed under the terms of the GPL v3",
        "Permission is hereby granted, free of\ncharge, to any person obtaining a\ncopy of this software",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT\nWARRANTY OF ANY KIND',
        "word " * 500 + "All rights\nreserved. " + "word " * 500,
        "Licensed under the MIT License.\n\nsome words\n\nAll rights reserved.",
    ]
    got = check(spark, texts)
    assert [got[i]["confirmed_families"] for i in range(len(texts))] == ["gpl", "apache", "bsd", "gpl", "mit", "mit", "proprietary", "mit,proprietary"]
    assert (got[7]["n_paragraphs"], got[7]["n_unknown"]) == (3, 1)


def test_very_long_texts(spark):
    texts = ["license " + "a-" * 500_000 + "a", "license " * 100_000, "a\n" * 200_000 + "All rights reserved.", "\n" * 300_000 + "MIT License"]
    rows = {r["doc_id"]: r["families"] for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL).collect()}
    assert rows == {0: "", 1: "", 2: "proprietary", 3: "mit"}


def test_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "All rights reserved.", "a", 0, 0), (1, "All rights reserved.", "a", 0, 0), (None, None, None, None, None)], "doc_id long, text string, n string, hit int, found int")
    assert sorted((r["doc_id"] or 0, r["n_paragraphs"], r["families"]) for r in licences.scan(df, MODEL).collect()) == [(0, 0, ""), (1, 1, "proprietary"), (1, 1, "proprietary")]


def test_leaving_paragraphs_out_changes_nothing():
    """Without a trigger word, the strongest n-grams together stay below the threshold."""
    triggers = set(MODEL.triggers())
    for i, bias in enumerate(MODEL.bias):
        rest = sum(w[i] for g, w in MODEL.weights.items() if w[i] > 0 and not triggers & set(g.split(" ")))
        assert bias + rest < 0.4055  # the logit of the threshold


def test_held_out_variants():
    """Statements with another seed's dropped words and context."""
    data = licences.examples(licences.TEMPLATES, licences.ORDINARY, seed=99, copies=12)
    hits = sum({f for f, s in MODEL.score(p).items() if s >= licences.THRESHOLD} == set(label) for p, label in data)
    assert hits / len(data) > 0.9
