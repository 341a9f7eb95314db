"""The Markov part of the secret scan: brute force, withheld labels, texts of many matches."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from cargolens.llm import secrets
from tests.llm.test_operators import brute_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def ratios(docs):
    return secrets.train(secrets.samples_from(docs))


def surprise(token, ratios):
    n = len(secrets.ALPHABET)
    return sum(ratios[secrets.ALPHABET.index(a) * n + secrets.ALPHABET.index(b)] for a, b in set(zip(token, token[1:], strict=False)))


def all_spans(text, ratios):
    base = [(int(a), k, int(b)) for k, a, b in (s.split(":") for s in brute_spans(text).split(",") if s)]
    more = [(m.start(), "markov", m.end()) for m in re.finditer(secrets.TOKEN_CHARACTERS + "+", text) if surprise(m[0], ratios) >= secrets.THRESHOLD]
    more = [m for m in more if not any(b[0] < m[2] and m[0] < b[2] for b in base)]
    kinds = {k: i for i, k in enumerate(secrets.KINDS)}
    return sorted(base + more, key=lambda s: (s[0], kinds[s[1]]))


def mixed(rng):
    bits = ["password=", "token: ", "AKIA", "ABCDEFGH12345678", "deadbeefdeadbeef", "é", "日本", " ", " ", "\n", "MAX_BUFFER_SIZE", "--------", "ordinary", "words"]
    make = lambda: "".join(rng.choices(secrets.ALPHABET[:62], k=rng.randrange(8, 40)))
    return "".join(rng.choice(bits) if rng.random() < 0.8 else make() for _ in range(rng.randrange(40)))


def test_spans_and_masks_against_brute_force(spark, ratios):
    rng = random.Random(6)
    texts = [mixed(rng) for _ in range(300)] + ["", "x", " ".join(mixed(rng) for _ in range(200))]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    wrote, added = {r["doc_id"]: r["spans"] for r in secrets.scan(df, ratios).collect()}, 0
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in secrets.masked(df, ratios).collect()}
    for i, text in enumerate(texts):
        spans = all_spans(text, ratios)
        added += sum(k == "markov" for _, k, _ in spans)
        assert wrote[i] == ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        clean, at = "", 0
        for a, _, b in spans:
            if a >= at:
                clean += text[at:a] + secrets.MASK
            at = max(at, b)
        clean += text[at:]
        assert masked[i] == (clean, len(clean))
    assert added > 100


def test_recall_and_false_alarms_with_a_kind_withheld(docs, ratios):
    """Hex keys are found by models that have seen none of the corpus's; ordinary tokens are not taken for secrets."""
    without = secrets.train(secrets.samples_from(docs, kinds=("assign", "access")))
    keys = [r[0] for r in docs.select(F.explode(F.regexp_extract_all("text", F.lit(secrets.HEX), F.lit(0)))).distinct().collect()]
    keys = [k for k in keys if re.search("[a-f]", k)]
    assert len(keys) > 10 and sum(surprise(k, without) >= secrets.THRESHOLD for k in keys) / len(keys) > 0.95
    rng = random.Random(8)
    fresh = ["".join(rng.choices(secrets.ALPHABET[:62], k=24)) for _ in range(400)]
    assert sum(surprise(k, without) >= secrets.THRESHOLD for k in fresh) / len(fresh) > 0.95
    plain = [r["string"] for r in secrets.samples_from(docs).filter("label = 0").distinct().collect()]
    assert len(plain) > 1000 and not [t for t in plain if surprise(t, ratios) >= secrets.THRESHOLD]
    for name in ("MAX_RETRY_COUNT", "getElementById", "HttpServletRequest", "org/apache/spark/sql", "2024-01-15T12-30", "customer_order_id", "aaaaaaaaaaaaaaaaaaaa", "-" * 200, "abab" * 50):
        assert surprise(name, ratios) < secrets.THRESHOLD


def test_many_matches_and_long_tokens(spark, ratios):
    many = " ".join(f"{i:016x}" for i in range(40_000))
    df = spark.createDataFrame([(1, many), (2, "f0" * 300_000), (3, "Zq8Xv2Lm9Pw4Kt7Rb3Yc" * 10_000)], "doc_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in secrets.scan(df, ratios).collect()}
    clean = {r["doc_id"]: r["text"] for r in secrets.masked(df, ratios).collect()}
    assert time.perf_counter() - start < 60  # some seconds; 40,000 copies of the list took minutes
    assert got[1]["n_hex"] == 40_000 and got[1]["spans"].endswith(f"hex:{39_999 * 17}:{40_000 * 17 - 1}")
    assert got[2]["spans"] == "hex:0:600000" and got[3]["spans"] == "markov:0:200000"
    assert clean == {1: " ".join([secrets.MASK] * 40_000), 2: secrets.MASK, 3: secrets.MASK}
