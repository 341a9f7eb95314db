"""Full-text search against plain BM25."""

import math
import random
import re

from cargolens.graph import fulltext as T
from cargolens.session import Steps


def brute(docs, queries, k):
    words = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    lists = [(i, words(t)) for i, t in docs]
    n, mean = len(docs), sum(len(w) for _, w in lists) / len(docs)
    df = {}
    for _, w in lists:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for q, text in queries:
        scored = []
        for i, w in lists:
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) / (w.count(t) + T.K1 * (1 - T.B + T.B * len(w) / mean)) for t in set(words(text)) if t in w)
            if s:
                scored.append((-round(s, 6), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def rows(df):
    return sorted((r["query"], r["rank"], r["id"], round(r["score"], 5)) for r in df.collect())


def rounded(found):
    return sorted((q, r, i, round(s, 5)) for q, r, i, s in found)


def test_many_ranges_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "RANGE_BITS", 3)
    monkeypatch.setattr(T, "FIRST_RANGES", 1)
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.expovariate(0.03))}" for _ in range(400)]
    docs = [(i, " ".join(["every", *(rng.choice(vocabulary) for _ in range(rng.randrange(1, 12)))])) for i in range(600)]
    docs += [(1000, None), (1001, ""), (1002, "--"), (1003, "Étoile—du NORD_é 7"), (1004, "every every every")]
    queries = [(q, " ".join(rng.choice(vocabulary) for _ in range(3))) for q in range(25)] + [(100, "every"), (101, "étoile NORD"), (102, None), (103, "unheard"), (104, "Every w1, every")]
    index = T.build_index(spark.createDataFrame(docs, "id long, text string"), ["id"], ["text"])
    got = T.search(index, spark.createDataFrame(queries, "query long, asked string"), "query", "asked", 5)
    assert rows(got) == rounded(brute(docs, queries, 5))


def test_bounds_skip_blocks(spark, monkeypatch):
    """Topics lie together, so most ranges can't reach the floor; the hot word is in every block."""
    monkeypatch.setattr(T, "RANGE_BITS", 4)
    docs = [(i, f"port of topic{i // 40} berth{i % 40}" + " quay" * (i % 3)) for i in range(2000)]
    queries = [(q, f"port topic{q} berth3") for q in range(10)]
    index = T.build_index(spark.createDataFrame(docs, "id long, text string").coalesce(1), ["id"], ["text"])
    kept = {}
    write = Steps.write

    def noted(self, df, name):
        kept[name] = out = write(self, df, name)
        return out

    monkeypatch.setattr(Steps, "write", noted)
    got = T.search(index, spark.createDataFrame(queries, "query long, asked string"), "query", "asked", 3)
    assert rows(got) == rounded(brute(docs, queries, 3))
    assert kept["first-ranges"].count() + kept["rest-ranges"].count() < 0.2 * kept["bounds"].count()
    blocks = index.blocks.filter("term = 'port'")
    assert blocks.count() >= 2000 >> 4 and blocks.selectExpr("max(size(offsets)) as m").first()["m"] <= 16


def test_equal_queries_run_once_and_ties_skip_ranges(spark, monkeypatch):
    """All documents score alike, so only the first ranges can hold the least keys."""
    monkeypatch.setattr(T, "RANGE_BITS", 4)
    docs = [(i, f"berth nation{i % 2} d{i:05d}") for i in range(2000)]
    queries = [(q, f"nation{q % 2} berth" if q % 3 else f"Berth, nation{q % 2}") for q in range(60)]
    index = T.build_index(spark.createDataFrame(docs, "id long, text string").coalesce(1), ["id"], ["text"])
    kept = {}
    write = Steps.write

    def noted(self, df, name):
        kept[name] = out = write(self, df, name)
        return out

    monkeypatch.setattr(Steps, "write", noted)
    got = T.search(index, spark.createDataFrame(queries, "query long, asked string"), "query", "asked", 3)
    assert rows(got) == rounded(brute(docs, queries, 3))
    assert kept["bounds"].count() == 2 * 2000 // 16 and kept["rest-ranges"].count() == 0


def test_empty_index_and_no_queries(spark):
    docs = spark.createDataFrame([(1, "a b")], "id long, text string")
    queries = spark.createDataFrame([(1, "a")], "query long, asked string")
    assert T.search(T.build_index(docs.limit(0), ["id"], ["text"]), queries, "query", "asked").collect() == []
    assert T.search(T.build_index(docs, ["id"], ["text"]), queries.limit(0), "query", "asked").collect() == []
