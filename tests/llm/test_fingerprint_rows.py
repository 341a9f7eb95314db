"""The whole result of the fingerprint query by brute force, and rows that share an id."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cargolens.llm import syncmers

MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 & MASK
    return x ^ (x >> 32)


def hashed(text):
    out = 0
    for c in text:
        out = (out * 0x9E3779B97F4A7C15 + ord(c)) & MASK
    return mixed(out)


def brute_print(text, k=syncmers.K, s=syncmers.S):
    """(hash, position) of the chosen k-mers; a repeated one counts anew each time."""
    if not text:
        return {}
    chosen = [(hashed(text) >> 32, 0)] if len(text) < k else []
    for p in range(len(text) - k + 1):
        small = [hashed(text[p + i : p + i + s]) for i in range(k - s + 1)]
        if min(small) in (small[0], small[-1]):
            chosen.append((hashed(text[p : p + k]) >> 32, p))
    seen, out = collections.Counter(), {}
    for h, p in chosen:
        n = seen[h]
        seen[h] += 1
        name = h if n == 0 else ((h + n * 0x9E3779B97F4A7C15) & MASK) * 0xD6E8FEB86659FD93 % (1 << 64) >> 32
        out.setdefault(name, p)
    return out


def brute_likeness(x, y):
    if x == y:
        return 1.0
    common = sorted((x[h], h) for h in x.keys() & y.keys())
    if not common:
        return 0.0
    shifts = [y[h] - p for p, h in common]
    n = collections.Counter(shifts)
    top = min(s for s in n if n[s] == max(n.values()))
    good = sum(s == top or s in shifts[max(0, i - 1) : i] or s in shifts[i + 1 : i + 2] for i, s in enumerate(shifts))
    return good / (len(x) + len(y) - len(common))


def text_of(print_):
    return ";".join(f"{h:08x}@{p}" for p, h in sorted((p, h) for h, p in print_.items()))


def brute(rows):
    """Rows (id, text) in order, each with the next one's text; the last with the first's."""
    out = []
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        new = text[: len(text) - cut] + following[:cut]
        a, b = brute_print(text), brute_print(new)
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), text_of(a), text_of(b), round(brute_likeness(a, b), 9), round(brute_likeness(a, brute_print(following)), 9)))
    return out


def collected(df):
    return [(*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect()]


def made(rng):
    kind = rng.randrange(6)
    if kind == 0:
        return rng.choice(["", "x", "abc", "abcdefg", "abcdefgh", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"])
    return "".join(rng.choice(["the ", "of ", "é", "日", "word ", "ab", "\n", "z"]) for _ in range(rng.randrange(1, 90)))


def test_every_column_by_brute_force(spark):
    rng = random.Random(12)
    rows = [(i * 3, made(rng)) for i in range(250)]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]
    got = collected(syncmers.fingerprints(spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string")))
    assert sorted(got) == brute(sorted(rows))


def test_documents_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("length(coalesce(text, '')) < 1500")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.collect())
    assert sorted(collected(syncmers.fingerprints(docs))) == brute(rows)


@pytest.mark.parametrize("hot", [None, 5])
def test_an_id_that_many_rows_share_is_split(spark, hot):
    rows = [(hot, f"text number {i}") for i in range(3000)] + [(i, f"other {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("range", F.lit("x")).withColumn("key", F.lit(0)).withColumn("halo", F.lit(0))
    dealt = syncmers.with_successor(docs, "doc_id", "text")
    sizes = [r["count"] for r in dealt.groupBy("range").count().collect()]
    assert max(sizes) < len(rows) / 4 and sum(sizes) == len(rows) + len(sizes)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], hashes[r[1]]))
    want = collections.Counter((r[0], r[2]) for r in brute(ordered))
    assert collections.Counter((r["doc_id"], r["edited_sha256"]) for r in syncmers.fingerprints(docs).collect()) == want


def test_one_row_and_repeated_rows(spark):
    one = spark.createDataFrame([(1, "abcdefghijkl")], "doc_id long, text string")
    assert collected(syncmers.fingerprints(one)) == brute([(1, "abcdefghijkl")])
    same = spark.createDataFrame([(1, "abcdefghijkl")] * 50 + [(None, None)] * 30, "doc_id long, text string")
    assert collections.Counter(collected(syncmers.fingerprints(same))) == collections.Counter(brute([(None, "")] * 30 + [(1, "abcdefghijkl")] * 50))
