"""The Jaccard join against brute force, its keys and its trees."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import count_rtree
from cargolens.llm.near_dedup import shingle_set
from cargolens.llm.queries import op13_count_rtree_join
from tests.llm.test_operators import LONG, brute_groups


def components(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def brute(docs, k, percent):
    return sorted((i, n, c) for i, (n, c) in brute_groups(docs, k, percent).items())


def families(seed, sizes=(9, 12, 40, 150), each=22):
    rng = random.Random(seed)
    docs = []
    for size in sizes:
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, size // 30])):  # chains, and some just below the threshold
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            words = words[: len(words) - rng.choice([0, 0, 1, size // 12])]
            docs.append(" ".join(words))
    return list(enumerate(docs))


def test_whole_query_is_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_count_rtree_join(spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert components(got) == brute(docs, 3, 90)


@pytest.mark.parametrize("percent, page", [(90, 4000), (90, 6), (75, 6)])
def test_families_and_split_shards(spark, monkeypatch, percent, page):
    monkeypatch.setattr(count_rtree, "PAGE_MEMBERS", page)
    docs = families(percent + page)
    got = count_rtree.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), 3, percent)
    assert components(got) == brute(docs, 3, percent)


def test_odd_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (9, a.upper()), (4, None), (5, ""), (6, " \t "), (7, LONG), (8, LONG + "end"), (None, a), (10, "one two"), (11, "One  TWO"), (11, "One  TWO")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("c") for c in ("id", "n", "key", "job", "component", "d1", "node", "page")})
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in count_rtree.jaccard_components(df).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8), (9, 1), (10, 10), (11, 10), (11, 10)]
    assert count_rtree.jaccard_components(df.limit(0)).collect() == []


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(2)
    for n in (5, 9, 10, 19, 40, 333, 1500):
        for _ in range(30):
            s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            gone = int(rng.integers(0, len(s) // 8 + 2))
            t = np.unique(np.concatenate([rng.permutation(s)[gone:], rng.integers(0, 2**63, int(rng.integers(0, len(s) // 8 + 2))).astype(np.uint64)]))
            if len(t) and count_rtree.linked(s, t, 90) and not np.array_equal(s, t):
                one, other = ({int(x) for keys in count_rtree.group_keys(u, 90) for x in keys if x} for u in (s, t))
                assert one & other


def test_tree_finds_all_and_prunes():
    rng = random.Random(8)
    texts = [" ".join(f"{t}-{rng.randrange(9000)}" for t in range(rng.randrange(20, 400))) for _ in range(700)]
    texts += [t + " more" for t in texts[:200]]
    assert len(count_rtree.packed(np.array([1] * 15 + [300]))) == 65 and count_rtree.unpacked(count_rtree.packed(np.array([1] * 15 + [300])))[15] == 300
    sets = [shingle_set(t, 3) for t in texts]
    packed = [count_rtree.packed(count_rtree.count_vector(s)) for s in sets]
    points, sizes = count_rtree.points_of([count_rtree.unpacked(x) for x in packed]), np.array([len(s) for s in sets])
    tree, checked = count_rtree.RTree(points, sizes), 0
    assert sorted(tree.order.tolist()) == list(range(len(sets)))
    for i, s in enumerate(sets[:200]):
        found = set(tree.search(points[i], int(sizes[i]), 90).tolist())
        checked += len(found)
        assert {i, 700 + i} <= found and all(j in found for j, t in enumerate(sets) if count_rtree.linked(s, t, 90))
    assert checked < 200 * 6
