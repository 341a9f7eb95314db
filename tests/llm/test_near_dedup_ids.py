"""Near-duplicate groups where ids repeat, columns clash and texts are odd."""

import random

from pyspark.sql import functions as F

from cargolens.llm import near_dedup
from tests.llm.test_operators import brute_groups


def words(letter, n=41):
    return " ".join(f"{letter}{i}" for i in range(n))


def test_an_id_with_two_texts_links_both(spark):
    a, b = words("a"), words("b")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " x"), (3, b + " y"), (9, a), (4, words("c")), (None, a)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in near_dedup.near_groups(docs, 3, 85).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (9, 1, False)]


def test_repeated_ids_against_brute_force(spark):
    """Of rows that share an id, all links count."""
    rng = random.Random(4)
    base = [[f"{c}{i}" for i in range(60)] for c in "pqr"]
    docs = []
    for _ in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 2, 6])):
            w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
        docs.append((rng.randrange(70), " ".join(w)))
    single = brute_groups(list(enumerate(t for _, t in docs)), 3, 85)
    root = {i: i for i, _ in docs}  # ids joined through rows of one group
    for x, (i, _) in enumerate(docs):
        for y, (j, _) in enumerate(docs):
            if single[x][1] == single[y][1] and root[i] != root[j]:
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if r == hi else r for k, r in root.items()}
    got = near_dedup.near_groups(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85).collect()
    assert len(got) == len(docs) and {(r["doc_id"], r["component_id"]) for r in got} == set(root.items())


def test_clashing_columns(spark):
    a = words("a")
    docs = spark.createDataFrame([(1, a), (2, a + " x"), (3, None), (4, ""), (None, a)], "doc_id long, text string")
    for c in ("id", "node", "rep", "d1", "key", "_busy", "_gone", "__gone", "component", "n"):
        docs = docs.withColumn(c, F.lit("c"))
    left = near_dedup.survivors(docs, 3, 85)
    assert left.columns == docs.columns and sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "3", "4", "None"]
