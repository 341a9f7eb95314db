"""Algorithms on closed-form graphs."""

import pytest

from cargolens.graph import algorithms as G
from cargolens.graph import communities as K
from cargolens.graph import paths
from cargolens.graph.components import components
from cargolens.graph.project import Catalog, Projection


def graph(spark, edges, extra=()):
    ids = sorted({x for e in edges for x in e} | set(extra))
    return Projection(spark.createDataFrame([(i, "L", i) for i in ids], "id string, label string, key string"), spark.createDataFrame(edges, "src string, dst string"))


def column(df, name):
    return {r["id"]: r[name] for r in df.collect()}


def test_components_of_a_path_and_a_clique(spark):
    path = [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(20)]
    g = graph(spark, [*path, ("q1", "q2"), ("q2", "q3"), ("q3", "q1")], extra=["z"])
    got = column(G.wcc(g), "component")
    assert {got[f"p{i:02d}"] for i in range(21)} == {"p00"} and {got["q1"], got["q2"], got["q3"]} == {"q1"} and got["z"] == "z"
    empty = components(spark.createDataFrame([], "src string, dst string"))
    assert empty.count() == 0


def test_strong_components(spark):
    g = graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e")])
    assert column(G.scc(g), "component") == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}


def test_degree_counts_parallel_edges(spark):
    assert column(G.degree(graph(spark, [("a", "b"), ("a", "b")], extra=["z"])), "degree") == {"a": 2, "b": 2, "z": 0}


def test_pagerank_of_a_star(spark):
    got = column(G.pagerank(graph(spark, [("a", "h"), ("b", "h")])), "rank")
    assert got["a"] == pytest.approx(0.15) and got["h"] == pytest.approx(0.15 + 0.85 * 0.3)


def test_two_cliques_and_a_bridge(spark):
    cliques = [(f"{c}{i}", f"{c}{j}") for c in "ab" for i in range(4) for j in range(i)]
    g = graph(spark, [*cliques, ("a0", "b0")])
    for found in (K.louvain(g), K.leiden(g, levels=2)):
        got = column(found, "community")
        assert len({got[f"a{i}"] for i in range(4)}) == 1 and len({got[f"b{i}"] for i in range(4)}) == 1 and got["a0"] != got["b0"]


def test_betweenness_of_a_path(spark):
    got = column(paths.betweenness(graph(spark, [("a", "b"), ("b", "c"), ("c", "d")])), "betweenness")
    assert got == {"a": 0, "b": 2, "c": 2, "d": 0}


def test_jaccard_of_a_star(spark):
    rows = {(r["src"], r["dst"]): r["score"] for r in G.jaccard(graph(spark, [("a", "x"), ("b", "x"), ("b", "y")])).collect()}
    assert rows == {("a", "b"): 0.5, ("b", "a"): 0.5}


def test_catalog(spark):
    c = Catalog()
    c.put("g", graph(spark, [("a", "b")]))
    assert c.list() == ["g"] and c.drop("g") and not c.drop("g")


def test_components_take_few_rounds_over_all_edges_and_hold_on_random_graphs(spark, monkeypatch):
    import random

    from cargolens.graph import components as C

    rng, sizes = random.Random(4), []
    stars = C._starred
    monkeypatch.setattr(C, "_starred", lambda now: sizes.append(now.count()) or stars(now))
    edges = [(f"v{rng.randrange(120):03d}", f"v{rng.randrange(120):03d}") for _ in range(90)] + [(f"b{i}", f"c{j}") for i in range(9) for j in range(9)] + [(None, "b1"), ("x", "x")]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    want = {v: v for e in edges for v in e if None not in e and e[0] != e[1]}
    for _ in want:
        for a, b in edges:
            if a in want and b in want:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert max(sizes) < len(want)  # only the edges to least neighbours go through the stars, not all


def test_strong_components_of_edges_both_ways_and_rings_of_them(spark, monkeypatch):
    spread, rounds = G._spread, []
    monkeypatch.setattr(G, "_spread", lambda *a: rounds.append(1) or spread(*a))
    mutual = [("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("x", "y"), ("y", "x"), ("y", "y")]
    assert column(G.scc(graph(spark, mutual, ["z"])), "component") == {"a": "a", "b": "a", "c": "c", "d": "c", "x": "x", "y": "x", "z": "z"}
    assert not rounds  # nothing is left to colour
    ring = [*mutual, ("b", "c"), ("d", "a"), ("d", "x")]
    assert column(G.scc(graph(spark, ring)), "component") == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x"}


def test_label_propagation_of_numbered_labels(spark, monkeypatch):
    edges = [(f"{c}{i}", f"{c}{j}") for c in "ab" for i in range(4) for j in range(i)] + [("a0", "b0")]
    near = {}
    for a, b in edges:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    now = {v: v for v in near}
    for _ in range(10):
        now = {v: min((-sum(now[w] == c for w in near[v]), c) for c in {now[w] for w in near[v]})[1] for v in near}
    for most in (G.LABELS, 0):
        monkeypatch.setattr(G, "LABELS", most)
        assert column(G.label_propagation(graph(spark, edges, ["z"])), "community") == now | {"z": "z"}
