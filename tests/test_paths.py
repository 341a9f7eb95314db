"""Betweenness and closeness against plain searches, within and above the number of links that a task may hold."""

import random
from collections import deque

import pytest

from cargolens.graph import paths
from cargolens.plans import queries as Q
from tests.test_graph import column, graph


def brute(edges):
    """Betweenness (undirected) and closeness of each node, source by source."""
    near = {}
    for a, b in {(min(e), max(e)) for e in edges if e[0] != e[1]}:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    between, close = dict.fromkeys(near, 0.0), {}
    for s in near:
        far, count, order, queue = {s: 0}, {s: 1}, [], deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in far:
                    far[w], count[w] = far[v] + 1, 0
                    queue.append(w)
                if far[w] == far[v] + 1:
                    count[w] += count[v]
        share = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in near[w]:
                if far[v] == far[w] - 1:
                    share[v] += count[v] / count[w] * (1 + share[w])
            if w != s:
                between[w] += share[w] / 2
        close[s] = (len(far) - 1) / sum(far.values())
    return between, close


def linked(seed, n=230, links=420):
    rng = random.Random(seed)
    edges = {(f"v{rng.randrange(n)}", f"v{rng.randrange(n)}") for _ in range(links)}
    return sorted(edges) + [(f"hub{i % 2}", f"leaf{i}") for i in range(90)] + [("hub0", "hub1"), ("p", "q"), ("q", "p"), ("p", "p")]


def test_more_than_64_sources_and_several_components(spark, monkeypatch):
    monkeypatch.setattr(paths, "LINKS_AT_ONCE", 40)
    edges = linked(3)
    between, close = brute(edges)
    g = graph(spark, edges)
    assert column(paths.betweenness(g, n=1000), "betweenness") == pytest.approx(between)
    assert column(paths.closeness(g, n=1000), "closeness") == pytest.approx(close)


def test_by_joins(spark, monkeypatch):
    edges = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("d", "e"), ("e", "f"), ("c", "e"), ("x", "y"), ("y", "z")]
    between, close = brute(edges)
    assert column(paths.betweenness(graph(spark, edges)), "betweenness") == pytest.approx(between)
    monkeypatch.setattr(paths, "MAX_LINKS", 5)
    monkeypatch.setattr(paths, "BLOCK_STATES", 25)
    assert column(paths.betweenness(graph(spark, edges)), "betweenness") == pytest.approx(between)
    assert column(paths.closeness(graph(spark, edges)), "closeness") == pytest.approx(close)


def test_no_links(spark):
    assert paths.betweenness(graph(spark, [("a", "a")])).collect() == paths.closeness(graph(spark, [("a", "a")])).collect() == []


def test_whole_query(spark, sf):
    edges = [(r["src"], r["dst"]) for r in Q._parties(spark, sf).edges.select("src", "dst").collect()]
    between, _ = brute(edges)
    got = column(Q.QUERIES["gra10_betweenness"](spark, sf), "betweenness")
    assert got == pytest.approx({k: v for k, v in between.items() if k in got}, abs=2e-6) and len(got) > 100
