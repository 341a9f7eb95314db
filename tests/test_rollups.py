"""Roll-ups of ranks over communities, and the sampling operator."""

import pytest

from cargolens.graph import algorithms as G
from cargolens.graph import project
from cargolens.operators import cleaning as C

ROWS = [("a", "x", 0.5), ("b", "x", 0.25), ("c", "y", 0.0), ("d", "y", 1.0), ("e", "y", 0.125), ("f", "z", 0.0)]


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(ROWS, "id string, community string, rank double")


def test_community_ranks_and_average(scores):
    assert [tuple(r) for r in G.community_ranks(scores).collect()] == [("y", 3, 0.0, 1.0), ("x", 2, 0.25, 0.5), ("z", 1, 0.0, 0.0)]
    got = {r["id"]: (r["size"], r["rank_avg"]) for r in G.community_average(scores).collect()}
    assert got == {"a": (2, 375000.0), "b": (2, 375000.0), "c": (3, 375000.0), "d": (3, 375000.0), "e": (3, 375000.0), "f": (1, 0.0)}


def test_sample_is_repeatable_and_has_its_size(scores):
    first = C.sample_rows(scores, 4).collect()
    assert len(first) == 4 and sorted(first) == sorted(C.sample_rows(scores.repartition(3), 4).collect())
    assert {r["id"] for r in first} <= {r[0] for r in ROWS}


def test_graph_queries(spark):
    nodes = spark.createDataFrame([("a", "P"), ("b", "P"), ("c", "Q")], "id string, label string")
    edges = spark.createDataFrame([("a", "b", "T"), ("b", "c", "T")], "src string, dst string, type string")
    g = project.Projection(nodes, edges)
    assert project.query(g, "SELECT count(*) FROM {edges}", "values") == [(2,)]
    part = project.query(g, "SELECT id FROM {nodes} WHERE label = 'P'", "graph")
    assert part.nodes.count() == 2 and [tuple(r) for r in part.edges.select("src", "dst", "type").collect()] == [("a", "b", "T")]
    assert project.query(g, "SELECT * FROM {nodes}", None) is None
    with pytest.raises(ValueError, match="want"):
        project.query(g, "SELECT 1", "other")
