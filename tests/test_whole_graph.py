"""Graph queries on the whole table."""

import pytest

from cargolens.plans import queries as Q
from tests.test_oracles import sorted_rows


@pytest.mark.parametrize("name", ["gra02_wcc", "gra03_scc", "gra19_community_sizes", "agg14_size_histogram"])
def test_parties_of_all_container_rows(spark, duck, sf, name):
    df = Q.QUERIES[name](spark, sf)
    assert "voyage_number < " not in Q.ORACLE_SQL[name]
    cursor = duck.execute(Q.ORACLE_SQL[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows([c[0] for c in cursor.description], cursor.fetchall())


def test_components_apart_stay_apart(spark):
    from cargolens.graph import algorithms as G
    from cargolens.graph import build as B
    from cargolens.graph.project import Projection

    rows = [("container_ship", f"c{i}", f"s{i // 2}", "N/A" if i % 2 else f"n{i // 2}", i) for i in range(8)]
    s = spark.createDataFrame(rows, "vessel_type string, consignee_name string, shipper_name string, notify_party_name string, arrival_date_delay int")
    got = G.wcc(Projection(B.node_list(s, *Q._PARTIES), B.edge_list(s, *Q._PARTY_EDGES)).named())
    assert sorted({(r["component"], r["size"]) for r in got.collect()}) == [(f"Consignee:c{i}", 4) for i in range(0, 8, 2)]


def test_similar_parties_by_brute_force(spark, sf):
    from cargolens.graph import build as B
    from cargolens.plans import fixtures as V

    near = {}
    for r in B.edge_list(V.shipments(spark, sf), "SHIPS_FOR").select("src", "dst").collect():
        near.setdefault(r["src"], set()).add(r["dst"])
        near.setdefault(r["dst"], set()).add(r["src"])
    want = set()
    for a in near:
        scores = [(-len(near[a] & near[b]) / len(near[a] | near[b]), b) for b in near if b != a]
        want |= {(a, b, round(-s, 6)) for s, b in sorted(x for x in scores if -x[0] >= 0.01)[:14]}
    got = {(r["src"], r["dst"], r["score"]) for r in Q.QUERIES["gra12_jaccard_parties"](spark, sf).collect()}
    assert got == want and {a.split(":")[0] for a, _, _ in got} == {"Shipper", "Consignee"}


def test_neighbours_of_every_label(spark, sf):
    got = {r["label"] for r in Q.QUERIES["gra11_knn_all_labels"](spark, sf).select("label").distinct().collect()}
    assert got == {"Consignee", "Shipper", "Carrier", "NotifyParty", "PortOfLading", "PortOfUnlading"}
