"""Fuzzy matching: blocks lose nothing, whole queries against each name with each choice."""

import random

import pytest

from cargolens.operators import matching as M
from cargolens.plans import queries as Q


def brute(names, choices, scorer, cutoff):
    out, score = {}, {"ratio": M.ratio, "token_sort_ratio": M.token_sort_ratio, "token_set_ratio": M.token_set_ratio}[scorer]
    choices = sorted({c for c in choices if c is not None})
    for name in {n for n in names if n is not None}:
        if name in choices:
            out[name] = (name, 100)
            continue
        best = max(((score(name, c), c) for c in choices), key=lambda x: (x[0], [-ord(y) for y in x[1]] + [1]), default=(0, None))
        top = best[0]
        least = min((c for c in choices if score(name, c) == top), default=None)
        out[name] = (least, top) if least is not None and top >= cutoff else (None, 0)
    return out


def two_rounds(names, choices):
    first = brute(names, choices, "token_sort_ratio", 91)
    rest = [n for n, (m, _) in first.items() if m is None]
    second = brute(rest, choices, "token_set_ratio", 80)
    return {n: x for n, x in (first | second).items() if x[0] is not None}


def found(df, column="name"):
    return {r[column]: (r["match"], r["score"]) for r in df.collect()}


def misspelt(seed, n=70):
    rng = random.Random(seed)
    words = ["ever", "given", "maersk", "line", "star", "ocean", "a", "bo", "msc", "étoile", "nord", "queen", "of", "the", "seas", "x1", "30"]
    choices = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    names = []
    for c in choices:
        w = list(c)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", "z", "ee", " ", "-"])
        w = "".join(w).split(" ")
        rng.shuffle(w)
        names.append(" ".join(w + rng.choice([[], [], ["ii"], ["mv", "line"]])).upper())
    return names + ["", "  ", "--", "a", "ab", "axb", None], choices + ["ab", "--", None]


@pytest.mark.parametrize("scorer, cutoff", [("token_sort_ratio", 80), ("token_sort_ratio", 91), ("token_set_ratio", 80), ("ratio", 80), ("token_sort_ratio", 55), ("token_set_ratio", 61)])
def test_every_match_is_found(spark, scorer, cutoff):
    names, choices = misspelt(cutoff)
    choices = choices if scorer != "ratio" else [c and c.upper() for c in choices]
    a, b = (spark.createDataFrame([(x,) for x in xs], "name string") for xs in (names, choices))
    assert found(M.fuzzy_match(a, b, "name", scorer, cutoff)) == brute(names, choices, scorer, cutoff)


def test_empty_sides(spark):
    none, some = spark.createDataFrame([], "name string"), spark.createDataFrame([("a b",)], "name string")
    assert M.fuzzy_match(none, some, "name").collect() == []
    assert found(M.fuzzy_match(some, none, "name")) == {"a b": (None, 0)}


def test_blocks_leave_few_candidates(spark):
    rng = random.Random(6)
    syllables = [a + b for a in "bcdfghklmnprstvz" for b in "aeiou"]
    choices = [" ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(2)) for _ in range(1500)]
    names = [c.replace(c[4], "", 1) for c in choices[:700]]
    a, b = (spark.createDataFrame(list(enumerate(xs)), "id long, key string") for xs in (names, choices))
    keys = [x.select("id", M.sorted_tokens("key").alias("key")) for x in (a, b)]
    assert M.candidates(*keys, "token_sort_ratio", 91).count() < 0.02 * len(names) * len(choices)


def column(spark, sf, text):
    return [r[0] for r in Q.V.view(spark, sf, text).collect()]


@pytest.mark.parametrize("name, scorer", [("fuz03_client_token_sort", "token_sort_ratio"), ("fuz04_client_token_set", "token_set_ratio"), ("fuz05_client_two_rounds", None)])
def test_whole_queries_of_clients(spark, sf, name, scorer):
    names, choices = column(spark, sf, Q.CLIENT_RECORDS), column(spark, sf, Q.CLIENT_MASTERS)
    assert found(Q.QUERIES[name](spark, sf)) == (brute(names, choices, scorer, 80) if scorer else two_rounds(names, choices))


def test_whole_queries_of_vessels(spark, sf):
    names = column(spark, sf, "SELECT DISTINCT upper(p_name) FROM {part}")
    choices = column(spark, sf, f"SELECT vessel_name FROM ({Q.V.REGISTRY})")
    assert found(Q.QUERIES["fuz01_token_sort"](spark, sf), "vessel_name") == brute(names, choices, "token_sort_ratio", 80)
    assert found(Q.QUERIES["fuz02_two_rounds"](spark, sf), "vessel_name") == two_rounds(names, choices)


def standardised(rows, registry):
    """(shipment, imo, name, kind) by the registry: one row for each name and each IMO, names and IMOs fill each other, then IMO, then two rounds."""
    known = {}
    for name, imo, kind in sorted((r for r in registry if r[0] and r[1]), key=lambda r: (r[0], r[1])):
        known.setdefault(name, (imo, kind))
    by_imo = {}
    for name, (imo, kind) in sorted(known.items()):
        by_imo.setdefault(imo, (name, kind))
    known = {name: (imo, kind) for imo, (name, kind) in by_imo.items()}
    least = lambda pairs: {k: min(v for x, v in pairs if x == k) for k in {x for x, _ in pairs}}
    imo_of = least({(n, i) for _, i, n, _ in rows if n is not None and i is not None})
    rows = [(s, imo_of.get(n) if i is None else i, n, k) for s, i, n, k in rows]
    name_of = least({(i, n) for _, i, n, _ in rows if n is not None and i is not None})
    rows = [(s, i, name_of.get(i) if n is None else n, k) for s, i, n, k in rows]
    lost = {n for _, i, n, _ in rows if n is not None and i not in by_imo}
    match = two_rounds(lost, list(known))
    out = []
    for s, i, n, k in rows:
        if i in by_imo:
            out.append((s, i, by_imo[i][0], by_imo[i][1], 100))
        elif n in match:
            m, score = match[n]
            out.append((s, known[m][0], m, known[m][1], score))
        else:
            out.append((s, None, n, k, 0))
    return [(s, i, None if n is None or n.isdigit() else n.upper(), k, score) for s, i, n, k, score in out]


@pytest.mark.parametrize("query, rows, registry", [("ves01_standardise_vessels", f"SELECT shipment_id, vessel_imo, vessel_name, vessel_type FROM ({Q.V.SHIPMENTS})", Q.V.REGISTRY), ("ves02_standardise_fleet", Q.FLEET_SHIPMENTS, Q.FLEET)])
def test_whole_queries_of_standardised_vessels(spark, sf, query, rows, registry):
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [(r["shipment_id"], r["vessel_imo"], r["vessel_name"], r["vessel_type"], r["match_score"]) for r in Q.QUERIES[query](spark, sf).collect()]
    rows = [tuple(r) for r in Q.V.view(spark, sf, rows).select("shipment_id", "vessel_imo", "vessel_name", "vessel_type").collect()]
    registry = [tuple(r) for r in Q.V.view(spark, sf, registry).select("vessel_name", "vessel_imo", "vessel_type").collect()]
    assert sorted(got, key=key) == sorted(standardised(rows, registry), key=key)


@pytest.mark.parametrize("scorer, cutoff", [("token_sort_ratio", 80), ("token_set_ratio", 80), ("ratio", 80), ("token_set_ratio", 61)])
def test_names_with_a_near_choice_leave_before_the_cutoff(spark, monkeypatch, scorer, cutoff):
    names, choices = misspelt(cutoff + 1)
    choices = choices if scorer != "ratio" else [c and c.upper() for c in choices]
    asked, candidates = {}, M.candidates
    monkeypatch.setattr(M, "candidates", lambda a, b, s, least: (asked.update({least: a.count()}), candidates(a, b, s, least))[1])
    a, b = (spark.createDataFrame([(x,) for x in xs], "name string") for xs in (names, choices))
    assert found(M.fuzzy_match(a, b, "name", scorer, cutoff, rungs_from=0)) == brute(names, choices, scorer, cutoff)
    assert list(asked) == [*(r for r in M.RUNGS if r > cutoff), cutoff] and asked[cutoff] < asked[M.RUNGS[0]]
