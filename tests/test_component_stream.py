"""Components of edges that arrive in files."""

import random

from cargolens.graph.components import components, extended
from cargolens.streaming.ingest import ComponentStream


def rows(df):
    return sorted(map(tuple, df.collect()))


def brute(edges):
    root = {}
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = root.setdefault(a, a), root.setdefault(b, b)
        root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return sorted(root.items())


def test_each_step_is_the_whole_graph(spark):
    rng = random.Random(2)
    months = [[(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(14)] for _ in range(3)] + [[], [(None, "n01"), ("n02", "n02")]]
    state, so_far = components(spark.createDataFrame([], "src string, dst string")), []
    for month in months:
        so_far += month
        state = extended(state, spark.createDataFrame(month, "src string, dst string"))
        assert rows(state) == brute(so_far)


def test_stream_stops_goes_on_and_repeats_a_batch(spark, tmp_path):
    months = [[("a", "b"), ("c", "d")], [("b", "c"), ("x", "y")], [("y", "a"), ("q", "r")]]
    files = str(tmp_path / "files")
    write = lambda i: spark.createDataFrame(months[i], "src string, dst string").coalesce(1).write.parquet(f"{files}/m{i}")
    stream = ComponentStream(spark, str(tmp_path / "wcc"))
    assert stream.state().collect() == []
    write(0)
    write(1)
    assert rows(stream.run(files)) == brute(months[0] + months[1]) and len(stream.versions()) == 2
    write(2)
    again = ComponentStream(spark, str(tmp_path / "wcc"))
    assert rows(again.run(files)) == brute(sum(months, []))
    assert rows(again.run(files)) == brute(sum(months, [])) and len(again.versions()) == 2  # nothing new
    again.add(spark.createDataFrame(months[2], "src string, dst string"), again.versions()[-1])
    assert rows(again.state()) == brute(sum(months, []))


def test_whole_query(spark, duck, sf):
    from cargolens.plans import store_queries

    q = store_queries.Q
    assert rows(q.QUERIES["gra02_wcc_stream"](spark, sf)) == sorted(duck.execute(q.ORACLE_SQL["gra02_wcc_stream"]).fetchall())
