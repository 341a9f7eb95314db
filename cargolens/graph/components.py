"""Connected components by hooking and alternating star contraction.

Each node is hooked to its least neighbour; the trees of these edges, which are no more
than nodes, are found by stars and stand for their nodes in the edges that are left
between them, until none is. So all edges are gone through a few times only, and trees at
least halve in each turn. Stars: large-star links every node's larger neighbours to the least node of its
neighbourhood, small-star its smaller ones. The number of edges never grows,
components become stars around their least node after a number of rounds that
follows the logarithm of the diameter, and every round is a few hash shuffles.
Only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import if_small, materialize

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _starred(now: DataFrame) -> DataFrame:
    """``(node, component)`` of edges (a, b) by alternating stars."""
    state = _state(now)
    if not state[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now)), "cc")
        last, state = state, _state(now)
        if last == state:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for each node with an edge to another node; the
    component is its least node. Nulls and loops link nothing."""
    now = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).filter(f"{src} is not null and {dst} is not null and a <> b")
    now, found = materialize(now, "cc-edges"), None
    for _ in range(MAX_ROUNDS):
        # each node's edge to its least neighbour: so many edges as nodes, whose trees hold two nodes or more
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        roots = materialize(_starred(materialize(hooks, "cc")), "cc-roots")
        if found is None:
            found = roots
        else:
            found = materialize(found.join(roots.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left").select("node", F.coalesce("_to", "component").alias("component")), "cc-found")
        # what is left links trees
        of = lambda end: if_small(roots.select(F.col("node").alias(end), F.col("component").alias(f"_{end}")))  # noqa: B023, E731
        left = now.join(of("a"), "a").join(of("b"), "b").filter("_a <> _b")
        now = materialize(left.select(F.greatest("_a", "_b").alias("a"), F.least("_a", "_b").alias("b")).distinct(), "cc-edges")
        if now.isEmpty():
            return found
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")


def extended(state: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Components after more edges: ``state`` (node, component) as ``components`` gives it,
    of the edges so far. Only the graph of the components that the new edges connect is
    run through; the others keep their rows."""
    of = lambda end, name: state.select(F.col("node").alias(end), F.col("component").alias(name))
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null and a <> b").distinct()
    between = ends.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    over = materialize(components(between, "a", "b"), "over").select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = state.join(over, state["component"] == over["old"], "left").select("node", F.coalesce("new", "component").alias("component"))
    fresh = over.join(state.select("node"), over["old"] == state["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return moved.unionByName(fresh)
