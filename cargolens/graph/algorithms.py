"""Graph algorithms as iterated joins over edge tables.

Every loop writes its state to the shared folder once per round, so lineage stays
short and lost executors cost one round at most. Only counts and maxima reach the
driver.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .communities import numbered
from .components import components
from .project import Projection
from .set_similarity import least_ids, similar_sets, top_k

#: Labels (16 bytes each) that label propagation broadcasts.
LABELS = 1_000_000


def degree(graph: Projection) -> DataFrame:
    """Ends of edges at each node (parallel edges count separately, a loop twice)."""
    ends = graph.edges.select(F.col("src").alias("id")).unionAll(graph.edges.select(F.col("dst").alias("id"))).groupBy("id").agg(F.count("*").alias("degree"))
    return graph.nodes.select("id").join(ends, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def _sized(df: DataFrame, column: str) -> DataFrame:
    """Adds the size of each group, from a partial aggregate (a large group stays split)."""
    sizes = df.groupBy(column).agg(F.count("*").alias("size"))
    return df.join(sizes, column)


def wcc(graph: Projection) -> DataFrame:
    """``(id, component, size)``; the component is its least id."""
    found = components(graph.edges).withColumnRenamed("node", "id")
    out = graph.nodes.select("id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return _sized(out, "component").select("id", "component", "size")


def scc(graph: Projection, max_rounds: int = 200) -> DataFrame:
    """Strongly connected components by forward and backward colouring.

    Nodes with edges both ways between them are in one component; what such pairs
    connect is one node for the rest. Each round gives every open node the least
    open node that reaches it, and settles those that can reach that node back
    within their colour.
    """
    ids = graph.nodes.select("id").distinct()
    # one row for each pair of ends, and which ways it is linked
    up, ends = F.col("src") < F.col("dst"), (F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    ways = materialize(graph.edges.filter("src <> dst").select(*ends, up.alias("up")).groupBy("src", "dst").agg(F.max("up").alias("up"), F.max(~F.col("up")).alias("down")), "scc-ways")
    both = F.col("up") & F.col("down")
    whole = components(ways.filter(both))
    whole = materialize(ids.join(whole.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("whole")), "scc-whole")
    one = ways.filter(~both).select(F.when(F.col("up"), F.col("src")).otherwise(F.col("dst")).alias("src"), F.when(F.col("up"), F.col("dst")).otherwise(F.col("src")).alias("dst"))
    at = lambda end: whole.select(F.col("id").alias(end), F.col("whole").alias(f"_{end}"))
    edges = one.join(at("src"), "src").join(at("dst"), "dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst"))
    edges = materialize(edges.filter("src <> dst").distinct(), "scc-edges")
    # what is on no edge now is settled
    on = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    heads = materialize(whole.select(F.col("whole").alias("id")).distinct().join(on.withColumn("open", F.lit(True)), "id", "left"), "scc-heads")
    done = heads.filter("open is null").select("id", F.col("id").alias("component"))
    open_ids = materialize(heads.filter("open").select("id"), "scc-open")
    for _ in range(max_rounds):
        if open_ids.isEmpty():
            break
        colour = _spread(open_ids.withColumn("label", F.col("id")), edges)
        inside = edges.join(colour.select(F.col("id").alias("src"), F.col("label").alias("ls")), "src").join(colour.select(F.col("id").alias("dst"), F.col("label").alias("ld")), "dst").filter("ls = ld")
        back = inside.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        roots = colour.withColumn("label", F.when(F.col("id") == F.col("label"), F.col("id")))
        reached = _spread(roots, materialize(back, "scc-back")).filter("label is not null")
        settled = materialize(reached.join(colour.withColumnRenamed("label", "colour"), "id").filter("label = colour").select("id", F.col("label").alias("component")), "scc-settled")
        done = done.unionByName(settled)
        open_ids = materialize(open_ids.join(settled, "id", "left_anti"), "scc-open")
        edges = materialize(edges.join(settled.select(F.col("id").alias("src")), "src", "left_anti").join(settled.select(F.col("id").alias("dst")), "dst", "left_anti"), "scc-edges")
    else:
        raise RuntimeError("strongly connected components: too many rounds")
    done = whole.join(done.withColumnRenamed("id", "whole"), "whole").select("id", "component")
    return _sized(done, "component").select("id", "component", "size")


def _spread(labels: DataFrame, edges: DataFrame, max_rounds: int = 500) -> DataFrame:
    """Least label along directed edges, to a fixed point."""
    now = materialize(labels, "spread")
    for _ in range(max_rounds):
        sent = edges.join(now.select(F.col("id").alias("src"), "label"), "src").filter("label is not null").groupBy(F.col("dst").alias("id")).agg(F.min("label").alias("sent"))
        new = now.join(sent, "id", "left").select("id", F.least("label", "sent").alias("label"), (~F.least("label", "sent").eqNullSafe(F.col("label"))).alias("moved"))
        new = materialize(new, "spread")
        moved = new.filter("moved").limit(1).count()
        now = new.drop("moved")
        if not moved:
            return now
    raise RuntimeError("label spreading: too many rounds")


def label_propagation(graph: Projection, rounds: int = 10) -> DataFrame:
    """``(id, community, size)``: each round a node takes the commonest label among
    its neighbours (ties: the least), all nodes at once."""
    names = numbered(graph.nodes.select("id").distinct())  # in the order of ids, so ties stay as they are
    number = lambda end: names.select(F.col("id").alias(end), F.col("node").alias(f"_{end}"))
    edges = graph.edges.select("src", "dst").join(number("src"), "src").join(number("dst"), "dst").select(F.col("_src").alias("src"), F.col("_dst").alias("dst"))
    ends = Projection(names, materialize(edges, "lpa-edges")).undirected()
    # kept by target: with labels that are small enough to broadcast, votes are counted in place
    ends = ends.repartition("dst").persist(StorageLevel.MEMORY_AND_DISK)
    now = names.select(F.col("node").alias("id"), F.col("node").alias("community"))
    side = F.broadcast if names.count() <= LABELS else lambda df: df
    for _ in range(rounds):
        votes = ends.join(side(now.select(F.col("id").alias("src"), "community")), "src").groupBy("dst", "community").agg(F.count("*").alias("n"))
        win = votes.groupBy(F.col("dst").alias("id")).agg(F.min(F.struct((-F.col("n")).alias("n"), "community"))["community"].alias("new"))
        new = now.join(win, "id", "left").select("id", F.coalesce("new", "community").alias("community"), (F.coalesce("new", "community") != F.col("community")).alias("moved"))
        new = materialize(new, "lpa")
        moved = new.filter("moved").limit(1).count()
        now = new.drop("moved")
        if not moved:
            break
    ends.unpersist()
    name = lambda number, id_: names.select(F.col("node").alias(number), F.col("id").alias(id_))
    sized = _sized(now, "community").withColumnRenamed("id", "node")
    return sized.join(name("node", "id"), "node").join(name("community", "_name"), "community").select("id", F.col("_name").alias("community"), "size")


def pagerank(graph: Projection, weight: str | None = None, damping: float = 0.85, iterations: int = 20, tolerance: float = 1e-7, directed: bool = True) -> DataFrame:
    """``(id, rank)`` with ``rank = (1 - d) + d * sum of shares``; a node's rank is
    shared among its outgoing edges, by weight if one is named. Ranks are not
    normalised, and what a node without outgoing edges has is not passed on."""
    edges = graph.edges if directed else graph.undirected()
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    edges = edges.groupBy("src", "dst").agg(F.sum(w).alias("w")).filter("w > 0")
    total = edges.groupBy("src").agg(F.sum("w").alias("total"))
    shares = materialize(edges.join(total, "src").select("src", "dst", (F.col("w") / F.col("total")).alias("share")), "pr-edges")
    ranks = graph.nodes.select("id", F.lit(1.0 - damping).alias("rank"))
    for _ in range(iterations):
        sent = shares.join(ranks.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        new = ranks.join(sent, "id", "left").select("id", (F.lit(1.0 - damping) + damping * F.coalesce("got", F.lit(0.0))).alias("rank"), F.col("rank").alias("old"))
        new = materialize(new, "pr")
        change = new.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0]
        ranks = new.drop("old")
        if change is None or change < tolerance:
            break
    return ranks


def min_max(scores: DataFrame, column: str = "rank", by: str | None = None) -> DataFrame:
    """Adds ``{column}_scaled`` in 0..1 (0 where all are equal), over all rows or within groups."""
    keys = [by] if by else []
    ends = scores.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    joined = scores.join(ends, by) if by else scores.crossJoin(F.broadcast(ends))  # a single row
    scaled = F.when(F.col("_hi") > F.col("_lo"), (F.col(column) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0)
    return joined.withColumn(f"{column}_scaled", scaled).drop("_lo", "_hi")


def pagerank_if_connected(graph: Projection, **settings) -> DataFrame:
    """PageRank of a graph with one weak component, else the sizes of its components."""
    parts = wcc(graph).groupBy("component").agg(F.count("*").alias("size"))
    if parts.limit(2).count() > 1:
        return parts
    return pagerank(graph, **settings)


def pagerank_in_communities(graph: Projection, communities: DataFrame, **settings) -> DataFrame:
    """PageRank within each community in one pass over the edges that stay inside;
    members of communities of one have rank 0. ``communities``: (id, community)."""
    placed = materialize(communities.select("id", "community"), "placed")
    sizes = placed.groupBy("community").agg(F.count("*").alias("size"))
    inside = graph.edges.join(placed.select(F.col("id").alias("src"), F.col("community").alias("cs")), "src").join(placed.select(F.col("id").alias("dst"), F.col("community").alias("cd")), "dst").filter("cs = cd").drop("cs", "cd")
    ranks = pagerank(Projection(graph.nodes, inside), **settings)
    out = ranks.join(placed, "id").join(sizes, "community").withColumn("rank", F.when(F.col("size") > 1, F.col("rank")).otherwise(0.0))
    return min_max(out.drop("size"), "rank", "community")


# -- similarity ---------------------------------------------------------------


def jaccard(graph: Projection, k: int = 14, cutoff: float = 0.01, max_degree: int | None = None) -> DataFrame:
    """The ``k`` most similar nodes of each node by the Jaccard index of their neighbour
    sets (``set_similarity``); ``max_degree`` leaves out shared neighbours of more links, if given."""
    return similar_sets(graph.edges, k, cutoff, max_degree)


def knn(nodes: DataFrame, properties: dict[str, str], k: int = 14) -> DataFrame:
    """The ``k`` nearest nodes of the same label. ``properties``: column -> COSINE or
    JACCARD; the score is the mean of the single similarities, ties go to the least id.

    Of two numbers, COSINE is 1 for equal signs, else 0 (0 with a zero), JACCARD is
    1 for equal values, else 0. So the score only depends on which properties
    match, and it is enough to look up, for each subset of the properties, the
    ``k + 1`` least ids of those that match in all of it: equi-joins of linear size.
    Nulls count as 0.
    """
    cols = sorted(properties)
    number = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    part = {c: F.when(number[c] != 0, F.signum(number[c])) if properties[c].upper() == "COSINE" else number[c] for c in cols}
    values = materialize(nodes.select("id", "label", *(part[c].alias(c) for c in cols)), "knn")
    found = None
    for mask in range(1 << len(cols)):
        keys = ["label", *(c for i, c in enumerate(cols) if mask >> i & 1)]
        least = least_ids(values.na.drop(subset=keys), keys, k + 1)
        hit = values.join(least, keys).select(F.col("id").alias("src"), F.explode("ids").alias("dst"))
        found = hit if found is None else found.unionByName(hit)
    pairs = found.filter("src <> dst").distinct()
    other = values.select(F.col("id").alias("dst"), *(F.col(c).alias(f"{c}_2") for c in cols))
    same = sum((F.coalesce((F.col(c) == F.col(f"{c}_2")).cast("int"), F.lit(0)) for c in cols), F.lit(0))
    scored = pairs.join(values.withColumnRenamed("id", "src"), "src").join(other, "dst").select("src", "dst", (same / len(cols)).alias("score"), "label")
    return top_k(scored, k)


# -- roll-ups and reports -----------------------------------------------------


def community_ranks(scores: DataFrame) -> DataFrame:
    """Size and least and greatest rank of each community, largest first."""
    return scores.groupBy("community").agg(F.count("*").alias("size"), F.min("rank").alias("rank_min"), F.max("rank").alias("rank_max")).orderBy(F.desc("size"), "community")


def community_average(scores: DataFrame, factor: float = 1e6) -> DataFrame:
    """Each member with its community's size and mean rank (times ``factor``, 4 digits)."""
    means = scores.groupBy("community").agg(F.count("*").alias("size"), F.round(F.avg("rank") * factor, 4).alias("rank_avg"))
    return scores.join(means, "community")


#: Ranges of community numbers (both ends excluded but for the first,
#: which is open below) and the range of scores of each; other communities draw
#: from the last range.
SCORE_RANGES = (
    ((-1, 100_000), (1, 100)),
    ((100_000, 500_000), (100, 200)),
    ((500_000, 1_000_000), (200, 300)),
    ((1_000_000, 2_000_000), (300, 400)),
    ((2_000_000, 2_150_000), (400, 500)),
    ((2_150_000, 2_350_000), (500, 600)),
    ((2_350_000, 2_450_000), (600, 700)),
    ((2_450_000, 2_600_000), (700, 800)),
    ((2_600_000, 2_750_000), (800, 900)),
    ((2_750_000, 2_850_000), (900, 999)),
)
ANY_SCORE = (1, 999)
#: Scores above the first end (any, in the first row, below the second;
#: else up to the second) move by the third.
SCORE_SHIFTS = ((None, 100, 200), (100, 200, 100), (200, 300, 0), (300, 400, -100), (400, 500, 200), (500, 600, 100), (600, 700, 0), (700, 800, -100), (800, 900, -200), (900, 1000, -250))


def drawn(seed: int, number: str = "community") -> Column:
    """A number in [0, 1) that depends on the seed and the community alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(number).cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def financial_score(members: DataFrame, seed: int = 42) -> DataFrame:
    """``(id, community, score, score_avg)`` from members ``(id, community, name)``
    with numbered communities: a score drawn for each community from the range of
    its number, moved by the member's range of scores, and the community's mean.

    Members whose name begins with S move by the shift of the first range that
    holds their score (null if none does), the others by that of the first range
    that does not, as the published results have it."""
    raw = lambda ends: F.floor(drawn(seed) * (ends[1] - ends[0]) + ends[0]).cast("long")
    n = F.col("community")
    score = F.lit(None)
    for (low, high), ends in reversed(SCORE_RANGES):
        score = F.when((n > low) & (n < high), raw(ends)).otherwise(score)
    score = F.coalesce(score, raw(ANY_SCORE))
    s, inside = F.col("raw"), []
    for low, high, shift in SCORE_SHIFTS:
        inside.append(((s < high) if low is None else (s > low) & (s <= high), shift))
    held, other = F.lit(None).cast("long"), F.lit(None).cast("long")
    for holds, shift in reversed(inside):
        held, other = F.when(holds, F.lit(shift)).otherwise(held), F.when(~holds, F.lit(shift)).otherwise(other)
    out = members.select("id", "community", "name", score.alias("raw"))
    out = out.select("id", "community", (s + F.when(F.coalesce(F.startswith("name", F.lit("S")), F.lit(False)), held).otherwise(other)).cast("long").alias("score"))
    means = out.groupBy("community").agg(F.avg("score").cast("long").alias("score_avg"))
    return out.join(means, "community").select("id", "community", "score", "score_avg")


def size_histogram(members: DataFrame, column: str = "community", bins: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 8, 10, 15, 20, 50, 100, 500, 1000, 10000)) -> DataFrame:
    """Communities by size in half-open bins: how many, how many members, mean, shares."""
    sizes = members.groupBy(column).agg(F.count("*").alias("size"))
    low = F.lit(None).cast("long")
    for b in bins:
        low = F.when(F.col("size") >= b, F.lit(b).cast("long")).otherwise(low)
    out = sizes.withColumn("bin", low).groupBy("bin").agg(F.count("*").alias("communities"), F.sum("size").alias("members"), F.round(F.avg("size"), 4).alias("mean_size"))
    total = out.agg(F.sum("communities").alias("_c"), F.sum("members").alias("_m"))
    return out.crossJoin(F.broadcast(total)).select("bin", "communities", "members", "mean_size", F.round(100 * F.col("communities") / F.col("_c"), 4).alias("communities_pct"), F.round(100 * F.col("members") / F.col("_m"), 4).alias("members_pct"))


def od_pairs(edges: DataFrame, first: str = "CARRIES_FROM", second: str = "CARRIES_TO") -> DataFrame:
    """Ports joined by a common carrier: origin, destination and number of carriers."""
    a = edges.filter(F.col("type") == first).select(F.col("src").alias("carrier"), F.col("dst").alias("origin")).distinct()
    b = edges.filter(F.col("type") == second).select(F.col("src").alias("carrier"), F.col("dst").alias("destination")).distinct()
    return a.join(b, "carrier").groupBy("origin", "destination").agg(F.count("*").alias("carriers"))
