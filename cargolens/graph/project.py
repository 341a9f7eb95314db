"""Projected graphs: a choice of nodes and edges, and filtered sub-graphs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .build import MISSING


@dataclass(frozen=True)
class Projection:
    """``nodes(id, …)`` and ``edges(src, dst, …)``."""

    nodes: DataFrame
    edges: DataFrame

    def subgraph(self, keep: Column) -> Projection:
        """The nodes where ``keep`` holds, and the edges with both ends among them."""
        nodes = self.nodes.filter(keep)
        ids = nodes.select("id")
        edges = self.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return Projection(nodes, edges)

    def named(self) -> Projection:
        """Without the nodes that stand for a missing name."""
        return self.subgraph(F.col("key") != MISSING)

    def undirected(self) -> DataFrame:
        back = self.edges.select(*(F.col({"src": "dst", "dst": "src"}.get(c, c)).alias(c) for c in self.edges.columns))
        return self.edges.unionByName(back)

    def with_reverse(self) -> Projection:
        return Projection(self.nodes, self.undirected())


def with_results(nodes: DataFrame, **results: DataFrame) -> DataFrame:
    """Write-back: the columns of results (id, …) joined to the nodes, each under
    ``{name}_{column}`` (a result of one column under its name). Nodes without a
    result keep nulls."""
    for name, found in results.items():
        columns = [c for c in found.columns if c != "id"]
        nodes = nodes.join(found.select("id", *(F.col(c).alias(name if len(columns) == 1 else f"{name}_{c}") for c in columns)), "id", "left")
    return nodes


def renamed(nodes: DataFrame, names: dict[str, str | None], labels: tuple[str, ...] | None = None) -> DataFrame:
    """Properties renamed, or removed where the new name is None; with ``labels``,
    only nodes of these labels keep the renamed ones."""
    for old, new in names.items():
        if old not in nodes.columns:
            continue
        if new is None:
            nodes = nodes.drop(old)
        else:
            value = F.col(old) if labels is None else F.when(F.col("label").isin(*labels), F.col(old))
            nodes = nodes.withColumn(new, value).drop(*([old] if old != new else []))
    return nodes


def query(graph: Projection, text: str, want: str | None = "data"):
    """Spark SQL over ``{nodes}`` and ``{edges}``. ``want``: "data" (a DataFrame),
    "values" (its rows, for small answers), "graph" (a projection: the result gives
    the nodes' ids) or None (run for its effect)."""
    found = graph.nodes.sparkSession.sql(text, **{k: v for k, v in (("nodes", graph.nodes), ("edges", graph.edges)) if "{" + k + "}" in text})
    if want == "data":
        return found
    if want == "values":
        return [tuple(r) for r in found.collect()]
    if want == "graph":
        ids = found.select("id").distinct()
        kept = graph.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return Projection(graph.nodes.join(ids, "id", "left_semi"), kept)
    if want is None:
        found.write.format("noop").mode("overwrite").save()
        return None
    raise ValueError(f"want {want!r}: data, values, graph or None")


class Catalog:
    """Named projections of a session."""

    def __init__(self) -> None:
        self._graphs: dict[str, Projection] = {}

    def put(self, name: str, graph: Projection) -> Projection:
        self._graphs[name] = graph
        return graph

    def get(self, name: str) -> Projection:
        return self._graphs[name]

    def list(self) -> list[str]:
        return sorted(self._graphs)

    def drop(self, name: str) -> bool:
        return self._graphs.pop(name, None) is not None
