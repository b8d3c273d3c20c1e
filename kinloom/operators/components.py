"""Connected components by hooking to the least neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.session import staged, unstage


def _is_empty(df: DataFrame) -> bool:
    return not df.head(1)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that is not the least of its component.

    The component is its least node. Each round hooks every node to its least neighbour if
    that is smaller, follows the pointers to their ends by doubling, and contracts the
    graph; a round leaves at most half of the nodes of each component, so rounds
    and jumps are logarithmic in the longest path. Nothing is gathered by node: a hub
    costs one row for each edge in aggregations and joins that Spark can split.
    """
    graph = staged(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo <> hi").distinct(), "graph"
    )
    labels = None
    while True:
        last = hooks = staged(graph.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component")), "hooks")
        while True:
            ends = hooks.select(F.col("node").alias("component"), F.col("component").alias("further"))
            jumped = staged(
                hooks.join(ends, "component", "left").select("node", F.coalesce("further", "component").alias("component"), F.col("further").isNotNull().alias("moved")),
                "jumps",
            )
            unstage(last)
            last, hooks = jumped, jumped.select("node", "component")
            if _is_empty(jumped.where("moved")):
                break
        ends = hooks.select(F.col("node").alias("component"), F.col("component").alias("further"))
        if labels is None:
            labels = hooks
        else:
            moved = labels.join(ends, "component", "left").select("node", F.coalesce("further", "component").alias("component"))
            before, labels = labels, staged(moved.unionByName(hooks), "labels")
            unstage(before)
        lo, hi = (hooks.select(F.col("node").alias(c), F.col("component").alias(f"{c}_end")) for c in ("lo", "hi"))
        before, graph = graph, staged(
            graph.join(lo, "lo", "left")
            .join(hi, "hi", "left")
            .select(F.coalesce("lo_end", "lo").alias("a"), F.coalesce("hi_end", "hi").alias("b"))
            .where("a <> b")
            .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            .distinct(),
            "graph",
        )
        unstage(before)
        if labels is not hooks:
            unstage(last)
        if _is_empty(graph):
            unstage(graph)
            return labels
