"""Connected components by contraction, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.llm.base import Store


def connected_components(edges: DataFrame, store: Store) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b); root is the smallest node.

    Each round hooks every node to its smallest neighbour, jumps along these
    hooks to their ends, and contracts the edges to those ends. A group by
    node only takes minima, which are combined before the shuffle, so a hub
    with a third of all edges is no hot task. Loops and repeated edges are
    ignored, as are edges with a null end; no edges give no rows.
    """
    edges = (
        edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )
    edges = store.put(edges)
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("other")).unionByName(
            edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        )
        hooks = ends.groupBy("node").agg(F.min("other").alias("other"))
        parents = store.put(hooks.select("node", F.least("node", "other").alias("root")))
        while True:
            upper = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = store.put(
                parents.join(upper, "root").select(
                    "node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")
                )
            )
            moved = not jumped.filter("moved").isEmpty()
            parents = jumped.select("node", "root")
            if not moved:
                break
        if labels is None:
            labels = parents
        else:
            upper = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = store.put(
                labels.join(upper, "root", "left").select(
                    "node", F.coalesce("top", "root").alias("root")
                )
            )
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = store.put(
            edges.join(left, "a")
            .join(right, "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .filter(F.col("a") != F.col("b"))
            .distinct()
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
