"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.session import materialize


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs directly on one root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("hangs")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(1).alias("hangs"))
    )
    seen = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("least"))
    return seen.filter("hangs > 1 OR (hangs = 1 AND least = 0)").isEmpty()


def _hang(edges: DataFrame, to_larger: bool) -> DataFrame:
    """Hang the larger (or smaller) neighbours of each node on the node's least neighbour or itself.

    The minima are written before they are joined, so that the partition of a
    node with very many neighbours can be split.
    """
    if to_larger:
        seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    else:
        least = edges.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("least"))
        pairs = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    least = materialize(least.withColumnRenamed("a", "of"), "least")
    hung = pairs.join(least, pairs.node == least.of).select(F.col("least").alias("a"), F.col("other").alias("b"))
    if not to_larger:
        hung = hung.unionByName(least.select(F.col("least").alias("a"), F.col("of").alias("b")))
    return materialize(hung.filter("a < b").distinct(), "hung")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node of ``edges``.

    Alternates large-star and small-star steps, each linear in the edges, until
    every node hangs on its root; the number of rounds grows with the logarithm of the
    graph's size, not with its diameter. Every step is a written table in the
    shared folder. Edges with a null end and loops are ignored, repeated edges
    count once; no edges give no rows. Ids of any type with an order will do.
    """
    known = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    ordered = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    current = materialize(ordered.distinct(), "edges")
    while not _is_settled(current):
        current = _hang(_hang(current, to_larger=True), to_larger=False)
    roots = current.select(F.col("a").alias("node")).distinct()
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def merge_components(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (``node, component``, stored) after the edges ``a, b`` of ``links`` are added.

    Only edges between groups are searched, so a few new edges cost little.
    """
    for end in ("a", "b"):
        side = groups.select(F.col("node").alias("_node"), F.col("component").alias(f"_{end}"))
        links = links.join(side, links[end] == side._node, "left").drop("_node")
    between = links.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    merged = materialize(components(between), "merged").select(F.col("node").alias("_node"), F.col("component").alias("_to"))
    moved = groups.join(merged, groups.component == merged._node, "left").select(
        "node", F.coalesce("_to", "component").alias("component")
    )
    known = groups.select(F.col("node").alias("_known"))
    new = merged.join(known, merged._node == known._known, "left_anti")
    return moved.unionByName(new.select(F.col("_node").alias("node"), F.col("_to").alias("component")))
