"""Connected components of a link table by contraction, all of it in DataFrames.

A round gives every node the smallest node within a few links, replaces the ends of all links by these labels, and goes on with the
links whose ends still differ. At most half of a component's nodes keep themselves as label, so rounds grow with the logarithm of its
size, and groups around a hub take one. Smallest neighbours come from two-step aggregates, so no task holds a hub's links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import staged

HOPS = 3


def labels(links: DataFrame, hops: int = HOPS) -> DataFrame:
    """(node, component): for every node of a link (a, b) the smallest node that at most `hops` links reach. Nodes of one
    label are connected; connected nodes may have different ones."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    for _ in range(hops - 1):  # a node's smallest neighbour has a label no larger than the node's own
        found = both.join(found, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("component")).select(F.col("a").alias("node"), "component")
    return found


def contracted(links: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct links between the labels of the ends, larger first, without those inside a label."""
    out = links.select("a", "b")
    for end in ("a", "b"):
        named = known.select(F.col("node").alias(end), F.col("component").alias("_c"))
        other = "b" if end == "a" else "a"
        out = out.join(named, end, "left").select(F.coalesce("_c", end).alias(end), other)
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of every node that a link (a, b) touches: one component for all that can reach each other.

    `known` may hold labels of links that are among these. Each round is written to the shared folder.
    """
    found = known
    edges = links.where("a <> b") if known is None else contracted(links, known)
    while True:
        edges = staged(edges, "links")
        if edges.isEmpty():
            break
        now = staged(labels(edges), "labels")
        found = now if found is None else staged(_through(found, now), "labels")
        edges = contracted(edges, now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found


def _through(first: DataFrame, then: DataFrame) -> DataFrame:
    """The labels of `first`, replaced by what `then` makes of them, and the nodes that only `then` has."""
    later = then.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
    moved = first.join(later, F.col("component") == F.col("_n"), "left").select("node", F.coalesce("_c", "component").alias("component"))
    return moved.union(then.join(first.select("node"), "node", "left_anti").select("node", "component"))
