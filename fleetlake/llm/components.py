"""Connected components by large and small stars, on any number of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.session import cut_lineage

#: A node with more links than this, and than a 100,000th of all, is a hub: there are at most 200,000 of them.
HUB, SHARE = 1_000, 100_000


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of all nodes in ``links`` (a, b: longs).

    Each round points every node's larger neighbours to its least neighbour,
    and then its smaller ones, until nothing changes. Least neighbours are
    aggregated map-side and those of hubs are broadcast, so the links of a node
    with very many never meet in one task.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    before, hub = None, max(HUB, edges.count() // SHARE)
    while True:
        edges = cut_lineage(_star(_star(edges, True, hub), False, hub))
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
        ).first()
        if state == before or not state.n:
            break
        before = state
    return nodes.join(edges.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component")
    )


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with the fewest links: every other node of some links to its component's least."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    others = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[others], nodes[label[others]]


def _star(edges: DataFrame, large: bool, hub: int) -> DataFrame:
    """One operation; edges are (a, b) with a > b. Nodes of more than ``hub`` links are joined by broadcast."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
    hubs = F.broadcast(least.where(F.col("n") > hub).select("u", "m"))
    rest = both.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") <= hub).select("u", "m"), "u")
    joined = rest.union(both.join(hubs, "u"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            joined.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
