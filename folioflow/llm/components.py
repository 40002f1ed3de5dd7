"""Connected components of a table of links, distributed.

Contraction: each round every node takes as its representative the first, by a random order, of itself and its
neighbours; links are renamed to representatives, and links within one go. The last node of a component in the order
is never taken, so each round shrinks every component that still has a link: there is no limit of rounds, and a chain
halves in each (log2 of its length are expected). Every second round has the order of the one before, which ends a
star in two. Representatives of all rounds are then followed backwards. Only whether links are left reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, discard, stored


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def roots(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), stored: nodes of a component, and they alone, share a root.

    Links may repeat, join a node with itself (those name no node) and stand in either direction. ``rows``: how many
    they are at most, if that is known; few are written by few tasks.
    """
    edges, rounds = stored(_ordered(links), "links", rows), []
    while edges.limit(1).count():
        order = lambda c, k=len(rounds) // 2: F.xxhash64(F.col(c), F.lit(k))
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy("a").agg(F.min_by("b", order("b")).alias("_b"))
        near = stored(near.select(F.col("a").alias("node"), F.when(order("a") < order("_b"), F.col("a")).otherwise(F.col("_b")).alias("root")), "near", rows and 2 * rows)
        side = lambda c, n=near: n.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
        fewer = stored(_ordered(edges.join(side("a"), "a").join(side("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "links", rows)
        discard(edges)
        edges = fewer
        rounds.append(near)
    discard(edges)
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    label = rounds[-1]
    for near in rounds[-2::-1]:
        up = label.select(F.col("node").alias("_n"), F.col("root").alias("_up"))
        label = near.join(up, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_up", "root").alias("root"))
    out = stored(label, "roots", rows and 2 * rows)
    discard(*rounds)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node that it can reach."""
    label = roots(links)
    least = label.groupBy("root").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("members"))
    return attach_groups(label, least, "root", "members", label.count(), "node").select("node", "component")
