"""Connected components of a list of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v. Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
    Small star: the node and its smaller neighbours are tied to the smallest of them."""
    if large:
        sides = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = sides.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    tied = sides.join(least, sides.u == least.n)
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the component's smallest node.

    Each round is written to the shared folder, so a lost executor costs one round at most. Links stay distributed; the
    driver only sees a count and a checksum. Links of a node with itself are ignored; no links give no rows.
    """
    edges = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(state)
        edges = cut(_star(_star(edges, large=True), large=False), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
