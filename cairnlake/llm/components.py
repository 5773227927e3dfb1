"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, saved_at


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, parts: int | None = None, most: int = 60) -> DataFrame:
    """(node, component) of every node that has a link to another; component is the least node it reaches.

    links has columns a and b, of an orderable type; order and repeats don't matter, and links of a
    node to itself or to null are left out. parts: at most so many files for each table. Every round is a saved table that replaces the one before, and the number of rounds grows with the
    logarithm of the largest component. Least neighbours are found by partial
    aggregation, so that a hub isn't gathered in one task.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, path = saved_at(edges, "links", parts)
    mark = _print(edges)
    if not mark[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(most):
        # Large star: neighbours above a node move to the least of its neighbours and itself.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: neighbours below a node, and the node, move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        below = pairs.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        older = path
        edges, path = saved_at(below.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links", parts)
        drop_saved(links.sparkSession, [older])
        before, mark = mark, _print(edges)
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"links did not settle in {most} rounds")
