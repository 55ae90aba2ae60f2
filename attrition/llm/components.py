"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round links every node's larger neighbours to its least neighbour, then
    its smaller ones; both are a grouped minimum and a join, so a node with many
    edges is aggregated before the shuffle. Rounds end when all edges make stars.
    """
    now = common.stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .filter("u <> v").distinct(), "edges")
    while not _stars(now):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        before, now = now, common.stored(small, "edges")
        common.forget(before)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v"), F.col("v"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` has one edge and is no smaller end ``v``."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
        .filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further ``links`` (a, b): only those between
    two components count, and what they join is found among the roots alone."""
    ends = links.select("a", "b").distinct()
    for end in ("a", "b"):
        place = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        ends = ends.join(place, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    moved = common.stored(components(ends.filter("root_a <> root_b")
                                     .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))), "moved")
    to = common.sized(moved.select(F.col("node").alias("root"), F.col("root").alias("to")))
    old = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return common.stored(old.union(moved.join(roots, "node", "left_anti").select("node", "root")), "roots")
