"""Connected components by alternating large and small stars; every step a partial minimum and one join on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeline.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``, of one orderable type): the smallest node it is connected with.

    Each step saves its table, so lineage stays short, and joins two written tables, so the adaptive planner can split a
    node with very many edges.
    """
    a, b = F.col("a"), F.col("b")
    now = saved(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "stars")
    while True:
        ends = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = saved(ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "stars")
        large = ends.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where(a != b)
        large = saved(large.distinct(), "stars")
        least = saved(large.groupBy("a").agg(F.min("b").alias("m")), "stars")
        small = large.join(least, "a")
        now = saved(small.select("a", F.col("m").alias("b")).union(small.where("b != m").select("b", "m")).distinct(), "stars")
        sides = now.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("b", F.lit(0), F.lit(1)))
        if sides.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up > 0 and down > 0)").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
