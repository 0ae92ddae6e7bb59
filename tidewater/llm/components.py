"""Connected components of an edge table, by rounds of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; longs): root is the smallest node it reaches.

    Alternates two steps that hang every node below the smallest neighbour (large-star, small-star) until the
    edges are stars. Hubs are aggregated to one minimum before the join; the joins are plain, so that a hub's rows
    can be split. Each round is written, which cuts the lineage. Empty edges give no rows.
    """
    spark = edges.sparkSession
    stars = written(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "edges")
    seen = None
    while True:
        sign = stars.agg(F.count("*"), F.sum(F.xxhash64("v", "m") % 1_000_003), F.bit_xor(F.xxhash64("m", "v"))).first()
        if sign == seen:
            return stars.select(F.col("v").alias("node"), F.col("m").alias("root")).union(stars.select("m", "m").distinct())
        seen = sign
        both = stars.union(stars.select("m", "v")).toDF("v", "m")
        low = both.groupBy("v").agg(F.min("m").alias("low")).select("v", F.least("v", "low").alias("low"))
        large = both.where("m > v").join(low, "v").select(F.col("m").alias("v"), F.col("low").alias("m")).distinct()
        large = written(spark, large, "edges")
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").where("m <> low").select(F.col("m").alias("v"), F.col("low").alias("m"))
        stars = written(spark, small.union(low.toDF("v", "m")).distinct(), "edges")
