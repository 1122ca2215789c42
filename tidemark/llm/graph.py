"""Connected components of an edge list by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import splittable_join
from tidemark.session import discard, materialise


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for every node of ``links`` (a, b) that is not a root.

    Each round hangs the larger neighbours of every node, then its smaller ones, under the smallest; rounds grow
    with the logarithm of the number of nodes. Minima are aggregated before the shuffle and joined back by joins that
    may split a hub, so its neighbours need not meet in one task. Each round is written to the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(spark, edges, "stars")
    before = _summary(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = splittable_join(low, both.where("v > u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = splittable_join(low, large, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = materialise(spark, small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "stars")
        discard(edges)
        edges, after = following, _summary(following)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
