"""Connected components of an edge table, as Spark jobs: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); component: the smallest node reachable.

    A large-star step hangs every larger neighbour of a node on the smallest node around it; a
    small-star step hangs a node's smaller neighbours and itself on the smallest of them.
    Smallest neighbours are found with map-side combine; the joins have one row a node on
    one side, so Spark can split a hot node on the other. Each round is cut to the shared folder.
    """
    now, n = compact(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    before = None
    while n:
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("node", "other")
        smallest = both.groupBy("node").agg(F.min("other").alias("m")).select(
            F.col("node").alias("lo"), F.least("m", "node").alias("m"))
        large = now.join(smallest, "lo").select("hi", F.col("m").alias("lo")).where("hi <> lo")
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.explode(F.array(
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.hi", "e.lo")
        now, n = compact(small.where("hi <> lo").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
