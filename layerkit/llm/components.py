"""Connected components of an edge table, by alternating large-star and small-star steps.

Each round replaces edges by edges to smaller nodes (public algorithm of Kiveris et al.,
"Connected Components in MapReduce and Beyond"). A round is two aggregations and two joins
over the edges; nothing is gathered by node, so a hub is a skewed join key that adaptive
execution may split, not a group. Edges of each round are written below
``spark.checkpoint.dir``; only their count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return (
        e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .filter("u != v").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v: long).

    ``component`` is the smallest node reachable. Direction, repeats and loops do not matter.
    """
    e = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, before = stored(e, "edges"), None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        e = stored(_small_star(_large_star(e)), "edges")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
