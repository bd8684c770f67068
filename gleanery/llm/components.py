"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """id, label: for each id that occurs in links (a, b), the least id of its component.

    Alternating large and small stars: every node's larger neighbours, then its
    smaller ones, are hung on the least node around it, until nothing changes.
    Rounds grow with the logarithm of a component's size; no round collects a
    component in one task beyond what joins do, which Spark splits when skewed.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        edges = written(_small_star(_large_star(edges).distinct()).distinct(), "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("label"))).distinct()
