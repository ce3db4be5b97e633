"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.session import materialise


def _minima(pairs: DataFrame) -> DataFrame:
    """``u``, ``v`` with ``m``, the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    joined = pairs.join(least, "u")
    return joined.withColumn("m", F.least("u", "m"))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        found = _minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        linked = _minima(down)
        found = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            linked.select("u", F.col("m").alias("v"))
        )
    return found.where("u <> v").distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every linked node but the smallest of its component, which is v.

    ``links`` holds pairs (u, v) of numbers in any order, repeated or not. Every round is
    written to the shared folder; only a count and a checksum reach the driver.
    """
    edges = materialise(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while True:
        edges = materialise(_stars(_stars(edges, large=True), large=False), "stars")
        now = _print(edges)
        if now == before:
            return edges
        before = now
