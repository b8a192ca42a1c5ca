"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.llm.common import release, staged


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (columns a, b: bigint, not null); a label is the
    smallest node of its component.

    Only minima are grouped (with partial sums on the map side) and joined back,
    so a node with very many links is never gathered in one row or task.
    """
    spark = links.sparkSession
    edges = staged(_ordered(links), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = _ordered(large)  # (node, a smaller node)
        low = larger.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (larger.join(low, F.col("a") == F.col("u")).select("b", "m").filter("b <> m")
                 .unionByName(low.select(F.col("u").alias("b"), "m")))
        new = staged(_ordered(small.select(F.col("b").alias("a"), F.col("m").alias("b"))), "edges")
        done = _mark(new) == _mark(edges)
        release(spark, edges)
        edges = new
        if done:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
