"""Connected components of a table of links, by alternating stars.

A round points every node's larger neighbours at its smallest neighbour, then its
smaller ones; links end as one star per component, after a number of rounds that
grows with the logarithm of the longest path. A node's neighbours are never
gathered: rounds are minima by key and joins. Each round is written to the shared
folder, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import new_folder


def _stored(edges: DataFrame, label: str) -> DataFrame:
    spark = edges.sparkSession
    folder = new_folder(spark, label)
    edges.write.parquet(folder)
    return spark.read.parquet(folder)


def _star(edges: DataFrame) -> DataFrame:
    """(node, smallest neighbour or itself) joined back to the node's links."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _summary(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(mixed).alias("x"), F.sum(mixed % 1_000_003).alias("s")
    ).first()
    return row.n, row.x, row.s


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every node that a link (a, b) names; the smallest id names it.

    Links to itself or with a null end count for nothing.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = _stored(edges.distinct(), "links")
    seen = _summary(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        stars = _star(large)
        small = stars.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(stars.select("u", F.col("m").alias("v"))).distinct()
        edges = _stored(small, "links")
        now = _summary(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return nodes.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))).distinct()
