"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """The smallest id reachable from each id of `links` (a, b), as (id, label).

    Alternates two steps that hang neighbours below the smallest id seen, until
    nothing changes; the number of rounds grows with the logarithm of the ids.
    Smallest ids are aggregated before the shuffle, and a node with very many
    links only makes its side of a join long, which Spark splits.
    """
    edges = stored(_undirected(links), "links")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = _undirected(large)
        least = down.groupBy("b").agg(F.min("a").alias("m"))
        hung = F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))
        small = down.join(least, "b").select(F.explode(hung).alias("e"))
        edges = stored(_undirected(small.select("e.x", "e.y").toDF("a", "b")), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    hung = edges.select(F.col("b").alias("id"), F.col("a").alias("label"))
    return hung.unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("label")).distinct())


def _undirected(links: DataFrame) -> DataFrame:
    """Each link once, the smaller id first; no loops."""
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
