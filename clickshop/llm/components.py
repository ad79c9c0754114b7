"""Connected components of an edge table, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickshop.llm.common import written


def stars(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that is not its component's least.

    Each round replaces edges by ones to the least neighbour, first for the larger
    neighbours of a node, then for the smaller ones.  A node's least neighbour is an
    aggregate, so hubs reduce before the shuffle; a round is written to the shared folder,
    which keeps the lineage short.  Rounds end when the edges stay the same.
    """
    now = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while (mark := _checksum(now)) != before:
        before = mark
        now = written(_small(_large(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    joined = both.join(least, both["a"] == least["u"])
    return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = edges.join(least, edges["a"] == least["u"]).filter("b <> m")
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()
