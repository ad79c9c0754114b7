"""Exact distinct users that add up over days: bitmaps over numbered users.

A count of distinct users of a month cannot be had from the counts of its days, but the union of
their bitmaps gives it.  Users get a number once; a bitmap holds the users of 32,768 numbers, so a day has a row
for each such bucket, however many users there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def number_values(values: DataFrame, path: str, known: DataFrame | None = None) -> DataFrame:
    """``(value, number)`` for each non-NULL value of a one-column frame, written to ``path``.

    Numbers come from the partition and the place in it, without a global sort: each
    partition fills buckets of its own one after the other.  They are fixed by
    being written.  Values of ``known``, an earlier result, keep their numbers, and new ones come after all of them.
    """
    (column,) = values.columns
    new = values.select(F.col(column).alias("value")).where("value is not null").distinct()
    first = 0
    if known is not None:
        new = new.join(known, "value", "left_anti")
        first = (known.agg(F.max("number")).first()[0] or 0) + 1
    numbered = new.withColumn("number", F.monotonically_increasing_id() + first)
    numbered.write.parquet(path)
    written = values.sparkSession.read.schema(numbered.schema).parquet(path)
    return written if known is None else known.unionByName(written)


def reach(rows: DataFrame, numbers: DataFrame, column: str, keys: list[str | Column]) -> DataFrame:
    """Bitmaps of the distinct values of ``column``, a row per key and bucket of numbers."""
    named = rows.withColumnRenamed(column, "value").join(numbers, "value")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    members = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("members")
    return named.groupBy(*keys, bucket).agg(members)


def merged(bitmaps: DataFrame, keys: list[str | Column]) -> DataFrame:
    """The union of bitmaps over coarser keys, in the same form."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def reached(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """How many distinct values each key has."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("members")).alias("users"))
