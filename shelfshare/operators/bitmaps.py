"""Exact distinct counts from bitmaps of numbered ids: kept per day, merged over any period, and side by side without Expand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import dealt, running_total


def numbers(df: DataFrame, column: str) -> DataFrame:
    """column, code: the distinct values of a column, numbered from 1 in their order, without a gap. Null has no number.

    Numbers are dealt out range by range; store the result, as later bitmaps must use the same numbers.
    """
    return running_total(df.select(column).where(F.col(column).isNotNull()).distinct(), [F.asc(column)], F.lit(1), "code")


def daily(df: DataFrame, keys: list[str], column: str, codes: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """keys, bucket, bits: which ids each key, such as group and day, has. Without codes the column's own whole numbers are used.

    A bitmap has 32,768 ids and takes 4 KB, be they few or many. With few keys tasks make bitmaps before they meet. With keys as
    fine as days that would be a bitmap for every few rows: give `rows`, how many there are at most, and rows meet first, dealt
    out by that. Null ids don't count.
    """
    found = df.select(*keys, column) if codes is None else df.select(*keys, column).join(codes, column).drop(column).withColumnRenamed("code", column)
    known = found.where(F.col(column).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(column))
    known = known if rows is None else dealt(known, rows, *keys, "bucket")
    return known.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"))


def merged(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of fewer keys, from those of more."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, name: how many different ids each key has. Bitmaps of one key and bucket must have been merged."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
