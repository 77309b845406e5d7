"""Cleaning of demand history and of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import small


def atypical_months(df: DataFrame, value: str = "qty", group: str = "grp", month: str = "year_month", sigmas: float = 2.0) -> DataFrame:
    """Months whose total lies outside the group's mean of monthly totals by more than `sigmas` standard deviations.

    The lower bound is at least 0. A group of one month has no deviation and no atypical month.
    """
    monthly = df.groupBy(group, month).agg(F.sum(value).alias("total"), F.count("*").alias("n_rows"))
    months = Window.partitionBy(group)  # a row per month
    monthly = monthly.withColumns({"mean": F.avg("total").over(months), "deviation": F.stddev_samp("total").over(months)})
    low, high = F.greatest(F.col("mean") - sigmas * F.col("deviation"), F.lit(0.0)), F.col("mean") + sigmas * F.col("deviation")
    return monthly.where(F.col("deviation").isNotNull() & ((F.col("total") < low) | (F.col("total") > high)))


def filter_atypical_months(df: DataFrame, months: DataFrame, keep_month: int, group: str = "grp", month: str = "year_month") -> DataFrame:
    """df without the atypical months, but with that of the calculation date."""
    return df.join(months.where(F.col(month) != keep_month).select(group, month), [group, month], "left_anti")


def winsorise(df: DataFrame, value: str = "qty", keys: tuple[str, ...] = ("grp", "store"), k: float = 3.0, k_special: float = 1.5, special: Column | None = None) -> DataFrame:
    """Each series clipped at its mean ± k deviations (k_special where special holds), not below 0; adds `<value>_raw` and `clipped`.

    A series of one row has no deviation and stays.
    """
    w = Window.partitionBy(*keys)
    factor = F.lit(k) if special is None else F.when(special, k_special).otherwise(k)
    mean, deviation = F.avg(value).over(w), F.stddev_samp(value).over(w)
    bounded = df.withColumns({f"{value}_raw": F.col(value), "low_": F.greatest(mean - factor * deviation, F.lit(0.0)), "high_": mean + factor * deviation})
    new = F.when(F.col("high_").isNull(), F.col(value)).otherwise(F.greatest(F.least(F.col(value), "high_"), "low_"))
    return bounded.withColumn(value, new).withColumn("clipped", (F.col(value) != F.col(f"{value}_raw")).cast("int")).drop("low_", "high_")


def mirror_stores(df: DataFrame, mirror: DataFrame, store: str = "store") -> DataFrame:
    """Rows of mirrored stores go, and come again as copies of their reference store's. mirror: reference, mirrored; a counted
    small one is broadcast, so that rows stay where they are."""
    mirror = small(mirror, 16)
    kept = df.join(mirror.select(F.col("mirrored").alias(store)), store, "left_anti")
    copies = df.join(mirror, F.col(store) == F.col("reference")).drop(store, "reference").withColumnRenamed("mirrored", store)
    return kept.unionByName(copies)


def merge_store(df: DataFrame, old: int, new: int, keys: list[str], value: str, store: str = "store") -> DataFrame:
    """One store's rows counted with another's, and summed again per key."""
    return df.withColumn(store, F.when(F.col(store) == old, new).otherwise(F.col(store))).groupBy(*keys).agg(F.sum(value).alias(value))


def consolidate_dcs(df: DataFrame, moved: dict[int, int], keys: list[str], sums: list[str], means: list[str], labels: list[str], dc: str = "dc") -> DataFrame:
    """Distribution centres counted with others (0: dropped): sums, means, and labels of the target where it has one, else any."""
    table = F.create_map(*[F.lit(x) for pair in moved.items() for x in pair])
    target = df.withColumn("target_", F.coalesce(table[F.col(dc)], F.col(dc))).where("target_ <> 0")
    label = lambda c: F.coalesce(F.max(F.when(F.col(dc) == F.col("target_"), F.col(c))), F.max(c)).alias(c)
    return target.groupBy(F.col("target_").alias(dc), *keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means], *map(label, labels))


def filter_products(df: DataFrame, kinds: list[str] | None = None, not_brands: list[str] | None = None, groups: list[str] | None = None, drop_groups: bool = False) -> DataFrame:
    """Delivery kinds to keep, brands to leave out, need groups to keep or to drop; null counts as not listed."""
    out = df
    if kinds is not None:
        out = out.where(F.col("kind").isin(kinds))
    if not_brands:
        out = out.where(~F.coalesce(F.col("brand").isin(not_brands), F.lit(False)))
    if groups is not None:
        listed = F.coalesce(F.col("grp").isin(groups), F.lit(False))
        out = out.where(~listed if drop_groups else listed)
    return out


def one_row_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a full order, so that the choice doesn't depend on partitions."""
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rank_ = 1").drop("rank_")
