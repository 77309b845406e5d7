"""Robust demand and its rolling measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sliding import Band, Trimmed, along_series


def robust_demand(df: DataFrame, cap: float = 0.30, outlet: Column | None = None) -> DataFrame:
    """demand = qty + suppressed, where suppressed is delta, at most cap of qty; an outlet's demand is 0; null falls back to qty, then 0."""
    out = df.withColumn("suppressed", F.when(F.col("delta").isNotNull(), F.least(F.col("delta"), cap * F.col("qty"))))
    demand = F.coalesce(F.col("qty") + F.col("suppressed"), F.col("qty"), F.lit(0.0))
    return out.withColumn("demand", demand if outlet is None else F.when(outlet, 0.0).otherwise(demand))


def rolling_trimmed_mean(df: DataFrame, windows: tuple[int, ...] = (90, 180, 270, 360), value: str = "demand", keys: tuple[str, ...] = ("grp", "store"), order: str = "day", alpha: float = 0.01, least: int = 10) -> DataFrame:
    """A mean without the extremes for each window of n rows before a row, and the row: `trimmed_<n>`.

    A row counts if it lies within its own rolling alpha and 1-alpha quantiles. With fewer than `least` rows it is the plain
    mean; where nothing counts, the plain mean, then that of the longest window, then 0. Null values don't count. All windows
    slide along one shuffled and sorted pass over the series (sliding.along_series).
    """
    rows = tuple(n + 1 for n in windows)
    return along_series(df, list(keys), order, value, [f"trimmed_{n}" for n in windows], lambda: Trimmed(rows, alpha, 1 - alpha, least))


def rolling_mean_rows(df: DataFrame, windows: tuple[int, ...], value: str, keys: tuple[str, ...] = ("grp", "store"), order: str = "day") -> DataFrame:
    return df.withColumns({f"mean_{n}": F.avg(value).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, 0)) for n in windows})


def measures(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The keys and the measures, null as 0."""
    return df.select(*keys, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])


def backfill(df: DataFrame, names: list[str], keys: tuple[str, ...] = ("grp", "store"), order: str = "day", rows: int = 360) -> DataFrame:
    """Null measures become the mean of their own last rows, then 0."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-rows, 0)
    return df.withColumns({n: F.coalesce(F.col(n), F.avg(n).over(w), F.lit(0.0)) for n in names})


def quantile_band(df: DataFrame, value: str, keys: tuple[str, ...], order: str = "day", rows: int = 179, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """The day's value where it lies in the band of its rolling quantiles, else null: `in_band`."""
    return along_series(df, list(keys), order, value, ["in_band"], lambda: Band(rows + 1, low, high))
