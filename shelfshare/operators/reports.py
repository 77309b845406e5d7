"""Revenue, concentration, elasticity and stock reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share_of_total, with_share
from . import bitmaps
from .lineage import running_total
from .selection import exact_quantile


def with_total_share(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Share of the grand total in percent; the total is an aggregate joined as one row, not a window over all rows."""
    return df.crossJoin(F.broadcast(df.agg(F.sum(value).alias("all_")))).withColumn(name, 100 * F.try_divide(value, "all_")).drop("all_")


def running_share(df: DataFrame, key: str, value: str, most: float | None = 80.0) -> DataFrame:
    """key, value, share and running share from the largest down, ties by key; only rows up to `most` percent.

    The running sum runs over one row per key, range by range.
    """
    per = with_total_share(df.groupBy(key).agg(F.sum(value).alias(value)), value)
    out = running_total(per, [F.desc(value), F.asc(key)], F.col("share_pct"), "running_pct")
    return out if most is None else out.where(F.col("running_pct") <= most)


def top_items(df: DataFrame, top_keys: DataFrame, key: str, item: str) -> DataFrame:
    """The items of the chosen keys."""
    return df.join(top_keys.select(key), key, "left_semi").select(key, item).distinct()


def revenue_by(df: DataFrame, key: str) -> DataFrame:
    """Revenue per key, its share, and revenue per sku and store."""
    per = df.groupBy(key).agg(F.sum("revenue").alias("revenue"), F.sum("qty").alias("qty"))
    for column, name in (("sku", "skus"), ("store", "stores")):  # each a bitmap, so no row is multiplied
        found = bitmaps.counts(bitmaps.daily(df, [key], column), [key], name).withColumnRenamed(key, "key_")
        per = per.join(found, per[key].eqNullSafe(found["key_"]), "left").drop("key_").fillna(0, [name])
    return with_total_share(per, "revenue").withColumns({"per_sku": F.try_divide("revenue", "skus"), "per_store": F.try_divide("revenue", "stores")})


def top_per(df: DataFrame, outer: str, inner: str, value: str, most: int = 5) -> DataFrame:
    """The inner keys of rank up to `most` in each outer one; ties share a rank."""
    per = df.groupBy(outer, inner).agg(F.sum(value).alias(value))
    return per.withColumn("rank", F.rank().over(Window.partitionBy(outer).orderBy(F.desc(value)))).where(F.col("rank") <= most)


def series_stats(df: DataFrame, series: list[str], value: str) -> DataFrame:
    """Each row with its series' mean, deviation, least, most, count, and flags beyond 1, 2 and 3 deviations on both sides."""
    w = Window.partitionBy(*series)
    out = df.withColumns({"mean": F.avg(value).over(w), "deviation": F.stddev_samp(value).over(w), "least": F.min(value).over(w), "most": F.max(value).over(w), "n": F.count(value).over(w)})
    flag = lambda k, up: F.coalesce(((F.col(value) > F.col("mean") + k * F.col("deviation")) if up else (F.col(value) < F.col("mean") - k * F.col("deviation"))).cast("int"), F.lit(0))
    return out.withColumns({f"{'above' if up else 'below'}_{k}": flag(k, up) for k in (1, 2, 3) for up in (True, False)})


def month_pivot(df: DataFrame, row: str, months: list[int] | None, value: str, percent: bool = True) -> DataFrame:
    """Rows by month: each month's part of its total in percent, or its value. Without a list, the months there are."""
    per = df.groupBy(row, "year_month").agg(F.sum(value).alias("v"))
    part = with_share(per, {"v": "v"}, ["year_month"], 100) if percent else per
    wide = part.groupBy(row).pivot("year_month", months).agg(F.max("v"))
    return wide.withColumnsRenamed({c: f"m{c}" for c in wide.columns if c != row}).fillna(0.0)


def month_rows(df: DataFrame, row: str, value: str, by: list[str] | None = None) -> DataFrame:
    """by, row, year_month, value and its part in percent of the month's total within by; 0 for each month found there in which a row has none."""
    by = by or []
    per = df.groupBy(*by, row, "year_month").agg(F.sum(value).alias(value))
    at = df.groupBy(*by).agg(F.collect_set(row).alias("rows_"), F.collect_set("year_month").alias("months_"))  # no more months than the calendar has
    grid = at.select(*by, F.explode("rows_").alias(row), "months_").select(*by, row, F.explode("months_").alias("year_month"))
    dense = grid.join(per, [*by, row, "year_month"], "left").fillna(0.0, [value])
    return with_share(dense, {"pct": value}, [*by, "year_month"], 100)


def moving_mean(df: DataFrame, keys: list[str], value: str, rows: int = 3) -> DataFrame:
    return df.withColumn("moving", F.avg(value).over(Window.partitionBy(*keys).orderBy("day").rowsBetween(1 - rows, 0)))


def dc_store_daily(df: DataFrame) -> DataFrame:
    """Shops and centres per day: sales, stock, lost percent and median cover side by side, with a 3-day mean of sales."""
    side = lambda is_dc, n: df.where(F.col("is_dc") == F.lit(is_dc)).groupBy("day").agg(F.sum("qty").alias(f"{n}_qty"), F.sum("on_hand").alias(f"{n}_stock"), (100 * F.try_divide(F.sum("lost_revenue"), F.sum("revenue"))).alias(f"{n}_lost_pct"))
    cover = exact_quantile(df, ["day", "is_dc"], "cover", "cover").groupBy("day").agg(F.max(F.when(~F.col("is_dc"), F.col("cover"))).alias("store_cover"), F.max(F.when(F.col("is_dc"), F.col("cover"))).alias("dc_cover"))
    both = side(False, "store").join(side(True, "dc"), "day", "full_outer").join(cover, "day", "left").withColumn("all_", F.lit(1))
    return moving_mean(both, ["all_"], "store_qty").withColumnRenamed("moving", "store_qty_mean3").drop("all_")


def share_by(df: DataFrame, within: str, keys: list[str], new: str, old: str) -> DataFrame:
    """Shares summed per key within a group, renormalised, with the change in points and percent."""
    s = df.groupBy(within, *keys).agg(F.sum(new).alias(new), F.sum(old).alias(old))
    out = s.select(within, *keys, share_of_total(F.col(new), within).alias(new), share_of_total(F.col(old), within).alias(old))
    return out.withColumns({"delta": F.col(new) - F.col(old), "delta_pct": 100 * F.try_divide(F.col(new) - F.col(old), F.col(old))})
