"""Following a pilot: KPIs before and after, difference-in-differences, stock-cover classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import change_bucket, comma_number, stock_days_bucket
from .selection import exact_quantile, with_exact_median

KPIS = ("median_cover", "stockout_pct", "lost_pct")


def label_test(df: DataFrame, tested: DataFrame, key: str = "grp") -> DataFrame:
    """`arm`: test where the key is listed, else control."""
    return df.join(tested.select(key).distinct().withColumn("in_", F.lit(1)), key, "left").withColumn("arm", F.when(F.col("in_") == 1, "test").otherwise("control")).drop("in_")


def kpis(df: DataFrame, keys: list[str]) -> DataFrame:
    """Median days of stock, share of stock-out rows in percent, lost revenue in percent of revenue. The median is exact, however
    many rows a group has."""
    sums = df.groupBy(*keys).agg((100 * F.avg("stockout")).alias("stockout_pct"), (100 * F.try_divide(F.sum("lost_revenue"), F.sum("revenue"))).alias("lost_pct"))
    return with_exact_median(sums, df, keys, "cover", "median_cover").select(*keys, *KPIS)


def difference_in_differences(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """kpi, change in test, change in control, their difference; per value of `by`, or in all. df: arm, period, cover, ..."""
    by = by or []
    k = kpis(df.where(F.col("period").isin("baseline", "pilot")), [*by, "arm", "period"])
    cell = lambda n, arm, period: F.max(F.when((F.col("arm") == arm) & (F.col("period") == period), F.col(n)))
    change = lambda n, arm: cell(n, arm, "pilot") - cell(n, arm, "baseline")
    wide = k.groupBy(*by).agg(*[F.struct(change(n, "test").alias("test"), change(n, "control").alias("control")).alias(n) for n in KPIS])
    long = wide.select(*by, F.inline(F.array(*[F.struct(F.lit(n).alias("kpi"), F.col(f"{n}.test").alias("test_change"), F.col(f"{n}.control").alias("control_change")) for n in KPIS])))
    return long.withColumn("did", F.col("test_change") - F.col("control_change"))


def before_after(df: DataFrame, keys: list[str], value: str, how: str = "sum") -> DataFrame:
    """A value in the baseline and in the pilot, the change and the change in percent."""
    if how == "median":  # a row per key, so the two periods' medians can be told apart by max
        per = exact_quantile(df, [*keys, "period"], value, "value_")
        f, value, df = F.max, "value_", per
    else:
        f = {"sum": F.sum, "avg": F.avg}[how]
    part = lambda p: f(F.when(F.col("period") == p, F.col(value))).alias(p)
    return df.groupBy(*keys).agg(part("baseline"), part("pilot")).withColumn("change", F.col("pilot") - F.col("baseline")).withColumn("change_pct", 100 * F.try_divide("change", "baseline"))


def spread_of_medians(df: DataFrame, keys: list[str], value: str = "cover") -> DataFrame:
    """The median per store, then its deviation over the stores, per key."""
    per = exact_quantile(df, [*keys, "store"], value, "median_")
    return per.groupBy(*keys).agg(F.stddev_samp("median_").alias("deviation"), F.count("median_").alias("stores"))


def cover_buckets(df: DataFrame, how: str = "median") -> DataFrame:
    """How many stores have a mean or median cover in each class, per period; classes are columns."""
    keys = ["period", "store"]
    per = exact_quantile(df, keys, "cover", "cover") if how == "median" else df.groupBy(*keys).agg(F.avg("cover").alias("cover"))
    return bucket_counts(per)


def bucket_counts(per: DataFrame) -> DataFrame:
    """Rows (period, cover) in each class of cover, per period; classes are columns."""
    classes = ["0-15", "15-30", "30-45", "45-60", "60+", "none"]
    return per.withColumn("bucket", stock_days_bucket(F.col("cover"))).groupBy("period").pivot("bucket", classes).agg(F.count(F.lit(1))).fillna(0)


def cover_share(df: DataFrame, by: str) -> DataFrame:
    """Per value of by: rows in each class of cover, their share in percent, the class's mean cover."""
    per = df.withColumn("bucket", stock_days_bucket(F.col("cover"))).groupBy(by, "bucket").agg(F.count("*").alias("n"), F.avg("cover").alias("mean_cover"))
    return per.withColumn("pct", 100 * F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def share_changes(df: DataFrame, new: str, old: str, limit: float = 0.2) -> DataFrame:
    """Rows per class of share change against the incumbent."""
    return df.withColumn("change_class", change_bucket(F.col(new), F.col(old), limit))


def band_error(df: DataFrame, band: str, new: str, old: str, real: str, groups: int) -> DataFrame:
    """Share per band, summed over groups and divided by their number, and the error of both matrices in points."""
    s = df.groupBy(band).agg(*[(F.sum(c) / groups).alias(c) for c in (new, old, real)])
    return s.withColumns({f"error_{new}": F.round(100 * F.abs(F.col(new) - F.col(real)), 4), f"error_{old}": F.round(100 * F.abs(F.col(old) - F.col(real)), 4)})


def daily_lost_revenue_rows(df: DataFrame) -> DataFrame:
    """day, metric, value of every day there is: revenue, lost revenue, lost percent (null on Sundays)."""
    per = df.groupBy("day").agg(F.sum("revenue").alias("revenue"), F.sum("lost_revenue").alias("lost"))
    pct = F.when(F.dayofweek("day") == 1, None).otherwise(100 * F.try_divide("lost", "revenue"))
    return per.select(F.col("day").cast("string").alias("day"), F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in (("revenue", F.col("revenue")), ("lost revenue", F.col("lost")), ("lost pct", pct))])))


def daily_lost_revenue(df: DataFrame, days: list[str]) -> DataFrame:
    """The same with the listed days as columns, numbers as text with a decimal comma."""
    return daily_lost_revenue_rows(df).withColumn("value", comma_number(F.col("value"))).groupBy("metric").pivot("day", days).agg(F.max("value"))


def in_days(column: str, start: str, end: str) -> Column:
    return F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
