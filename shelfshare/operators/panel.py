"""The daily panel of sales and stock."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_sales(sales: DataFrame, keys: tuple[str, ...] = ("sku", "store", "day")) -> DataFrame:
    return sales.groupBy(*keys).agg(F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue"))


def dense_panel(daily: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """A row for every day from start to end and every key seen, 0 where nothing sold; `sold` is 1 on days with sales.

    The days are a generated array of each key, so the grid needs no cross join and each key's days come up where the key is.
    """
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day")))
    grid = daily.select(*keys).distinct().select(*keys, days.alias("day"))
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return grid.join(daily, [*keys, "day"], "left").select(*keys, "day", zero("qty"), zero("revenue"), F.col("qty").isNotNull().cast("int").alias("sold"))


def rolling_days(df: DataFrame, values: list[str], keys: tuple[str, ...] = ("sku", "store"), days: int = 90, in_stock: str = "on_hand >= 1") -> DataFrame:
    """Means over the last `days` days, of the days in stock alone; all share one sort."""
    w = Window.partitionBy(*keys).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return df.withColumns({f"mean_{v}": F.avg(F.when(F.expr(in_stock), F.col(v))).over(w) for v in values})


def stockout_block(df: DataFrame) -> DataFrame:
    """Stock-out flag, missing quantity, mean price and lost revenue, from the rolling means and the stock on hand."""
    flag = F.coalesce((F.col("mean_qty") > F.col("on_hand")) & (F.col("mandatory") == "S"), F.lit(False))
    out = df.withColumns({"stockout": flag.cast("int"), "delta": F.when(flag, F.col("mean_qty") - F.col("on_hand")), "mean_price": F.try_divide("mean_revenue", "mean_qty")})
    return out.withColumn("lost_revenue", F.when(F.col("mandatory") == "S", F.col("delta") * F.col("mean_price")).otherwise(0.0))


def coverage(df: DataFrame, start: str, end: str, least: float = 0.8) -> DataFrame:
    """Weekdays of a period, those with rows, their share, and whether it is enough; one row."""
    weekday = lambda c: ~F.dayofweek(c).isin(1, 7)
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("day")).where(weekday("day"))
    seen = df.where(F.col("day").between(start, end)).select("day").distinct().withColumn("seen", F.lit(1))
    total = days.join(seen, "day", "left").agg(F.count("*").alias("weekdays"), F.count("seen").alias("present"))
    share = F.coalesce(F.try_divide(F.col("present"), F.col("weekdays")), F.lit(0.0))
    return total.withColumn("share", share).withColumn("loaded", (share >= least).cast("int"))


def batches(start_month: int, end_month: int, size: int = 3) -> list[tuple[int, int]]:
    """Pairs of first and last month (yyyymm) of batches of whole months."""
    first, last = start_month // 100 * 12 + start_month % 100 - 1, end_month // 100 * 12 + end_month % 100 - 1
    name = lambda m: m // 12 * 100 + m % 12 + 1
    return [(name(m), name(min(m + size - 1, last))) for m in range(first, last + 1, size)]


def backfill(sales: DataFrame, first_month: int, last_month: int, write: Callable[[DataFrame, str, str], object], size: int = 3, days: int = 90) -> list[tuple[int, int]]:
    """Computes the panel batch after batch of whole months and hands each to write, with its first and last day, to replace
    that period; a batch that is done again gives the same. Each batch reads its own days and those its means look back on."""
    done = batches(first_month, last_month, size)
    for first, last in done:
        end = datetime.date(last // 100 + last % 100 // 12, last % 100 % 12 + 1, 1) - datetime.timedelta(1)
        write(period_panel(sales, first, last, days), f"{first // 100:04d}-{first % 100:02d}-01", end.isoformat())
    return done


def period_panel(sales: DataFrame, first_month: int, last_month: int, days: int = 90) -> DataFrame:
    """The panel of whole months, with means that look back over the days before them; only the months are returned."""
    day = lambda m: f"{m // 100:04d}-{m % 100:02d}-01"
    start, end = F.lit(day(first_month)).cast("date"), F.add_months(F.lit(day(last_month)).cast("date"), 1)
    reach = sales.where((F.col("day") >= F.date_sub(start, days - 1)) & (F.col("day") < end))
    daily = reach.groupBy("sku", "store", "day", "mandatory", "on_hand").agg(F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue"))
    return stockout_block(rolling_days(daily, ["qty", "revenue"], days=days)).where(F.col("day") >= start).withColumn("year_month", F.date_format("day", "yyyyMM").cast("int"))
