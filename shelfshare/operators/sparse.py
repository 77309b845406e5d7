"""The panel of days without its zeros: a row per day with sales, which stands for the days up to the next one as well.

Each row carries sums of all sales up to its day. What was sold in any span of days is the difference of two of them, looked
up as of the span's ends; so means and coverage over zero days need rows in proportion to sales, not to the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def runs(daily: DataFrame, keys: list[str], values: list[str], end: str) -> DataFrame:
    """keys, day, until, values, upto_<value>, upto_days: of daily sales (one row per key and day) each day with the last day before
    the next one (or `end`), its values, and the sums of the values and of the days so far. Null values count as 0."""
    series = Window.partitionBy(*keys).orderBy("day")
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    rows = daily.select(*keys, "day", *[F.coalesce(v, F.lit(0.0)).alias(v) for v in values])
    until = F.coalesce(F.date_sub(F.lead("day").over(series), 1), F.greatest(F.lit(end).cast("date"), F.col("day")))
    return rows.withColumns({"until": until, **{f"upto_{v}": F.sum(v).over(so_far) for v in values}, "upto_days": F.count("*").over(so_far)})


def dense(sparse: DataFrame, keys: list[str], values: list[str], start: str) -> DataFrame:
    """The panel with a row per day from `start` to where the runs end, for exports that need it: the zero days before a key's first sale too."""
    first = sparse.groupBy(*keys).agg(F.min("day").alias("until")).where(F.col("until") > F.lit(start).cast("date"))
    before = first.select(*keys, F.lit(start).cast("date").alias("day"), F.date_sub("until", 1).alias("until"), *[F.lit(0.0).alias(v) for v in values], F.lit(0).alias("sold"))
    rows = before.unionByName(sparse.select(*keys, "day", "until", *values, F.lit(1).alias("sold")))
    days = rows.withColumn("at", F.explode(F.sequence("day", "until")))
    here = F.col("at") == F.col("day")
    return days.select(*keys, F.col("at").alias("day"), *[F.when(here, F.col(v)).otherwise(0.0).alias(v) for v in values], F.when(here, F.col("sold")).otherwise(0).alias("sold"))


def over_last_days(sparse: DataFrame, asked: DataFrame, keys: list[str], values: list[str], days: int, start: str) -> DataFrame:
    """asked (keys, day) with mean_<value> and coverage over its last `days` days, zero days included: what lies between two
    look-ups of the sums so far. Spans begin at `start` at the earliest. A key without sales has means of 0; an asked row that
    is there twice comes out twice. Runs and look-ups of a key are sorted once, together."""
    names = [f"upto_{v}" for v in values] + ["upto_days"]
    events = sparse.select(*keys, F.col("day").alias("at"), F.lit(0).alias("mark"), *names, F.lit(None).cast("date").alias("day"), F.lit(None).cast("long").alias("times"))
    wanted = asked.groupBy(*keys, "day").agg(F.count("*").alias("times"))
    ends = F.array(F.struct(F.col("day").alias("at"), F.lit(2).alias("mark")), F.struct(F.date_sub("day", days).alias("at"), F.lit(1).alias("mark")))
    marks = wanted.withColumn("end", F.explode(ends)).select(*keys, "end.at", "end.mark", *[F.lit(None).cast(dict(sparse.dtypes)[n]).alias(n) for n in names], "day", "times")
    past = Window.partitionBy(*keys).orderBy("at", "mark").rowsBetween(Window.unboundedPreceding, 0)
    found = events.unionByName(marks).withColumns({n: F.coalesce(F.last(n, ignorenulls=True).over(past), F.lit(0)) for n in names}).where("mark > 0")
    at = lambda n, mark: F.max(F.when(F.col("mark") == mark, F.col(n)))
    span = F.least(F.lit(days), F.date_diff(F.col("day"), F.lit(start).cast("date")) + 1)
    between = found.groupBy(*keys, "day", "times").agg(*[(at(n, 2) - at(n, 1)).alias(n) for n in names])
    out = between.select(*keys, "day", *[F.try_divide(F.col(f"upto_{v}"), span).alias(f"mean_{v}") for v in values], F.try_divide(F.col("upto_days"), span).alias("coverage"), "times")
    return out.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
