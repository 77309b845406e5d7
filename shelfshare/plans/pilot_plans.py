"""Queries that follow a pilot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import with_share
from ..operators import pilot, reports
from . import base as b
from .base import query

_O = f"WITH {b.OBSERVED}--FROM--"
_KPI = "median(cover) AS median_cover, 100 * avg(stockout) AS stockout_pct, 100 * sum(lost_revenue) / nullif(sum(revenue), 0) AS lost_pct"
_K = "median_cover stockout_pct lost_pct"


@query(_O + f"SELECT period, arm, {_KPI} FROM observed GROUP BY period, arm", _K)
def pilot_kpis(spark, d):
    return pilot.kpis(b.observed(spark, d), ["period", "arm"])


def _did(by=None, source="observed"):
    k = f"{by}, " if by else ""
    cell = lambda n, arm, p: f"max(CASE WHEN arm = '{arm}' AND period = '{p}' THEN {n} END)"
    one = lambda n: f"SELECT {k}'{n}' AS kpi, {cell(n, 'test', 'pilot')} - {cell(n, 'test', 'baseline')} AS test_change, {cell(n, 'control', 'pilot')} - {cell(n, 'control', 'baseline')} AS control_change FROM kp{f' GROUP BY {by}' if by else ''}"
    return f", kp AS (SELECT {k}arm, period, {_KPI} FROM {source} WHERE period IN ('baseline', 'pilot') GROUP BY {k}arm, period)--FROM--SELECT *, test_change - control_change AS did FROM ({' UNION ALL '.join(map(one, _K.split()))})"


_D = "test_change control_change did"


@query(f"WITH {b.OBSERVED}{_did()}", _D)
def did_total(spark, d):
    return pilot.difference_in_differences(b.observed(spark, d))


@query(f"WITH {b.OBSERVED}{_did('region')}", _D)
def did_region(spark, d):
    return pilot.difference_in_differences(b.observed(spark, d), ["region"])


@query(f"WITH {b.OBSERVED}{_did('band')}", _D)
def did_band(spark, d):
    return pilot.difference_in_differences(b.observed(spark, d), ["band"])


def _changes(spark, d):
    return pilot.share_changes(b.matrix(spark, d), "new", "old")


_CLASS = "CASE WHEN (new - old) / nullif(old, 0) IS NULL THEN 'new' WHEN (new - old) / old > 0.2 THEN 'more' WHEN (new - old) / old < -0.2 THEN 'less' ELSE 'same' END"
_BOTH = f"WITH {b.MATRIX}, {b.OBSERVED.removeprefix(b.SALES + ', ')}, changed AS (SELECT grp, store, {_CLASS} AS change_class FROM matrix), joined AS (SELECT o.*, c.change_class FROM observed o JOIN changed c ON c.grp = o.grp AND c.store = o.store)"


def _joined(spark, d):
    return b.observed(spark, d).join(_changes(spark, d).select("grp", "store", "change_class"), ["grp", "store"])


@query(_BOTH + _did("change_class", "joined"), _D)
def did_bucket(spark, d):
    return pilot.difference_in_differences(_joined(spark, d), ["change_class"])


@query(_BOTH + f"--FROM--SELECT change_class, period, {_KPI} FROM joined GROUP BY ALL", _K)
def share_change_bucket(spark, d):
    return pilot.kpis(_joined(spark, d), ["change_class", "period"])


@query(_O + "SELECT band, arm, baseline, pilot, pilot - baseline AS change, 100 * (pilot - baseline) / nullif(baseline, 0) AS change_pct FROM (SELECT band, arm, sum(CASE WHEN period = 'baseline' THEN qty END) AS baseline, sum(CASE WHEN period = 'pilot' THEN qty END) AS pilot FROM observed GROUP BY ALL)", "change_pct")
def pilot_change(spark, d):
    return pilot.before_after(b.observed(spark, d), ["band", "arm"], "qty")


@query(_O + "SELECT store, band, baseline, pilot, pilot - baseline AS change, 100 * (pilot - baseline) / nullif(baseline, 0) AS change_pct FROM (SELECT store, band, median(CASE WHEN period = 'baseline' THEN cover END) AS baseline, median(CASE WHEN period = 'pilot' THEN cover END) AS pilot FROM observed GROUP BY ALL)", "baseline pilot change change_pct")
def stock_days_before_after(spark, d):
    return pilot.before_after(b.observed(spark, d), ["store", "band"], "cover", "median")


_BUCKET = "CASE WHEN cover IS NULL THEN 'none' WHEN cover <= 15 THEN '0-15' WHEN cover <= 30 THEN '15-30' WHEN cover <= 45 THEN '30-45' WHEN cover <= 60 THEN '45-60' ELSE '60+' END"
_CLASSES = ", ".join(f"count(*) FILTER (WHERE bucket = '{c}') AS \"{c}\"" for c in ("0-15", "15-30", "30-45", "45-60", "60+", "none"))


@query(f"WITH {b.OBSERVED}, per AS (SELECT period, store, median(cover) AS cover FROM observed GROUP BY ALL)--FROM--SELECT period, {_CLASSES} FROM (SELECT period, {_BUCKET} AS bucket FROM per) GROUP BY period")
def stock_day_buckets(spark, d):
    return pilot.cover_buckets(b.observed(spark, d))


@query(_O + f"SELECT band, bucket, n, mean_cover, 100.0 * n / sum(n) OVER (PARTITION BY band) AS pct FROM (SELECT band, {_BUCKET} AS bucket, count(*) AS n, avg(cover) AS mean_cover FROM observed GROUP BY ALL)", "mean_cover pct")
def stock_day_bucket_share(spark, d):
    return pilot.cover_share(b.observed(spark, d), "band")


@query(f"WITH {b.MATRIX}--FROM--SELECT band, new, old, real, round(100 * abs(new - real), 4) AS error_new, round(100 * abs(old - real), 4) AS error_old FROM (SELECT band, sum(new) / 6 AS new, sum(old) / 6 AS old, sum(real) / 6 AS real FROM matrix GROUP BY band)", "new old real error_new error_old")
def band_share_error(spark, d):
    return pilot.band_error(b.matrix(spark, d), "band", "new", "old", "real", 6)


@query(f"WITH {b.SALES}, per AS (SELECT region, band, sum(revenue) AS revenue FROM sales GROUP BY ALL)--FROM--SELECT region, band, revenue, 100 * revenue / sum(revenue) OVER () AS share_pct, revenue / sum(revenue) OVER (PARTITION BY region) AS in_region FROM per", "revenue share_pct in_region", 3)
def sales_share_bands(spark, d):
    per = b.sales(spark, d).groupBy("region", "band").agg(F.sum("revenue").alias("revenue"))
    return with_share(reports.with_total_share(per, "revenue"), {"in_region": "revenue"}, ["region"])


_DAYS = ["1999-03-07", "1999-03-08", "1999-03-09"]
_TEXT = "replace(printf('%.2f', round(value, 2)), '.', ',')"


@query(f"""WITH {b.OBSERVED}, per AS (SELECT day, sum(revenue) AS revenue, sum(lost_revenue) AS lost FROM observed WHERE day BETWEEN DATE '1999-03-07' AND DATE '1999-03-09' GROUP BY day),
long AS (SELECT day, 'revenue' AS metric, revenue AS value FROM per UNION ALL SELECT day, 'lost revenue', lost FROM per UNION ALL SELECT day, 'lost pct', CASE WHEN isodow(day) = 7 THEN NULL ELSE 100 * lost / nullif(revenue, 0) END FROM per)--FROM--
SELECT metric, """ + ", ".join(f"max(CASE WHEN day = DATE '{x}' THEN {_TEXT} END) AS \"{x}\"" for x in _DAYS) + " FROM long GROUP BY metric")
def daily_lost_revenue(spark, d):
    return pilot.daily_lost_revenue(b.observed(spark, d).where(pilot.in_days("day", _DAYS[0], _DAYS[-1])), _DAYS)


@query(f"""WITH {b.OBSERVED}, per AS (SELECT day, sum(revenue) AS revenue, sum(lost_revenue) AS lost FROM observed WHERE period IN ('baseline', 'pilot') GROUP BY day),
long AS (SELECT day, 'revenue' AS metric, revenue AS value FROM per UNION ALL SELECT day, 'lost revenue', lost FROM per UNION ALL SELECT day, 'lost pct', CASE WHEN isodow(day) = 7 THEN NULL ELSE 100 * lost / nullif(revenue, 0) END FROM per)--FROM--
SELECT CAST(day AS VARCHAR) AS day, metric, value FROM long""", "value", 2)
def daily_lost_revenue_full(spark, d):
    """Every day of the baseline and the pilot, as rows; daily_lost_revenue has three days as columns."""
    return pilot.daily_lost_revenue_rows(b.observed(spark, d).where(F.col("period").isin("baseline", "pilot")))
