"""Revenue, concentration, elasticity and stock reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import share_of_total, smape, with_share
from ..operators import bitmaps, reports
from ..operators.lineage import stored
from . import base as b
from .base import query

_S = f"WITH {b.SALES}--FROM--"


def _running(key, extra=""):
    return f"""SELECT {key}, revenue, share_pct, running_pct FROM (SELECT *, sum(share_pct) OVER (ORDER BY revenue DESC, {key} ROWS UNBOUNDED PRECEDING) AS running_pct FROM (SELECT {key}, sum(revenue) AS revenue, 100 * sum(revenue) / sum(sum(revenue)) OVER () AS share_pct FROM sales{extra} GROUP BY {key})) WHERE running_pct <= 80"""


@query(_S + _running("brand"), "revenue share_pct running_pct", 3)
def running_share(spark, d):
    return reports.running_share(b.sales(spark, d), "brand", "revenue")


@query(_S + f"SELECT DISTINCT s.brand, s.sku FROM sales s WHERE s.brand IN (SELECT brand FROM ({_running('brand')}))")
def top80_species(spark, d):
    s = b.sales(spark, d)
    return reports.top_items(s, reports.running_share(s, "brand", "revenue"), "brand", "sku")


@query(_S + """SELECT *, revenue / skus AS per_sku, revenue / stores AS per_store FROM (SELECT grp, sum(revenue) AS revenue, sum(qty) AS qty, count(DISTINCT sku) AS skus, count(DISTINCT store) AS stores, 100 * sum(revenue) / sum(sum(revenue)) OVER () AS share_pct FROM sales GROUP BY grp)""", "revenue share_pct per_sku per_store", 3)
def revenue_by_group(spark, d):
    return reports.revenue_by(b.sales(spark, d), "grp").select("grp", "revenue", "qty", "skus", "stores", "share_pct", "per_sku", "per_store")


@query(_S + "SELECT grp, year(day) AS year, count(DISTINCT sku) AS skus, count(DISTINCT store) AS stores, count(DISTINCT brand) AS brands FROM sales GROUP BY ALL")
def distinct_by_period(spark, d):
    """Distinct skus, stores and brands per year, from bitmaps that were stored per day."""
    s, keys = b.sales(spark, d), ["grp", "year"]
    names = stored(bitmaps.numbers(s, "brand"), "brand-numbers")
    out = None
    for column, name, codes in (("sku", "skus", None), ("store", "stores", None), ("brand", "brands", names)):
        days = stored(bitmaps.daily(s, ["grp", "day"], column, codes, b.line_count(spark, d)), "bitmaps")
        found = bitmaps.counts(bitmaps.merged(days.withColumn("year", F.year("day").cast("long")), keys), keys, name)
        out = found if out is None else out.join(found, keys)
    return out


@query(_S + "SELECT brand, sum(revenue) AS revenue, 100 * sum(revenue) / sum(sum(revenue)) OVER () AS share_pct FROM sales GROUP BY brand ORDER BY revenue DESC, brand LIMIT 3", "revenue share_pct", 3)
def revenue_by_brand(spark, d):
    per = b.sales(spark, d).groupBy("brand").agg(F.sum("revenue").alias("revenue"))
    return reports.with_total_share(per, "revenue").orderBy(F.desc("revenue"), "brand").limit(3)


@query(_S + "SELECT region, sum(revenue) AS revenue, 100 * sum(revenue) / sum(sum(revenue)) OVER () AS share_pct FROM sales WHERE channel = 'ONLINE' GROUP BY region", "revenue share_pct", 3)
def directorate_share(spark, d):
    per = b.sales(spark, d).where("channel = 'ONLINE'").groupBy("region").agg(F.sum("revenue").alias("revenue"))
    return reports.with_total_share(per, "revenue")


@query(_S + "SELECT region, brand, revenue, CAST(rank AS INTEGER) AS rank FROM (SELECT region, brand, sum(revenue) AS revenue, rank() OVER (PARTITION BY region ORDER BY sum(revenue) DESC) AS rank FROM sales GROUP BY region, brand) WHERE rank <= 5", "revenue", 3)
def top5_per_directorate(spark, d):
    return reports.top_per(b.sales(spark, d), "region", "brand", "revenue")


_MONTHLY = f"WITH {b.SALES}, per AS (SELECT grp, band, year_month, sum(qty) AS qty FROM sales GROUP BY ALL), shared AS (SELECT grp, band, year_month, coalesce(qty / nullif(sum(qty) OVER (PARTITION BY grp, year_month), 0), 0.0) AS share FROM per)"


@query(_MONTHLY + ", st AS (SELECT *, avg(share) OVER w AS mean, stddev_samp(share) OVER w AS deviation, min(share) OVER w AS least, max(share) OVER w AS most, count(share) OVER w AS n FROM shared WINDOW w AS (PARTITION BY grp, band))--FROM--SELECT *, " + ", ".join(f"coalesce(CASE WHEN share > mean + {k} * deviation THEN 1 ELSE 0 END, 0) AS above_{k}, coalesce(CASE WHEN share < mean - {k} * deviation THEN 1 ELSE 0 END, 0) AS below_{k}" for k in (1, 2, 3)) + " FROM st", "share mean deviation least most")
def elasticity_stats(spark, d):
    per = b.sales(spark, d).groupBy("grp", "band", "year_month").agg(F.sum("qty").alias("qty"))
    shared = per.withColumn("share", share_of_total(F.col("qty"), "grp", "year_month")).drop("qty")
    return reports.series_stats(shared, ["grp", "band"], "share")


_MONTHS = [199801, 199802, 199803]


@query(f"WITH {b.SALES}, per AS (SELECT band, year_month, sum(qty) AS v FROM sales WHERE year_month BETWEEN 199801 AND 199803 GROUP BY ALL), p AS (SELECT band, year_month, 100 * v / sum(v) OVER (PARTITION BY year_month) AS pct FROM per)--FROM--SELECT band, " + ", ".join(f"coalesce(max(CASE WHEN year_month = {m} THEN pct END), 0.0) AS m{m}" for m in _MONTHS) + " FROM p GROUP BY band", " ".join(f"m{m}" for m in _MONTHS))
def monthly_pivot_share(spark, d):
    return reports.month_pivot(b.sales(spark, d).where(F.col("year_month").between(199801, 199803)), "band", _MONTHS, "qty")


def _month_sql(by=""):
    k = f"{by}, " if by else ""
    grid = f"SELECT * FROM (SELECT DISTINCT {k}band FROM sales) JOIN (SELECT DISTINCT {k}year_month FROM sales) USING ({by})" if by else "SELECT * FROM (SELECT DISTINCT band FROM sales) CROSS JOIN (SELECT DISTINCT year_month FROM sales)"
    return f"WITH {b.SALES}, grid AS ({grid}), per AS (SELECT {k}band, year_month, sum(qty) AS qty FROM sales GROUP BY ALL), dense AS (SELECT {k}band, year_month, coalesce(qty, 0.0) AS qty FROM grid LEFT JOIN per USING ({k}band, year_month))--FROM--SELECT {k}band, year_month, qty, coalesce(100 * qty / nullif(sum(qty) OVER (PARTITION BY {k}year_month), 0), 0.0) AS pct FROM dense"


@query(_month_sql(), "pct")
def monthly_share_full(spark, d):
    """Every month of sales, as rows; monthly_pivot_share has three months as columns."""
    return reports.month_rows(b.sales(spark, d), "band", "qty")


@query(_month_sql("grp"), "pct")
def monthly_share_by_group(spark, d):
    return reports.month_rows(b.sales(spark, d), "band", "qty", ["grp"])


@query(f"WITH {b.SALES}, per AS (SELECT channel, day, sum(qty) AS qty FROM sales GROUP BY ALL)--FROM--SELECT channel, day, qty, avg(qty) OVER (PARTITION BY channel ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving FROM per", "moving")
def moving_mean_3(spark, d):
    per = b.sales(spark, d).groupBy("channel", "day").agg(F.sum("qty").alias("qty"))
    return reports.moving_mean(per, ["channel"], "qty")


@query(f"""WITH {b.OBSERVED}, side AS (SELECT day, store % 10 = 0 AS is_dc, sum(qty) AS qty, CAST(sum(on_hand) AS BIGINT) AS stock, 100 * sum(lost_revenue) / nullif(sum(revenue), 0) AS lost_pct, median(cover) AS cover FROM observed GROUP BY ALL),
j AS (SELECT day, s.qty AS store_qty, s.stock AS store_stock, s.lost_pct AS store_lost_pct, s.cover AS store_cover, c.qty AS dc_qty, c.stock AS dc_stock, c.lost_pct AS dc_lost_pct, c.cover AS dc_cover FROM (SELECT * FROM side WHERE NOT is_dc) s FULL OUTER JOIN (SELECT * FROM side WHERE is_dc) c USING (day))--FROM--
SELECT *, avg(store_qty) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS store_qty_mean3 FROM j""", "store_lost_pct store_cover dc_lost_pct dc_cover store_qty_mean3")
def dc_store_daily(spark, d):
    return reports.dc_store_daily(b.observed(spark, d).withColumn("is_dc", F.col("store") % 10 == 0))


_R = "coalesce({0} / nullif(sum({0}) OVER (PARTITION BY grp), 0), 0.0) AS {0}"


@query(f"WITH {b.MATRIX}, s AS (SELECT grp, band, region, sum(new) AS new, sum(old) AS old FROM matrix GROUP BY ALL), r AS (SELECT grp, band, region, {_R.format('new')}, {_R.format('old')} FROM s)--FROM--SELECT *, new - old AS delta, 100 * (new - old) / nullif(old, 0) AS delta_pct FROM r", "new old delta delta_pct")
def share_by_band_region(spark, d):
    return reports.share_by(b.matrix(spark, d), "grp", ["band", "region"], "new", "old")


@query(f"WITH {b.SALES}, per AS (SELECT region, grp, brand, sum(qty + CASE WHEN mandatory = 'S' AND on_hand < qty THEN qty - on_hand ELSE 0.0 END) AS demand, sum(revenue) AS revenue FROM sales GROUP BY ALL)--FROM--SELECT region, grp, brand, demand, revenue, 100 * demand / sum(demand) OVER (PARTITION BY region) AS demand_pct, 100 * revenue / sum(revenue) OVER (PARTITION BY region) AS revenue_pct FROM per", "revenue demand_pct revenue_pct", 3)
def unconstrained_participation(spark, d):
    free = F.col("qty") + F.when((F.col("mandatory") == "S") & (F.col("on_hand") < F.col("qty")), F.col("qty") - F.col("on_hand")).otherwise(0.0)
    per = b.sales(spark, d).groupBy("region", "grp", "brand").agg(F.sum(free).alias("demand"), F.sum("revenue").alias("revenue"))
    return with_share(per, {f"{c}_pct": c for c in ("demand", "revenue")}, ["region"], 100)


@query(f"WITH {b.SALES}, per AS (SELECT grp, store, year_month, sum(qty) AS qty, median(qty) AS median_qty FROM sales GROUP BY ALL)--FROM--SELECT *, qty / sum(qty) OVER (PARTITION BY grp, year_month) AS share FROM per", "share")
def monthly_store_share(spark, d):
    per = b.sales(spark, d).groupBy("grp", "store", "year_month").agg(F.sum("qty").alias("qty"), F.median("qty").alias("median_qty"))
    return per.withColumn("share", share_of_total(F.col("qty"), "grp", "year_month"))


@query(_S + "SELECT store, sum(qty) AS qty, 100 * sum(qty) / sum(sum(qty)) OVER () AS share_pct FROM sales WHERE sku IN (1, 2, 3, 5, 8, 13, 21, 34) GROUP BY store", "share_pct")
def sku_list_share(spark, d):
    per = b.sales(spark, d).where(F.col("sku").isin(1, 2, 3, 5, 8, 13, 21, 34)).groupBy("store").agg(F.sum("qty").alias("qty"))
    return reports.with_total_share(per, "qty")


@query("WITH " + b.SALES + "--FROM--SELECT region, grp, sum(qty) AS qty, sum(revenue) AS revenue FROM sales WHERE brand NOT LIKE '%#1%' GROUP BY ALL", "revenue", 3)
def sales_by_twin_group(spark, d):
    return b.sales(spark, d).where(~F.col("brand").contains("#1")).groupBy("region", "grp").agg(F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue"))


@query(_S + "SELECT store, flag, revenue, 100 * revenue / sum(revenue) OVER (PARTITION BY store) AS pct FROM (SELECT store, CASE WHEN qty >= 40 THEN 'ATACADO' ELSE 'VAREJO' END AS flag, sum(revenue) AS revenue FROM sales GROUP BY ALL)", "revenue pct", 3)
def wholesale_share(spark, d):
    per = b.sales(spark, d).withColumn("flag", F.when(F.col("qty") >= 40, "ATACADO").otherwise("VAREJO")).groupBy("store", "flag").agg(F.sum("revenue").alias("revenue"))
    return per.withColumn("pct", 100 * share_of_total(F.col("revenue"), "store"))


def _top_stores(spark, d):
    return b.sales(spark, d).groupBy("store").agg(F.sum("revenue").alias("revenue")).orderBy(F.desc("revenue"), "store").limit(25)


def _offenders(spark, d):
    per = b.observed(spark, d).groupBy("sku").agg(F.avg("cover").alias("cover"), (100 * F.avg("stockout")).alias("stockout_pct")).where("cover > 0")
    return per.withColumn("score", F.round(F.col("cover") + F.col("stockout_pct"), 6)).orderBy(F.desc("score"), "sku").limit(25)


_TOP = "SELECT store, sum(revenue) AS revenue FROM sales GROUP BY store ORDER BY revenue DESC, store LIMIT 25"
_OFF = "SELECT sku, cover, stockout_pct, round(cover + stockout_pct, 6) AS score FROM (SELECT sku, avg(cover) AS cover, 100 * avg(stockout) AS stockout_pct FROM observed GROUP BY sku) WHERE cover > 0 ORDER BY score DESC, sku LIMIT 25"


@query(_S + _TOP, "revenue", 3)
def top_stores(spark, d):
    return _top_stores(spark, d)


@query(f"WITH {b.OBSERVED}--FROM--{_OFF}", "cover stockout_pct score")
def top_offenders(spark, d):
    return _offenders(spark, d)


@query(f"""WITH {b.MATRIX}, {b.OBSERVED.removeprefix(b.SALES + ', ')}, top_s AS ({_TOP}), top_k AS ({_OFF})--FROM--SELECT DISTINCT m.grp, m.store, o.sku, CASE WHEN m.new = 0 AND m.real = 0 THEN 0.0 ELSE 200 * abs(m.new - m.real) / nullif(abs(m.new) + abs(m.real), 0) END AS smape
FROM matrix m JOIN top_s USING (store) JOIN (SELECT DISTINCT sku, grp FROM sales WHERE sku IN (SELECT sku FROM top_k)) o ON o.grp = m.grp""", "smape")
def distorted_pairs(spark, d):
    skus = b.sales(spark, d).join(_offenders(spark, d).select("sku"), "sku", "left_semi").select("sku", "grp").distinct()
    m = b.matrix(spark, d).withColumn("smape", smape(F.col("new"), F.col("real"))).join(_top_stores(spark, d).select("store"), "store")
    return m.join(skus, "grp").select("grp", "store", "sku", "smape").distinct()
