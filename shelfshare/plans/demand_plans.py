"""Queries on demand, cleaning and shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import need_group, normalised_id, store_code
from ..operators import cleaning, demand, panel, shares, sparse
from ..operators.lineage import scratch, stored
from ..operators.product import Factored
from . import base as b
from .base import query


def _daily(spark, d):
    return b.dealt_sales(spark, d, "sku", "store").groupBy("sku", "store", "day", "mandatory", "on_hand").agg(F.sum("qty").alias("qty"), F.sum("revenue").alias("revenue"))


_ROLLED = f"""WITH {b.SALES}, daily AS (SELECT sku, store, day, mandatory, on_hand, sum(qty) AS qty, sum(revenue) AS revenue FROM sales GROUP BY ALL),
rolled AS (SELECT *, avg(CASE WHEN on_hand >= 1 THEN qty END) OVER w AS mean_qty, avg(CASE WHEN on_hand >= 1 THEN revenue END) OVER w AS mean_revenue FROM daily
  WINDOW w AS (PARTITION BY sku, store ORDER BY day RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW))--FROM--"""


@query(_ROLLED + "SELECT sku, store, day, on_hand, mean_qty, mean_revenue FROM rolled", "mean_qty mean_revenue")
def rolling_mean_days(spark, d):
    return panel.rolling_days(_daily(spark, d), ["qty", "revenue"]).select("sku", "store", "day", "on_hand", "mean_qty", "mean_revenue")


@query(_ROLLED + """SELECT sku, store, day, CASE WHEN mean_qty > on_hand AND mandatory = 'S' THEN 1 ELSE 0 END AS stockout, CASE WHEN mean_qty > on_hand AND mandatory = 'S' THEN mean_qty - on_hand END AS delta,
  mean_revenue / nullif(mean_qty, 0) AS mean_price, CASE WHEN mandatory = 'S' THEN CASE WHEN mean_qty > on_hand THEN mean_qty - on_hand END * (mean_revenue / nullif(mean_qty, 0)) ELSE 0.0 END AS lost_revenue FROM rolled""", "delta mean_price lost_revenue")
def stockout_block(spark, d):
    rolled = panel.rolling_days(_daily(spark, d), ["qty", "revenue"])
    return panel.stockout_block(rolled).select("sku", "store", "day", "stockout", "delta", "mean_price", "lost_revenue")


@query(f"WITH {b.DEMANDED}--FROM--SELECT grp, store, day, qty, suppressed, demand FROM demanded", "qty suppressed demand")
def robust_demand(spark, d):
    return b.demanded(spark, d).select("grp", "store", "day", "qty", "suppressed", "demand")


@query(f"WITH {b.CLEANED}--FROM--SELECT grp, year_month, total, n_rows, mean, deviation FROM atypical", "mean deviation")
def atypical_months(spark, d):
    return cleaning.atypical_months(b.panel(spark, d)).select("grp", "year_month", "total", "n_rows", "mean", "deviation")


@query(f"WITH {b.CLEANED}--FROM--SELECT grp, store, day, year_month, qty FROM kept")
def filter_atypical_months(spark, d):
    p = b.panel(spark, d)
    return cleaning.filter_atypical_months(p, cleaning.atypical_months(p), b.MONTH).select("grp", "store", "day", "year_month", "qty")


@query(f"WITH {b.CLEANED}--FROM--SELECT grp, store, day, qty_raw, qty, clipped FROM cleaned", "qty")
def winsorise_series(spark, d):
    return b.cleaned(spark, d).select("grp", "store", "day", "qty_raw", "qty", "clipped")


@query(f"WITH {b.MEASURED_ALL}--FROM--SELECT grp, store, day, trimmed_90, trimmed_180, trimmed_270, trimmed_360 FROM measured", "trimmed_90 trimmed_180 trimmed_270 trimmed_360")
def rolling_trimmed_mean(spark, d):
    return b.measured(spark, d, b.WINDOWS).select("grp", "store", "day", *[f"trimmed_{n}" for n in b.WINDOWS])


@query(f"WITH {b.PANEL}--FROM--SELECT grp, store, day, " + ", ".join(f"avg(qty) OVER (PARTITION BY grp, store ORDER BY day ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS mean_{n}" for n in (30, 60, 90, 180, 360)) + " FROM panel", " ".join(f"mean_{n}" for n in (30, 60, 90, 180, 360)))
def rolling_mean_rows(spark, d):
    windows = (30, 60, 90, 180, 360)
    return demand.rolling_mean_rows(b.panel(spark, d), windows, "qty").select("grp", "store", "day", *[f"mean_{n}" for n in windows])


@query(f"WITH {b.PANEL}--FROM--SELECT grp, store, day, coalesce(qty, 0.0) AS qty, coalesce(delta, 0.0) AS delta FROM panel")
def measure_consolidation(spark, d):
    return demand.measures(b.panel(spark, d), ["grp", "store", "day"], ["qty", "delta"])


@query(f"WITH {b.PANEL}--FROM--SELECT grp, store, day, coalesce(delta, avg(delta) OVER (PARTITION BY grp, store ORDER BY day ROWS BETWEEN 360 PRECEDING AND CURRENT ROW), 0.0) AS delta FROM panel", "delta")
def integrity_backfill(spark, d):
    return demand.backfill(b.panel(spark, d), ["delta"]).select("grp", "store", "day", "delta")


_DENSE = f"""WITH {b.SALES}, daily AS (SELECT grp, store, day, sum(qty) AS qty, sum(revenue) AS revenue FROM sales WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS day)--FROM--SELECT k.grp, k.store, days.day, coalesce(qty, 0.0) AS qty, coalesce(revenue, 0.0) AS revenue, CASE WHEN qty IS NULL THEN 0 ELSE 1 END AS sold
FROM (SELECT DISTINCT grp, store FROM daily) k CROSS JOIN days LEFT JOIN daily USING (grp, store, day)"""


@query(_DENSE, "revenue")
def dense_sales_panel(spark, d):
    year = b.sales(spark, d).where("day between '1998-01-01' and '1998-12-31'")
    return panel.dense_panel(panel.daily_sales(year, ("grp", "store", "day")), ["grp", "store"], "1998-01-01", "1998-12-31")


def _sparse_year(spark, d):
    year = b.sales(spark, d).where("day between '1998-01-01' and '1998-12-31'")
    return sparse.runs(panel.daily_sales(year, ("grp", "store", "day")), ["grp", "store"], ["qty", "revenue"], "1998-12-31")


@query(_DENSE, "revenue")
def dense_from_runs(spark, d):
    """The dense panel spread out from its runs, which have a row per day with sales."""
    return sparse.dense(_sparse_year(spark, d), ["grp", "store"], ["qty", "revenue"], "1998-01-01").withColumn("sold", F.col("sold").cast("int"))


@query(_DENSE.replace("--FROM--", ", dense AS (") + """), rolled AS (SELECT *, avg(qty) OVER w AS mean_qty, avg(revenue) OVER w AS mean_revenue, avg(sold) OVER w AS coverage FROM dense WINDOW w AS (PARTITION BY grp, store ORDER BY day ROWS BETWEEN 89 PRECEDING AND CURRENT ROW))--FROM--
SELECT grp, store, day, mean_qty, mean_revenue, coverage FROM rolled WHERE day = last_day(day)""", "mean_qty mean_revenue coverage")
def dense_means_from_runs(spark, d):
    """Means over the last 90 days at each month's end, zero days included, without the dense panel."""
    runs, keys = stored(_sparse_year(spark, d), "runs"), ["grp", "store"]
    months = F.explode(F.sequence(F.lit("1998-01-01").cast("date"), F.lit("1998-12-01").cast("date"), F.expr("interval 1 month")))
    asked = runs.select(*keys).distinct().select(*keys, months.alias("month")).select(*keys, F.last_day("month").alias("day"))
    return sparse.over_last_days(runs, asked, keys, ["qty", "revenue"], 90, "1998-01-01")


@query(f"""WITH {b.SALES}, days AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-03-31', INTERVAL 1 DAY)) AS DATE) AS day), seen AS (SELECT DISTINCT day AS day, 1 AS seen FROM sales),
t AS (SELECT count(*) AS weekdays, count(seen) AS present FROM days LEFT JOIN seen USING (day) WHERE isodow(day) < 6)--FROM--SELECT weekdays, present, present / weekdays AS share, CASE WHEN present / weekdays >= 0.8 THEN 1 ELSE 0 END AS loaded FROM t""", "share")
def coverage_check(spark, d):
    return panel.coverage(b.sales(spark, d), "1998-01-01", "1998-03-31")


@query(f"WITH {b.CENTRES}--FROM--SELECT store, dc FROM centres")
def dc_map(spark, d):
    return b.centre_map(spark, d)


@query(f"WITH {b.LAST}--FROM--SELECT grp, dc, dc_total, dc_share FROM dcs", "dc_total dc_share")
def dc_share(spark, d):
    return shares.dc_share(b.last_measures(spark, d), b.centre_map(spark, d), "trimmed_90")


_INNER = ", ".join(f"coalesce(trimmed_{n} / nullif(sum(trimmed_{n}) OVER (PARTITION BY grp, dc), 0), 0.0) AS inner_trimmed_{n}" for n in b.WINDOWS)


@query(f"WITH {b.LAST_ALL}--FROM--SELECT grp, dc, store, {_INNER} FROM last JOIN centres USING (store)", " ".join(f"inner_trimmed_{n}" for n in b.WINDOWS))
def inner_share(spark, d):
    return shares.inner_share(b.last_measures(spark, d, b.WINDOWS), b.centre_map(spark, d), [f"trimmed_{n}" for n in b.WINDOWS])


def final_shares(spark, d, windows=(90,)):
    last, centres, names = b.last_measures(spark, d, windows), b.centre_map(spark, d), [f"trimmed_{n}" for n in windows]
    return shares.layered_share(last, centres, "trimmed_90", names)


_FINAL = ", ".join(f"dc_share * inner_trimmed_{n} AS share_trimmed_{n}" for n in b.WINDOWS)
_SHARES = f"WITH {b.LAST_ALL}, inner_shares AS (SELECT grp, dc, store, {_INNER} FROM last JOIN centres USING (store)), finals AS (SELECT grp, dc, store, {_FINAL} FROM inner_shares JOIN dcs USING (grp, dc))"


@query(_SHARES + "--FROM--SELECT grp, dc, store, share_trimmed_90 FROM finals", "share_trimmed_90")
def final_share(spark, d):
    return final_shares(spark, d)


def _skus(spark, d):
    """Mandatory skus with their group, as of the newest day."""
    return b.read(spark, d, "part").where("p_size % 2 = 0").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp"))


@query("SELECT CAST(s_suppkey AS BIGINT) AS store, p_partkey AS sku, p_type AS grp FROM supplier CROSS JOIN part WHERE p_size % 2 = 0")
def skeleton_matrix(spark, d):
    return shares.skeleton(b.stores(spark, d), _skus(spark, d))


@query(_SHARES + "--FROM--SELECT s.store, s.sku, s.grp, " + ", ".join(f"coalesce(share_trimmed_{n}, 0.0) AS share_trimmed_{n}" for n in b.WINDOWS) + " FROM (SELECT s_suppkey AS store, p_partkey AS sku, p_type AS grp FROM supplier CROSS JOIN part WHERE p_size % 2 = 0 AND p_brand = 'Brand#11') s LEFT JOIN finals f ON f.grp = s.grp AND f.store = s.store", " ".join(f"share_trimmed_{n}" for n in b.WINDOWS))
def matrix_for_category(spark, d):
    skus = b.read(spark, d, "part").where("p_size % 2 = 0 and p_brand = 'Brand#11'").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp"))
    names = [f"share_trimmed_{n}" for n in b.WINDOWS]
    return shares.fill_factors(b.stores(spark, d), skus, final_shares(spark, d, b.WINDOWS), names).expand().select("store", "sku", "grp", *names)


_SHARE_NAMES = [f"share_trimmed_{n}" for n in b.WINDOWS]
_EXPANDED = _SHARES + ", full_matrix AS (SELECT s.category, s.store, s.sku, s.grp, " + ", ".join(f"coalesce({n}, 0.0) AS {n}" for n in _SHARE_NAMES) + " FROM (SELECT p_brand AS category, s_suppkey AS store, p_partkey AS sku, p_type AS grp FROM supplier CROSS JOIN part WHERE p_size % 2 = 0) s LEFT JOIN finals f ON f.grp = s.grp AND f.store = s.store)--FROM--"


@query(_SHARES + "--FROM--SELECT s.category, s.store, s.sku, s.grp, " + ", ".join(f"coalesce(share_trimmed_{n}, 0.0) AS share_trimmed_{n}" for n in b.WINDOWS) + " FROM (SELECT p_brand AS category, s_suppkey AS store, p_partkey AS sku, p_type AS grp FROM supplier CROSS JOIN part WHERE p_size % 2 = 0) s LEFT JOIN finals f ON f.grp = s.grp AND f.store = s.store", " ".join(f"share_trimmed_{n}" for n in b.WINDOWS))
def matrix_full(spark, d):
    """The filled matrix of every category; matrix_for_category has one."""
    return _matrix_factors(spark, d).expand().select("category", "store", "sku", "grp", *_SHARE_NAMES)


def _matrix_factors(spark, d):
    """The matrix of every category as a table of each group's shares and one of its skus, written and read back."""
    skus = b.read(spark, d, "part").where("p_size % 2 = 0").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp"), F.col("p_brand").alias("category"))
    path = scratch(spark, "matrix")
    shares.fill_factors(b.stores(spark, d), skus, final_shares(spark, d, b.WINDOWS), _SHARE_NAMES).write(path)
    return Factored.read(spark, path)


@query(_EXPANDED + "SELECT sku, category, grp, " + ", ".join(f"sum({n}) AS {n}" for n in _SHARE_NAMES) + ", count(*) AS parts FROM full_matrix GROUP BY sku, category, grp", " ".join(_SHARE_NAMES))
def matrix_member_totals(spark, d):
    """The sums per sku, from the factors alone."""
    return _matrix_factors(spark, d).member_totals(_SHARE_NAMES)


@query(_EXPANDED + "SELECT store, " + ", ".join(f"sum({n}) AS {n}" for n in _SHARE_NAMES) + " FROM full_matrix GROUP BY store", " ".join(_SHARE_NAMES))
def matrix_store_totals(spark, d):
    return _matrix_factors(spark, d).part_totals(_SHARE_NAMES)


@query(_EXPANDED + "SELECT store, round(sum(share_trimmed_90), 9) AS share_trimmed_90 FROM full_matrix GROUP BY store ORDER BY 2 DESC, store LIMIT 25", "share_trimmed_90")
def matrix_top_stores(spark, d):
    factors = _matrix_factors(spark, d)
    rounded = factors.part_totals(["share_trimmed_90"]).withColumn("share_trimmed_90", F.round("share_trimmed_90", 9))
    return rounded.orderBy(F.desc("share_trimmed_90"), "store").limit(25)


@query(_EXPANDED + "SELECT sku, sum(share_trimmed_360) AS share_trimmed_360 FROM full_matrix WHERE store % 17 <> 0 OR grp IN ('PROMO', 'SMALL') GROUP BY sku HAVING abs(sum(share_trimmed_360) - 1) > 0.01", "share_trimmed_360")
def matrix_off_whole(spark, d):
    """The skus whose shares over all stores aren't 1, after some groups have lost stores."""
    whole = _matrix_factors(spark, d)
    return Factored(whole.parts.where("store % 17 <> 0 OR grp IN ('PROMO', 'SMALL')"), whole.members).off_whole("share_trimmed_360").select("sku", "share_trimmed_360")


@query(_EXPANDED + "SELECT category, CAST(store AS VARCHAR) AS store, CAST(sku AS VARCHAR) AS sku, grp, CAST(share_trimmed_90 AS DOUBLE) AS share_trimmed_90 FROM full_matrix", "share_trimmed_90")
def matrix_export(spark, d):
    """The files of the expanded matrix, each of a bounded number of rows, read back."""
    path = scratch(spark, "matrix-export")
    _matrix_factors(spark, d).export(path, 200_000, "gzip")
    return spark.read.csv(path, sep=";", header=True).select("category", "store", "sku", "grp", F.col("share_trimmed_90").cast("double"))


@query("SELECT p_partkey AS sku, p_type || '_' || substr(p_name, 1, 3) AS grp FROM part")
def need_group_rule(spark, d):
    return b.read(spark, d, "part").select(F.col("p_partkey").alias("sku"), need_group("p_type", "p_name").alias("grp"))


@query("SELECT o_orderkey, coalesce(nullif(ltrim(trim(raw), '0'), ''), '0') AS id FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' 00' || CAST(o_orderkey AS VARCHAR) || ' ' WHEN o_orderkey % 3 = 1 THEN '0' || CAST(o_orderkey AS VARCHAR) || 'x0' WHEN o_orderkey % 7 = 2 THEN '000' ELSE CAST(o_orderkey AS VARCHAR) END AS raw FROM orders)")
def normalise_ids(spark, d):
    text = "CASE WHEN o_orderkey % 3 = 0 THEN concat(' 00', o_orderkey, ' ') WHEN o_orderkey % 3 = 1 THEN concat('0', o_orderkey, 'x0') WHEN o_orderkey % 7 = 2 THEN '000' ELSE CAST(o_orderkey AS STRING) END"
    raw = b.read(spark, d, "orders").select("o_orderkey", F.expr(text).alias("raw"))
    return raw.select("o_orderkey", normalised_id("raw").alias("id"))


@query(f"WITH {b.MATRIX}--FROM--SELECT grp, CASE WHEN store = 9 THEN 4 ELSE store END AS store, sum(real_qty) AS real_qty FROM matrix GROUP BY ALL")
def store_merge(spark, d):
    return cleaning.merge_store(b.matrix(spark, d), 9, 4, ["grp", "store"], "real_qty")


@query("SELECT s_suppkey AS store, CASE WHEN s_suppkey % 10 = 0 THEN '0099_' ELSE '0021_' END || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS code FROM supplier")
def store_code_rule(spark, d):
    s = b.read(spark, d, "supplier").select(F.col("s_suppkey").alias("store"))
    return s.withColumn("code", store_code(F.col("store"), F.col("store") % 10 == 0))


@query(f"""WITH {b.PANEL}, mirror(reference, mirrored) AS (VALUES (1, 2), (1, 3), (4, 6))--FROM--SELECT grp, store, day, qty FROM panel WHERE store NOT IN (SELECT mirrored FROM mirror)
UNION ALL SELECT grp, mirrored AS store, day, qty FROM panel JOIN mirror ON store = reference""")
def mirror_stores(spark, d):
    mirror = spark.createDataFrame([(1, 2), (1, 3), (4, 6)], "reference long, mirrored long")
    return cleaning.mirror_stores(b.panel(spark, d), mirror).select("grp", "store", "day", "qty")


@query(f"""WITH {b.MATRIX}, t AS (SELECT *, CASE dc WHEN 14 THEN 1 WHEN 22 THEN 2 WHEN 24 THEN 0 ELSE dc END AS target FROM matrix)--FROM--SELECT CAST(target AS INTEGER) AS dc, grp, sum(real_qty) AS real_qty, avg(new) AS new, coalesce(max(CASE WHEN dc = target THEN region END), max(region)) AS region FROM t WHERE target <> 0 GROUP BY target, grp""", "new")
def dc_consolidation(spark, d):
    return cleaning.consolidate_dcs(b.matrix(spark, d), {14: 1, 22: 2, 24: 0}, ["grp"], ["real_qty"], ["new"], ["region"]).withColumn("dc", F.col("dc").cast("int"))
