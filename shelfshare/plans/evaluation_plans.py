"""Queries that hold shares against what sold and against the incumbent."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import band_number, smape
from ..operators import demand, metrics, pilot
from . import base as b
from .base import query

_W = f"WITH {b.MATRIX}--FROM--"


def _smape(a, c):
    return f"CASE WHEN {a} = 0 AND {c} = 0 THEN 0.0 ELSE 200 * abs({a} - {c}) / nullif(abs({a}) + abs({c}), 0) END"


def _wmape(p, r, w="1.0"):
    return f"100 * sum(abs({p} - {r}) * {w}) / nullif(sum(abs({r}) * {w}), 0)"


_METRICS = "wmape smape mae_weighted share_error share_error_weighted cross_entropy divergence"


@query(f"""WITH {b.MATRIX}, pq AS (SELECT region, real AS y, new AS h, coalesce(real / nullif(sum(real) OVER (PARTITION BY region), 0), 0.0) AS p, coalesce(new / nullif(sum(new) OVER (PARTITION BY region), 0), 0.0) AS q FROM matrix)--FROM--SELECT region,
100 * sum(abs(y - h)) / nullif(sum(abs(y)), 0) AS wmape, 200 * sum(abs(y - h)) / nullif(sum(abs(y) + abs(h)), 0) AS smape, sum(abs(y - h) * y) / nullif(sum(y), 0) AS mae_weighted, 100 * sum(abs(p - q)) / 2 AS share_error,
100 * sum(abs(p - q) * p) AS share_error_weighted, -sum(p * ln(q + 1e-12)) AS cross_entropy, sum(CASE WHEN p > 0 THEN p * ln((p + 1e-12) / (q + 1e-12)) ELSE 0.0 END) AS divergence FROM pq GROUP BY region""", _METRICS)
def allocation_metrics(spark, d):
    return metrics.allocation_metrics(b.matrix(spark, d), "real", "new", ["region"])


@query(f"""WITH {b.SALES}, t AS (SELECT grp, store, sum(qty) AS sold FROM sales WHERE day BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' GROUP BY ALL)--FROM--SELECT grp, store, sold, coalesce(sold / nullif(sum(sold) OVER (PARTITION BY grp), 0), 0.0) AS share FROM t""", "share")
def factual_share(spark, d):
    return metrics.factual_share(b.sales(spark, d), ["grp", "store"], ["grp"], pilot.in_days("day", "1999-01-01", "1999-03-31"))


@query(f"""WITH {b.PANEL}, band AS (SELECT *, quantile_disc(qty, 0.05) OVER w AS lo, quantile_disc(qty, 0.95) OVER w AS hi FROM panel WINDOW w AS (PARTITION BY grp, store ORDER BY day ROWS BETWEEN 179 PRECEDING AND CURRENT ROW))--FROM--SELECT grp, store, day, CASE WHEN qty BETWEEN lo AND hi THEN qty END AS in_band FROM band""")
def factual_trimmed_band(spark, d):
    return demand.quantile_band(b.panel(spark, d), "qty", ("grp", "store")).select("grp", "store", "day", "in_band")


@query(_W + f"SELECT grp, store, {_smape('new', 'real')} AS smape, ({_smape('new', 'real')}) * real_qty AS smape_weighted FROM matrix", "smape smape_weighted")
def smape_components(spark, d):
    return metrics.smape_components(b.matrix(spark, d), "new", "real", "real_qty").select("grp", "store", "smape", "smape_weighted")


def _models(keys=""):
    k = f"{keys}, " if keys else ""
    return f"""SELECT {k}model, avg({_smape('pred', 'real')}) AS smape, sum(({_smape('pred', 'real')}) * real_qty) / nullif(sum(real_qty), 0) AS wsmape, {_wmape('pred', 'real', 'real_qty')} AS wmape
FROM (SELECT *, 'new' AS model, new AS pred FROM matrix UNION ALL SELECT *, 'old' AS model, old AS pred FROM matrix) GROUP BY {k}model"""


@query(_W + _models(), "smape wsmape wmape")
def model_comparison(spark, d):
    return metrics.model_comparison(b.matrix(spark, d), ["new", "old"], "real", "real_qty")


@query(_W + f"SELECT grp, wmape_weighted, volume, 100 * volume / nullif(all_volume, 0) AS volume_pct FROM (SELECT grp, {_wmape('new', 'real', 'real_qty')} AS wmape_weighted, sum(real_qty) AS volume, sum(sum(real_qty)) OVER () AS all_volume FROM matrix GROUP BY grp) WHERE volume >= 100", "wmape_weighted volume_pct")
def wmape_by_group(spark, d):
    return metrics.wmape_by_group(b.matrix(spark, d), "new", "real", "real_qty", "grp", 100)


@query(_W + "SELECT grp, store, 200 * abs(new - real) / (abs(new) + abs(real) + 1e-9) AS smape_new, 200 * abs(old - real) / (abs(old) + abs(real) + 1e-9) AS smape_old FROM matrix", "smape_new smape_old")
def smape_vs_factual(spark, d):
    return metrics.smape_of_measures(b.matrix(spark, d), ["new", "old"], "real").select("grp", "store", "smape_new", "smape_old")


def _levels(*levels):
    part = lambda name, value, by: f"SELECT '{name}' AS level, {value} AS value, {_wmape('new', 'real')} AS wmape, sum(real) AS volume, count(*) AS n FROM matrix{by}"
    return " UNION ALL ".join([part("all", "'all'", ""), *(part(c, f"CAST({c} AS VARCHAR)", f" GROUP BY {c}") for c in levels)])


@query(_W + _levels("store", "grp"), "wmape volume")
def wmape_levels(spark, d):
    return metrics.error_levels(b.matrix(spark, d), "new", "real", ["store", "grp"])


@query(_W + _levels("band", "region"), "wmape volume")
def accuracy_levels(spark, d):
    return metrics.error_levels(b.matrix(spark, d), "new", "real", ["band", "region"])


@query(_W + f"SELECT grp, store, {_smape('new', 'old')} AS smape_new_old, {_smape('new', 'real')} AS smape_new_real, {_smape('old', 'real')} AS smape_old_real FROM matrix", "smape_new_old smape_new_real smape_old_real")
def incumbent_comparison(spark, d):
    return metrics.incumbent_comparison(b.matrix(spark, d), "new", "old", "real").select("grp", "store", "smape_new_old", "smape_new_real", "smape_old_real")


_BEST = f"SELECT grp, store, least({_smape('new', 'real')}, {_smape('old', 'real')}) AS best FROM matrix"


@query(_W + f"SELECT grp, store, best, CASE WHEN best < 10 THEN 'excellent' WHEN best < 20 THEN 'good' WHEN best < 30 THEN 'fair' WHEN best < 50 THEN 'weak' ELSE 'poor' END AS quality FROM ({_BEST}) WHERE best > 25", "best")
def distortions(spark, d):
    m = b.matrix(spark, d).withColumns({"smape_new": smape(F.col("new"), F.col("real")), "smape_old": smape(F.col("old"), F.col("real"))})
    return metrics.distortions(m, ["smape_new", "smape_old"], 25).select("grp", "store", "best", "quality")


_DELTA = "CASE WHEN x IS NULL THEN 'no sales' WHEN x < -100 THEN '< -100' WHEN x < -50 THEN '-100 to -50' WHEN x < 0 THEN '-50 to 0' WHEN x < 50 THEN '0 to 50' WHEN x <= 100 THEN '50 to 100' ELSE '> 100' END"


@query(_W + f"SELECT {_DELTA} AS bucket, band, count(*) AS n, sum(real) AS real_share FROM (SELECT *, 100 * ((new - real) / nullif(real, 0)) AS x FROM matrix) GROUP BY ALL", "real_share")
def delta_buckets(spark, d):
    return metrics.delta_buckets(b.matrix(spark, d), "new", "real", "band")


@query(_W + f"SELECT *, {_smape('mean_new', 'mean_real')} AS smape_new, {_smape('mean_old', 'mean_real')} AS smape_old FROM (SELECT store, avg(real) AS mean_real, avg(new) AS mean_new, avg(old) AS mean_old FROM matrix GROUP BY store)", "mean_real mean_new mean_old smape_new smape_old")
def store_mean_smape(spark, d):
    return metrics.means_and_smape(b.matrix(spark, d), "store", ["new", "old"], "real")


_TO_DC = f"WITH {b.MATRIX.replace('matrix AS (', 'per_store AS (')}, matrix AS (SELECT dc, grp, sum(real_qty) AS real_qty, sum(new * real_qty) / nullif(sum(real_qty), 0) AS new, sum(old * real_qty) / nullif(sum(real_qty), 0) AS old, sum(real * real_qty) / nullif(sum(real_qty), 0) AS real FROM per_store GROUP BY dc, grp)--FROM--"


@query(_TO_DC + "SELECT dc, grp, real_qty, new, old, real FROM matrix", "new old real")
def dc_weighted_mean(spark, d):
    return metrics.weighted_mean_to(b.matrix(spark, d), ["dc", "grp"], ["new", "old", "real"], "real_qty")


@query(_TO_DC + _models("dc"), "smape wsmape wmape")
def dc_model_comparison(spark, d):
    return metrics.model_comparison(metrics.weighted_mean_to(b.matrix(spark, d), ["dc", "grp"], ["new", "old", "real"], "real_qty"), ["new", "old"], "real", "real_qty", ["dc"])


@query(_W + f"SELECT grp, avg(CASE WHEN new < real THEN {_smape('new', 'real')} END) AS smape_under, sum(CASE WHEN new < real THEN ({_smape('new', 'real')}) * real_qty END) / nullif(sum(CASE WHEN new < real THEN real_qty END), 0) AS wsmape_under, CAST(sum(CASE WHEN new < real THEN 1 ELSE 0 END) AS BIGINT) AS n_under FROM matrix GROUP BY grp", "smape_under wsmape_under")
def under_allocation_error(spark, d):
    return metrics.under_allocation(b.matrix(spark, d), "new", "real", "real_qty", ["grp"])


@query(_W + f"SELECT grp, store, {_smape('new', 'real')} AS smape_new, {_smape('old', 'real')} AS smape_old, ({_smape('new', 'real')}) * real AS wsmape_new, ({_smape('old', 'real')}) * real AS wsmape_old FROM matrix WHERE grp = 'PROMO'", "smape_new smape_old wsmape_new wsmape_old")
def two_matrix_smape(spark, d):
    m = b.matrix(spark, d).where("grp = 'PROMO'")
    return m.select("grp", "store", *[smape(F.col(c), F.col("real")).alias(f"smape_{c}") for c in ("new", "old")], *[(smape(F.col(c), F.col("real")) * F.col("real")).alias(f"wsmape_{c}") for c in ("new", "old")])


@query(_W + "SELECT grp, store, abs(real - new) AS abs_error, greatest(real - new, 0.0) AS under_error, abs(real - new) * CASE WHEN real - new > 0 THEN 1.5 ELSE 1.0 END AS weighted_error, CASE WHEN real > 0 THEN real * ln((real + 1e-12) / (new + 1e-12)) ELSE 0.0 END AS divergence FROM matrix", "abs_error under_error weighted_error divergence")
def asymmetric_error(spark, d):
    return metrics.asymmetric_error(b.matrix(spark, d), "new", "real").select("grp", "store", "abs_error", "under_error", "weighted_error", "divergence")


@query(_W + "SELECT store, dc, pred, real, 100 * (pred - real) / greatest(real, 0.01) AS error_pct, 100 * abs(pred - real) / greatest(real, 0.01) AS abs_error_pct FROM (SELECT store, dc, sum(new) AS pred, sum(real) AS real FROM matrix GROUP BY ALL)", "pred real error_pct abs_error_pct")
def store_error(spark, d):
    return metrics.error_per(b.matrix(spark, d), ["store", "dc"], "new", "real")


def _level(c):
    return f"SELECT '{c}' AS level, {c} AS value, mean_pred, mean_real, demand, {_smape('mean_pred', 'mean_real')} AS smape FROM (SELECT {c}, avg(new) AS mean_pred, avg(real) AS mean_real, sum(real_qty) AS demand FROM matrix GROUP BY {c})"


@query(_W + _level("band") + " UNION ALL " + _level("region"), "mean_pred mean_real smape")
def band_region_smape(spark, d):
    m = b.matrix(spark, d)
    part = lambda c: metrics.level_smape(m, c, "new", "real", "real_qty").select(F.lit(c).alias("level"), F.col(c).alias("value"), "mean_pred", "mean_real", "demand", "smape")
    return part("band").unionByName(part("region"))


@query(_W + "SELECT store, band, avg(real) AS mean_real, avg(new) AS mean_new, avg(old) AS mean_old, max(CAST(regexp_extract(band, '([0-9]+)', 1) AS INTEGER)) AS band_no FROM matrix GROUP BY store, band", "mean_real mean_new mean_old")
def store_means(spark, d):
    m = b.matrix(spark, d)
    return m.groupBy("store", "band").agg(F.avg("real").alias("mean_real"), F.avg("new").alias("mean_new"), F.avg("old").alias("mean_old")).withColumn("band_no", band_number("band"))
