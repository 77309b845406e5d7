"""How good shares are: against what sold, and against the incumbent matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import delta_bucket, mean_if, quality_class, share_of_total, smape, wmape, with_share, wmean_if


def allocation_metrics(df: DataFrame, y: str, yhat: str, groups: list[str], eps: float = 1e-12) -> DataFrame:
    """Per group: wMAPE, sMAPE as a ratio of sums, MAE weighted by y, share errors in points, cross entropy and divergence."""
    rows = with_share(df, {"p_": y, "q_": yhat}, groups).withColumn("e_", F.abs(F.col(y) - F.col(yhat)))
    return rows.groupBy(*groups).agg(
        (100 * F.try_divide(F.sum("e_"), F.sum(F.abs(F.col(y))))).alias("wmape"),
        (200 * F.try_divide(F.sum("e_"), F.sum(F.abs(F.col(y)) + F.abs(F.col(yhat))))).alias("smape"),
        F.try_divide(F.sum(F.col("e_") * F.col(y)), F.sum(y)).alias("mae_weighted"),
        (100 * F.sum(F.abs(F.col("p_") - F.col("q_"))) / 2).alias("share_error"),
        (100 * F.sum(F.abs(F.col("p_") - F.col("q_")) * F.col("p_"))).alias("share_error_weighted"),
        (-F.sum(F.col("p_") * F.log(F.col("q_") + eps))).alias("cross_entropy"),
        F.sum(F.when(F.col("p_") > 0, F.col("p_") * F.log((F.col("p_") + eps) / (F.col("q_") + eps))).otherwise(0.0)).alias("divergence"),
    )


def factual_share(df: DataFrame, keys: list[str], within: list[str], period: Column, value: str = "qty") -> DataFrame:
    """What sold in a period per key, and its share of the total within some of the keys."""
    return df.where(period).groupBy(*keys).agg(F.sum(value).alias("sold")).withColumn("share", share_of_total(F.col("sold"), *within))


def smape_components(df: DataFrame, pred: str, real: str, weight: str) -> DataFrame:
    """Row sMAPE and its part weighted by volume."""
    return df.withColumn("smape", smape(F.col(pred), F.col(real))).withColumn("smape_weighted", F.col("smape") * F.col(weight))


def model_comparison(df: DataFrame, models: list[str], real: str, weight: str, keys: list[str] | None = None) -> DataFrame:
    """A row per model (and key): mean sMAPE, volume-weighted sMAPE, wMAPE. Models become rows before one aggregation."""
    keys = keys or []
    long = df.select(*keys, real, weight, F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models])))
    row = smape(F.col("pred"), F.col(real))
    return long.groupBy(*keys, "model").agg(F.avg(row).alias("smape"), F.try_divide(F.sum(row * F.col(weight)), F.sum(weight)).alias("wsmape"), wmape(F.col("pred"), F.col(real), F.col(weight)).alias("wmape"))


def wmape_by_group(df: DataFrame, pred: str, real: str, weight: str, group: str, least: float) -> DataFrame:
    """Weighted error per group of enough volume, with the group's part of all volume."""
    per = df.groupBy(group).agg(wmape(F.col(pred), F.col(real), F.col(weight)).alias("wmape_weighted"), F.sum(weight).alias("volume"))
    total = per.agg(F.sum("volume").alias("all_volume"))  # one row
    return per.crossJoin(F.broadcast(total)).where(F.col("volume") >= least).select(group, "wmape_weighted", "volume", (100 * F.try_divide("volume", "all_volume")).alias("volume_pct"))


def smape_of_measures(df: DataFrame, names: list[str], real: str, eps: float = 1e-9) -> DataFrame:
    """A column `smape_<name>` for each measure, with eps in the denominator."""
    return df.select("*", *[(200 * F.abs(F.col(n) - F.col(real)) / (F.abs(n) + F.abs(F.col(real)) + eps)).alias(f"smape_{n}") for n in names])


def error_levels(df: DataFrame, pred: str, real: str, levels: list[str]) -> DataFrame:
    """wMAPE overall and by each level, in one pass by grouping sets; `level` and `value` name the row."""
    out = df.select(*levels, F.col(pred).alias("p_"), F.col(real).alias("r_"))
    grouped = out.groupingSets([[], *[[F.col(c)] for c in levels]], *[F.col(c) for c in levels]).agg(wmape(F.col("p_"), F.col("r_")).alias("wmape"), F.sum("r_").alias("volume"), F.count("*").alias("n"), *[F.grouping(c).alias(f"g_{c}") for c in levels])
    name = F.coalesce(*[F.when(F.col(f"g_{c}") == 0, F.lit(c)) for c in levels], F.lit("all"))
    value = F.coalesce(*[F.when(F.col(f"g_{c}") == 0, F.col(c).cast("string")) for c in levels], F.lit("all"))
    return grouped.select(name.alias("level"), value.alias("value"), "wmape", "volume", "n")


def incumbent_comparison(df: DataFrame, new: str, old: str, real: str) -> DataFrame:
    """Row sMAPE of the new share against the incumbent, and of both against what sold."""
    return df.withColumns({"smape_new_old": smape(F.col(new), F.col(old)), "smape_new_real": smape(F.col(new), F.col(real)), "smape_old_real": smape(F.col(old), F.col(real))})


def distortions(df: DataFrame, names: list[str], over: float = 50) -> DataFrame:
    """The least sMAPE of several, its class, and only rows above a limit."""
    return df.withColumn("best", F.least(*names) if len(names) > 1 else F.col(names[0])).withColumn("quality", quality_class(F.col("best"))).where(F.col("best") > over)


def delta_buckets(df: DataFrame, new: str, real: str, size: str) -> DataFrame:
    """Rows and volume per class of change in percent and size class."""
    delta = 100 * F.try_divide(F.col(new) - F.col(real), F.col(real))
    return df.withColumn("bucket", F.when(delta.isNull(), "no sales").otherwise(delta_bucket(delta))).groupBy("bucket", size).agg(F.count("*").alias("n"), F.sum(real).alias("real_share"))


def means_and_smape(df: DataFrame, key: str, columns: list[str], real: str) -> DataFrame:
    """Means per key, and the sMAPE of each mean against the real one's."""
    means = df.groupBy(key).agg(F.avg(real).alias(f"mean_{real}"), *[F.avg(c).alias(f"mean_{c}") for c in columns])
    return means.withColumns({f"smape_{c}": smape(F.col(f"mean_{c}"), F.col(f"mean_{real}")) for c in columns})


def weighted_mean_to(df: DataFrame, keys: list[str], values: list[str], weight: str) -> DataFrame:
    """Volume-weighted means of a coarser key, and the volume."""
    return df.groupBy(*keys).agg(F.sum(weight).alias(weight), *[F.try_divide(F.sum(F.col(v) * F.col(weight)), F.sum(weight)).alias(v) for v in values])


def under_allocation(df: DataFrame, pred: str, real: str, weight: str, keys: list[str]) -> DataFrame:
    """Mean and weighted sMAPE of the rows that got less than they sold."""
    row, short = smape(F.col(pred), F.col(real)), F.col(pred) < F.col(real)
    return df.groupBy(*keys).agg(mean_if(row, short).alias("smape_under"), wmean_if(row, F.col(weight), short).alias("wsmape_under"), F.sum(short.cast("int")).alias("n_under"))


def asymmetric_error(df: DataFrame, pred: str, real: str, gamma: float = 1.5, eps: float = 1e-12) -> DataFrame:
    """Absolute and under-allocation error, the error weighted by gamma where too little was given, and the divergence term."""
    gap = F.col(real) - F.col(pred)
    return df.withColumns({"abs_error": F.abs(gap), "under_error": F.greatest(gap, F.lit(0.0)), "weighted_error": F.abs(gap) * F.when(gap > 0, gamma).otherwise(1.0), "divergence": F.when(F.col(real) > 0, F.col(real) * F.log((F.col(real) + eps) / (F.col(pred) + eps))).otherwise(0.0)})


def error_per(df: DataFrame, keys: list[str], pred: str, real: str) -> DataFrame:
    """Signed and absolute error in percent of what was real, which counts as 0.01 at least."""
    sums = df.groupBy(*keys).agg(F.sum(pred).alias("pred"), F.sum(real).alias("real"))
    base = F.greatest(F.col("real"), F.lit(0.01))
    return sums.withColumns({"error_pct": 100 * (F.col("pred") - F.col("real")) / base, "abs_error_pct": 100 * F.abs(F.col("pred") - F.col("real")) / base})


def level_wsmape(df: DataFrame, level: str, models: list[str], real: str, weight: str) -> DataFrame:
    """model, wsmape: the sMAPE of mean shares per value of a level, weighted by the demand there; a row per model."""
    per = df.groupBy(level).agg(F.avg(real).alias("real_"), F.sum(weight).alias("weight_"), *[F.avg(m).alias(m) for m in models])
    long = per.select("real_", "weight_", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models])))
    return long.groupBy("model").agg(F.try_divide(F.sum(smape(F.col("pred"), F.col("real_")) * F.col("weight_")), F.sum("weight_")).alias("wsmape"))


def level_smape(df: DataFrame, level: str, pred: str, real: str, weight: str) -> DataFrame:
    """Mean shares, demand and sMAPE per value of a level."""
    out = df.groupBy(level).agg(F.avg(pred).alias("mean_pred"), F.avg(real).alias("mean_real"), F.sum(weight).alias("demand"))
    return out.withColumn("smape", smape(F.col("mean_pred"), F.col("mean_real")))
