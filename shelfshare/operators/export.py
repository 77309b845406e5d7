"""The exportable matrix: channels, transfers, and percentages that add up to exactly 100."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import store_code
from . import cleaning
from .lineage import running_total, small, stored


def transfer_to_dc(df: DataFrame, valid: DataFrame, target: int) -> DataFrame:
    """Shares of centres that aren't valid go to the target centre per sku and group; their own rows stay with 0. The total
    stays, also if a centre is listed more than once."""
    flagged = df.join(valid.select("store").distinct().withColumn("ok_", F.lit(True)), "store", "left").withColumn("ok_", F.coalesce("ok_", ~F.col("is_dc")))
    moved = flagged.withColumn("store", F.when(F.col("ok_"), F.col("store")).otherwise(target))
    summed = moved.groupBy("sku", "grp", "store").agg(F.sum("share").alias("share"))
    zeros = flagged.where(~F.col("ok_")).select("sku", "grp", "store", F.lit(0.0).alias("share")).distinct()
    return summed.unionByName(zeros)


def channel_matrix(df: DataFrame, channel: str) -> DataFrame:
    """The mean share in percent per sku and store, labelled with the channel."""
    return df.groupBy("sku", "store").agg(F.avg(100 * F.col("share")).alias("share")).withColumn("channel", F.lit(channel))


def normalise_to_100(df: DataFrame, keys: tuple[str, ...] = ("sku", "channel"), value: str = "share") -> DataFrame:
    """`percent`: shares per key scaled to 100, with three decimals that add up to exactly 100.

    After scaling, the largest row takes what is missing to 100; after rounding, again; ties go to the smallest store. Where
    all shares are 0 the first row takes the whole 100. The second pass counts in decimals, so the sum is exact.
    """
    total = Window.partitionBy(*keys)
    first = total.orderBy(F.desc("part_"), F.asc("store"))
    out = df.withColumn("part_", F.coalesce(F.try_divide(100 * F.col(value), F.sum(value).over(total)), F.lit(0.0)))
    out = out.withColumn("rank_", F.row_number().over(first))
    out = out.withColumn("part_", F.round(F.when(F.col("rank_") == 1, F.col("part_") + F.round(100 - F.sum("part_").over(total), 9)).otherwise(F.col("part_")), 3).cast("decimal(18,3)"))
    out = out.withColumn("rank_", F.row_number().over(first))
    exact = F.when(F.col("rank_") == 1, F.col("part_") + F.lit(100) - F.sum("part_").over(total)).otherwise(F.col("part_"))
    return out.withColumn("percent", exact.cast("double")).drop("part_", "rank_")


def eligibility(df: DataFrame, reference: DataFrame, always: list[int]) -> DataFrame:
    """df with `is_dc` and `eligible` from the reference list (store, kind); a store that is there twice counts as a centre."""
    known = reference.groupBy("store").agg(F.max(F.col("kind").isin("CD", "Entreposto", "TERMINAL").cast("int")).alias("dc_"))
    out = df.join(small(stored(known, "eligible"), 16), "store", "left")
    return out.withColumns({"eligible": F.col("dc_").isNotNull() | F.col("store").isin(always), "is_dc": F.col("store").isin(always) | F.coalesce(F.col("dc_") == 1, F.lit(False))}).drop("dc_")


def final_export(df: DataFrame, end_date: int, more: list[str] | None = None) -> DataFrame:
    """The five columns of the export file, after others that are to be kept."""
    return df.select(*(more or []), F.col("sku").cast("string").alias("SKU"), F.col("channel").alias("CANAL"), store_code(F.col("store"), F.col("is_dc")).alias("LOJA"), F.lit(end_date).alias("DATA FIM"), F.round("percent", 3).alias("PERCENTUAL"))


def file_numbers(df: DataFrame, key: str, most: int) -> DataFrame:
    """`file_no`: all rows of a key in one file, which is closed once the rows so far reach `most`.

    The running count runs over one row per key, not over the rows, and range by range.
    """
    per_key = running_total(df.groupBy(key).agg(F.count("*").alias("rows_")), [F.asc(key)], F.col("rows_"), "upto_")
    return df.join(per_key.select(key, F.floor((F.col("upto_") - F.col("rows_")) / most).cast("int").alias("file_no")), key)


def removed_rows(df: DataFrame) -> DataFrame:
    """Per store that isn't eligible: rows, skus and the share that goes with them."""
    return df.where(~F.col("eligible")).groupBy("store").agg(F.count("*").alias("n_rows"), F.count_distinct("sku").alias("skus"), F.sum("share").alias("share"))


def removed_top(df: DataFrame, most: int = 10) -> DataFrame:
    """The skus that lose the largest share with the rows that aren't eligible, ties by sku."""
    return df.where(~F.col("eligible")).groupBy("sku").agg(F.sum("share").alias("share")).orderBy(F.desc("share"), "sku").limit(most)


def export_chain(df: DataFrame, channel: str, groups: list[str] | None = None, drop_groups: bool = False, kinds: list[str] | None = None, not_brands: list[str] | None = None, merged: tuple[int, int] | None = None, valid: DataFrame | None = None, target: int = 14) -> DataFrame:
    """The exportable matrix of one channel from sku, grp, store, kind, brand, is_dc, share: products and groups filtered, one
    store counted with another, shares of centres that aren't valid given to the target, the mean per sku and store in percent."""
    out = cleaning.filter_products(df, kinds, not_brands, groups, drop_groups)
    if merged:
        out = out.withColumn("store", F.when(F.col("store") == merged[0], merged[1]).otherwise(F.col("store")))
        out = out.groupBy("sku", "grp", "store").agg(F.sum("share").alias("share"), F.max("is_dc").alias("is_dc"))
    if valid is not None:
        out = transfer_to_dc(out, valid, target)
    return channel_matrix(out, channel)


def integrity_report(df: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """rule, sku, channel, value of every violation: sums, doubled keys, missing and unknown channels, lone rows."""
    sums = df.groupBy("sku", "channel").agg(F.sum("percent").alias("total"), F.count("*").alias("n"))
    keys = df.groupBy("sku", "channel", "store").agg(F.count("*").alias("n")).where("n > 1")
    channels = df.groupBy("sku").agg(F.count_distinct("channel").alias("n"), F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("names"))
    rule = lambda frame, name, channel, value: frame.select(F.lit(name).alias("rule"), "sku", channel.alias("channel"), value.cast("double").alias("value"))
    return (
        rule(sums.where(F.abs(F.col("total") - 100) > tolerance), "sum", F.col("channel"), F.col("total"))
        .unionByName(rule(keys, "unique", F.col("channel"), F.col("n")))
        .unionByName(rule(channels.where("n <> 2"), "both_channels", F.col("names"), F.col("n")))
        .unionByName(rule(sums.where(~F.col("channel").isin("ONLINE", "OFFLINE")), "channel_name", F.col("channel"), F.col("n")))
        .unionByName(rule(sums.where("n < 2"), "rows", F.col("channel"), F.col("n")))
    )


def channel_difference(df: DataFrame) -> DataFrame:
    """One row: rows, skus and stores of each channel, the skus both have or one alone, and their ratios."""
    skus = df.groupBy("sku").agg(F.max((F.col("channel") == "OFFLINE").cast("int")).alias("off"), F.max((F.col("channel") == "ONLINE").cast("int")).alias("on"))
    overlap = skus.agg(F.sum((F.col("off") * F.col("on"))).alias("skus_both"), F.sum(F.col("off") * (1 - F.col("on"))).alias("skus_only_off"), F.sum(F.col("on") * (1 - F.col("off"))).alias("skus_only_on"))
    side = lambda c, n: [F.count(F.when(F.col("channel") == c, 1)).alias(f"rows_{n}"), F.count_distinct(F.when(F.col("channel") == c, F.col("store"))).alias(f"stores_{n}")]
    return df.agg(*side("OFFLINE", "off"), *side("ONLINE", "on")).crossJoin(overlap).withColumn("row_ratio", F.try_divide("rows_on", "rows_off"))


def files_report(df: DataFrame) -> DataFrame:
    """Per file the skus that have fewer than two rows or not both channels in it: rule, file_no, sku, value."""
    per = df.groupBy("file_no", "sku").agg(F.count("*").alias("n"), F.count_distinct("channel").alias("channels"))
    rule = lambda frame, name, value: frame.select(F.lit(name).alias("rule"), "file_no", "sku", value.cast("double").alias("value"))
    return rule(per.where("n < 2"), "rows", F.col("n")).unionByName(rule(per.where("channels < 2"), "channels", F.col("channels")))


def validation_sheet(df: DataFrame) -> DataFrame:
    """Both channels side by side per group and store, null as 0."""
    part = lambda c, n: df.where(F.col("channel") == c).groupBy("grp", "store").agg(F.sum("share").alias(n))
    return part("OFFLINE", "offline").join(part("ONLINE", "online"), ["grp", "store"], "full_outer").fillna(0.0, ["offline", "online"])


def tolerance_check(df: DataFrame, keys: list[str], value: str, most: float = 0.1) -> DataFrame:
    """Per key the sum, its distance from 100 and whether it is within the tolerance."""
    total = F.sum(value)
    return df.groupBy(*keys).agg(total.alias("total")).withColumns({"off_by": F.abs(F.col("total") - 100), "ok": (F.abs(F.col("total") - 100) <= most).cast("int")})
