"""Column expressions that the operators share; all stay inside Spark's code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(value: Column, *keys: str) -> Column:
    """value over its partition's total; 0 where the total is 0."""
    total = F.sum(value).over(Window.partitionBy(*keys))
    return F.coalesce(F.try_divide(value, total), F.lit(0.0))


def with_share(df: DataFrame, names: dict[str, str], keys: list[str], scale: float = 1.0) -> DataFrame:
    """df with scale times each column's share of its total per key, under a name; for keys that a large part of the rows may
    share: totals are summed up per task before they meet, and rows aren't gathered by key. 0 where the total is 0."""
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(f"all_{n}") for n, c in names.items()])
    shared = df.join(totals, keys)
    return shared.withColumns({n: scale * F.coalesce(F.try_divide(F.col(c), F.col(f"all_{n}")), F.lit(0.0)) for n, c in names.items()}).drop(*[f"all_{n}" for n in names])


def suffixed(df: DataFrame, keys: list[str], suffix: str = "", prefix: str = "") -> DataFrame:
    """All columns but the keys with a prefix and a suffix."""
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keys})


def in_order(column: str, names: list[str]) -> Column:
    """A sort key: the place of a value in a list, others after it."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col(column))
    return F.when(place > 0, place).otherwise(len(names) + 1)


def need_group(column: str, suffix: str | None = None) -> Column:
    """The need group: a column, or it and the first three characters of another; a null group is SEM_GN."""
    name = F.col(column)
    if suffix:
        name = F.concat(name, F.lit("_"), F.substring(F.coalesce(F.col(suffix), F.lit("")), 1, 3))
    return F.coalesce(name, F.lit("SEM_GN"))


def twin_or_model(twin: str, model: str) -> Column:
    return F.when(F.col(twin) == "-", F.col(model)).otherwise(F.col(twin))


def normalised_id(column: str) -> Column:
    """Without blanks around and leading zeros; a lone 0 stays; null stays null."""
    return F.regexp_replace(F.trim(F.col(column).cast("string")), r"^0+(?!$)", "")


def store_code(store: Column, is_dc: Column) -> Column:
    """0021_ and five digits for a shop, 0099_ for a distribution centre."""
    return F.concat(F.when(is_dc, "0099_").otherwise("0021_"), F.lpad(store.cast("string"), 5, "0"))


def store_from_code(code: str) -> Column:
    return F.regexp_extract(F.col(code), r"(\d+)$", 1).try_cast("long")


def band_number(band: str) -> Column:
    """The number in a size band's name; null where there is none."""
    return F.regexp_extract(F.col(band), r"(\d+)", 1).try_cast("int")


def band_weight(band: str) -> Column:
    """1.5 times a band number from 1 to 6; 1 otherwise."""
    n = band_number(band)
    return F.coalesce(F.when(n.between(1, 6), n * 1.5), F.lit(1.0))


def period_label(day: str, pilot_from: str, baseline_from: str) -> Column:
    return F.when(F.col(day) >= F.lit(pilot_from).cast("date"), "pilot").when(F.col(day) >= F.lit(baseline_from).cast("date"), "baseline").otherwise("ignore")


def period_norm(column: str) -> Column:
    """baseline, pilot or other, from text written in any case and with blanks."""
    text = F.lower(F.trim(F.col(column)))
    return F.when(text.like("base%"), "baseline").when(text.like("pilot%"), "pilot").otherwise("other")


def comma_number(value: Column, decimals: int = 2) -> Column:
    """Text with a decimal comma and no grouping."""
    return F.regexp_replace(F.regexp_replace(F.format_number(value, decimals), ",", ""), r"\.", ",")


def number_from_comma(text: str) -> Column:
    """The number that a text with a decimal comma states; null where it states none."""
    return F.regexp_replace(F.trim(F.col(text)), ",", ".").try_cast("double")


def smape(a: Column, b: Column) -> Column:
    """0 to 200; 0 where both are 0."""
    return F.when((a == 0) & (b == 0), 0.0).otherwise(F.try_divide(200 * F.abs(a - b), F.abs(a) + F.abs(b)))


def wmape(pred: Column, real: Column, weight: Column | None = None) -> Column:
    """The weighted absolute error over the weighted real values, in percent, as an aggregate."""
    w = F.lit(1.0) if weight is None else weight
    return F.try_divide(100 * F.sum(F.abs(pred - real) * w), F.sum(F.abs(real) * w))


def mean_if(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def wmean_if(value: Column, weight: Column, condition: Column) -> Column:
    return F.try_divide(F.sum(F.when(condition, value * weight)), F.sum(F.when(condition, weight)))


def stock_days_bucket(value: Column) -> Column:
    """Classes of stock cover in days."""
    return F.when(value.isNull(), "none").when(value <= 15, "0-15").when(value <= 30, "15-30").when(value <= 45, "30-45").when(value <= 60, "45-60").otherwise("60+")


def delta_bucket(value: Column) -> Column:
    """Classes of a change in percent; what falls below -100 has a class of its own."""
    return F.when(value < -100, "< -100").when(value < -50, "-100 to -50").when(value < 0, "-50 to 0").when(value < 50, "0 to 50").when(value <= 100, "50 to 100").otherwise("> 100")


def change_bucket(new: Column, old: Column, limit: float = 0.2) -> Column:
    """Whether a share rose or fell by more than limit of the old one."""
    change = F.try_divide(new - old, old)
    return F.when(change.isNull(), "new").when(change > limit, "more").when(change < -limit, "less").otherwise("same")


def quality_class(value: Column) -> Column:
    return F.when(value < 10, "excellent").when(value < 20, "good").when(value < 30, "fair").when(value < 50, "weak").otherwise("poor")
