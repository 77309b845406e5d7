"""Exact quantiles of groups of any size: rows stay where they are, and only counters and sketches of bounded size meet.

Groups of at most `held` values are sorted as they are. For a larger group a quantile sketch brackets the wanted ranks
between two of its values; the next pass counts the values below, at and between them, which tells the bracket's exact ranks,
and sketches what lies between. Each pass leaves about one value in fifty, until a bracket has few enough to be sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import Tables, small

#: Values of one group that a task may hold at once.
HELD = 20_000
#: Steps of the grid that a sketch gives, and its accuracy: its error is far below a step.
GRID, ACCURACY = 100, 2_000


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[f"{k}_"])
    return same


def exact_quantile(df: DataFrame, keys: list[str], value: str, name: str, q: float = 0.5, held: int = HELD) -> DataFrame:
    """keys, name: the q-quantile of the values of each group, as F.percentile gives it (between two values in proportion).

    Nulls don't count; a group with nulls only has a null quantile. Keys may be null. NaN counts as the largest value. An
    empty table gives no group. With no keys the result is one row, null for an empty table.
    """
    spark, tables = df.sparkSession, Tables(df.sparkSession)
    own = keys or ["all_"]
    rows = df.select(*[F.col(k) for k in keys], *([] if keys else [F.lit(1).alias("all_")]), F.col(value).cast("double").alias("v"))
    rows = tables.store(rows, "selection-rows")
    counted = rows.groupBy(*own).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranks = {"k1": F.floor((F.col("n") - 1) * q), "k2": F.ceil((F.col("n") - 1) * q)}
    open_ = counted.where(F.col("n") > held).withColumns(ranks).withColumns({"v1": F.lit(None).cast("double"), "v2": F.lit(None).cast("double")})
    open_ = tables.store(open_, "selection-open")
    plain = rows
    done: list[DataFrame] = []
    if not open_.isEmpty():
        large = small(open_.select(*[F.col(k).alias(f"{k}_") for k in own]), 100)
        plain = rows.join(large, _same(rows, large, own), "left_anti")
        done = _narrowed(rows, open_, own, held, tables, q)
    out = plain.groupBy(*own).agg(F.percentile("v", q).alias(name))
    for part in done:
        out = out.unionByName(part.withColumnRenamed("quantile_", name))
    if keys:
        return out
    return spark.range(1).select().join(out.select(name), F.lit(True), "left")


def _narrowed(rows: DataFrame, open_: DataFrame, keys: list[str], held: int, tables: Tables, q: float) -> list[DataFrame]:
    """The quantiles of large groups, given (keys, n, lo, hi, k1, k2, v1, v2): the ends of a bracket, the ranks, and their values once known."""
    done = []
    between = (F.col("v") > F.col("lo")) & (F.col("v") < F.col("hi"))
    grid = F.percentile_approx(F.when(between, F.col("v")), F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]), F.lit(ACCURACY))
    state = ["n", "lo", "hi", "k1", "k2", "v1", "v2"]
    while True:
        near = _with(rows, open_, keys)
        seen = near.groupBy(*keys, *state).agg(F.count_if(F.col("v") < F.col("lo")).alias("less"), F.count_if(F.col("v") == F.col("lo")).alias("at_lo"), F.count_if(between).alias("inside"), grid.alias("grid"))
        start = F.col("less") + F.col("at_lo")
        end = start + F.col("inside")

        def known(k: str, v: str, start: Column = start, end: Column = end) -> Column:
            lost = F.raise_error(F.lit("a sketch was further off than its bound")).cast("double")
            return F.coalesce(F.col(v), F.when(F.col(k) < F.col("less"), lost).when(F.col(k) < start, F.col("lo")).when(F.col(k) >= end, F.col("hi")))

        seen = seen.withColumns({"v1": known("k1", "v1"), "v2": known("k2", "v2"), "start": start})
        seen = tables.store(seen, "selection-seen")
        settled = F.col("v1").isNotNull() & F.col("v2").isNotNull()
        done.append(seen.where(settled).select(*keys, _between(q).alias("quantile_")))
        few = seen.where(~settled & (F.col("inside") <= held))
        last = _with(rows, few.drop("grid"), keys).where(between)
        listed = last.groupBy(*keys, *state, "start").agg(F.sort_array(F.collect_list("v")).alias("list"))
        pick = lambda k, v: F.coalesce(F.col(v), F.element_at("list", (F.col(k) - F.col("start") + 1).cast("int")))
        if not few.isEmpty():
            done.append(listed.withColumns({"v1": pick("k1", "v1"), "v2": pick("k2", "v2")}).select(*keys, _between(q).alias("quantile_")))
        many = seen.where(~settled & (F.col("inside") > held))
        low, high = F.when(F.col("v1").isNull(), F.col("k1")).otherwise(F.col("k2")), F.when(F.col("v2").isNull(), F.col("k2")).otherwise(F.col("k1"))
        step = lambda k: (k - F.col("start")) * GRID / F.col("inside")
        below, above = (F.floor(step(low)) - 1).cast("int"), (F.ceil(step(high)) + 1).cast("int")
        ends = {"lo": F.when(below > 0, F.get("grid", below)).otherwise(F.col("lo")), "hi": F.when(above < GRID, F.get("grid", above)).otherwise(F.col("hi"))}
        open_ = tables.store(many.withColumns(ends).select(*keys, *state), "selection-open")
        if open_.isEmpty():
            return done


def _between(q: float) -> Column:
    at = (F.col("n") - 1) * q
    part = at - F.floor(at)
    return F.when(F.col("v1") == F.col("v2"), F.col("v1")).otherwise((1 - part) * F.col("v1") + part * F.col("v2"))


def _with(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the groups of state, with its columns."""
    other = small(state.withColumnsRenamed({k: f"{k}_" for k in keys}), 200)
    return rows.join(other, _same(rows, other, keys)).drop(*[f"{k}_" for k in keys])


def with_exact_median(aggregated: DataFrame, df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """aggregated (a row per group of keys) with the exact median of a value of df."""
    found = exact_quantile(df, keys, value, name)
    found = found.withColumnsRenamed({k: f"{k}_" for k in keys})
    return aggregated.join(found, _same(aggregated, found, keys)).drop(*[f"{k}_" for k in keys])
