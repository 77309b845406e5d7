"""Rolling order statistics against looking at every window anew."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfshare.operators import demand, sliding


def rank(values, q):
    return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]


def slow(values, windows, low, high, least):
    flags = {}
    for n in windows:
        for i, v in enumerate(values):
            own = [x for x in values[max(0, i - n) : i + 1] if x is not None]
            flags[n, i] = v is not None and rank(own, low) <= v <= rank(own, high)
    out = []
    for i in range(len(values)):
        row, mean = [], lambda xs: sum(xs) / len(xs) if xs else None
        for n in windows:
            at = range(max(0, i - n), i + 1)
            own = [values[j] for j in at if values[j] is not None]
            cut = mean([values[j] for j in at if flags[n, j]]) if len(own) >= least else None
            row.append(next((x for x in (cut, mean(own), mean([v for v in values[max(0, i - max(windows)) : i + 1] if v is not None])) if x is not None), 0.0))
        out.append(row)
    return out


def test_trimmed_means(monkeypatch):
    rng = random.Random(2)
    for block in (2, 512):
        monkeypatch.setattr(sliding, "BLOCK", block)
        for _ in range(40):
            values = [None if rng.random() < 0.1 else float(rng.choice([1, 2, 2, 3, 50, rng.gauss(5, 9)])) for _ in range(rng.randint(0, 90))]
            windows = (5, 12, 40)
            series = sliding.Trimmed(tuple(n + 1 for n in windows), 0.1, 0.9, 4)
            for got, want in zip(map(series.push, values), slow(values, windows, 0.1, 0.9, 4), strict=True):
                assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want, strict=True))


def test_quantiles_are_those_of_the_built_in(spark):
    ordered = sliding.SortedWindow()
    rng, want = random.Random(4), {}
    values = [rng.gauss(0, 1) for _ in range(420)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    w = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    for r in df.withColumn("q", F.percentile_approx("v", F.array(*map(F.lit, (0.01, 0.05, 0.5, 0.95, 0.99))), F.lit(10_000)).over(w)).collect():
        want[r.i] = r.q
    for i, v in enumerate(values):
        ordered.add(v)
        assert [ordered.quantile(q) for q in (0.01, 0.05, 0.5, 0.95, 0.99)] == want[i]


def test_series_over_batches_and_odd_keys(spark):
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(5)
        series = {("a", 1): 60, ("a", 2): 3, (None, 1): 20, ("b", None): 25, ("c", 9): 1}
        data = {k: [None if rng.random() < 0.1 else rng.choice([1.0, 2.0, float("nan"), 40.0]) for _ in range(n)] for k, n in series.items()}
        rows = [(g, s, i, v, "x") for (g, s), own in data.items() for i, v in enumerate(own)]
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "grp string, store int, day int, demand double, trimmed_5 string")  # a clashing column is replaced
        got = demand.rolling_trimmed_mean(df, (5, 12), least=4)
        assert got.columns == ["grp", "store", "day", "demand", "trimmed_5", "trimmed_12"]
        found = {(r.grp, r.store, r.day): (r.trimmed_5, r.trimmed_12) for r in got.collect()}
        assert len(found) == len(rows)
        for (g, s), own in data.items():
            want = slow([None if v is None or v != v else v for v in own], (5, 12), 0.01, 0.99, 4)
            for i, row in enumerate(want):
                assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(found[g, s, i], row, strict=True))
        assert demand.rolling_trimmed_mean(df.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
