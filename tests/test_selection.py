"""Exact quantiles of large groups, and sketched ones."""

import random

import pytest
from pyspark.sql import functions as F

from shelfshare.operators import sketches
from shelfshare.operators.selection import exact_quantile


@pytest.fixture(scope="module")
def values(spark):
    rng, rows = random.Random(1), []
    kinds = {"a": 3000, "b": 2999, None: 1500, "ties": 4000, "few": 7, "one": 1, "wide": 2500, "none": 3}
    for g, n in kinds.items():
        for _ in range(n):
            v = {"ties": float(rng.choice([1, 1, 1, 1, 1, 2, 3])), "wide": 10.0 ** rng.uniform(-200, 200), "none": None}.get(g, rng.gauss(0, 1))
            rows.append((g, None if g == "b" and rng.random() < 0.1 else v))
    rows += [("half", 1.0)] * 1000 + [("half", 2.0)] * 1000 + [("nan", float("nan"))] * 600 + [("nan", 1.0)] * 700
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(4).persist()


@pytest.mark.parametrize("q", [0.5, 0.01, 1.0])
def test_same_as_sorting_all(values, q):
    got = {r.g: r.m for r in exact_quantile(values, ["g"], "v", "m", q, held=50).collect()}
    want = {r.g: r.m for r in values.groupBy("g").agg(F.percentile("v", q).alias("m")).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert (got[g] is None) if want[g] is None else got[g] == pytest.approx(want[g], rel=1e-12, nan_ok=True), g


def test_one_group_of_all_rows(values, monkeypatch):
    """What meets in one task: counters and sketches, and in the end at most `held` values of a group."""
    from shelfshare.operators import selection

    rows = values.where("g IN ('a', 'wide', 'ties')")
    want = rows.agg(F.percentile("v", 0.5)).first()[0]
    listed = selection.F.sort_array
    monkeypatch.setattr(selection.F, "sort_array", lambda c: F.when(F.size(c) > 60, F.raise_error(F.lit("too many values met"))).otherwise(listed(c)))
    assert exact_quantile(rows, [], "v", "m", held=60).first().m == want
    assert exact_quantile(values.limit(0), [], "v", "m").collect()[0].m is None and exact_quantile(values.limit(0), ["g"], "v", "m").count() == 0


def test_sketches_by_day(spark):
    rng = random.Random(3)
    rows = [(d, s, rng.choice([0.0, 0.0, 0.0, rng.paretovariate(0.5)])) for d in range(10) for s in (1, 2) for _ in range(3000 if s == 1 else 40)] + [(1, 3, None)]
    df = spark.createDataFrame(rows, "day int, store int, v double").persist()
    days = sketches.daily(df, ["store", "day"], "v").persist()
    for q in (0.1, 0.5, 0.9):
        found = sketches.quantile(sketches.merged(days.where("day < 7"), ["store"]), "m", q)
        held = sketches.held_against(found, df.where("day < 7"), ["store"], "v", "m", q).collect()
        assert sorted(r.store for r in held) == [1, 2] and all(r.within for r in held)
        wrong = found.withColumn("m", F.lit(1e12))
        assert not any(r.within for r in sketches.held_against(wrong, df.where("day < 7"), ["store"], "v", "m", q).collect())
    twice = sketches.merged(sketches.merged(days, ["store", "day"]), ["store"])
    assert {r.store: r.n for r in twice.collect()} == {1: 30000, 2: 400}
