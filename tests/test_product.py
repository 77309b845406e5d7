"""Products over few keys: every pair once, dealt out evenly; and what the factors tell without them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfshare.operators import forecast, shares
from shelfshare.operators.product import Factored, product_join


@pytest.fixture(scope="module")
def sides(spark):
    sizes = {"a": (400, 30), "b": (3, 500), "c": (1, 1), "d": (50, 0), "e": (0, 7), None: (5, 5), "f": (1, 900)}
    left = [(k, i % 90) for k, (n, _) in sizes.items() for i in range(n)]  # some rows are there twice
    right = [(k, i, float(i)) for k, (_, n) in sizes.items() for i in range(n)]
    random.Random(1).shuffle(left)
    return spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, y int, z double")


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 24])
@pytest.mark.parametrize("per_task", [1, 100, 10**6])
def test_every_pair_once(sides, per_task, broadcast_bytes):
    if per_task == 1 and broadcast_bytes:
        per_task = 10
    left, right = (df.where("k <> 'a'") for df in sides) if per_task == 1 else sides
    got = product_join(left, right, ["k"], per_task, broadcast_bytes)
    want = left.join(right, "k")
    assert got.columns == want.columns and Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_tasks_are_even(spark):
    """One key with nearly all rows, neither side small: no task makes much more than it should."""
    left = spark.range(2000).select(F.when(F.col("id") < 1990, "hot").otherwise("cold").alias("k"), "id")
    right = spark.range(2000).select(F.when(F.col("id") < 1990, "hot").otherwise("cold").alias("k"), F.col("id").alias("other"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for bytes_ in (0, 1 << 24):
            rows = [r.n for r in product_join(left, right, ["k"], 100_000, bytes_).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(rows) == 1990**2 + 100
            assert max(rows) <= (6 if bytes_ == 0 else 2) * 100_000 and len(rows) >= 20
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_empty_sides(sides):
    left, right = sides
    for bytes_ in (0, 1 << 24):
        assert product_join(left.limit(0), right, ["k"], broadcast_bytes=bytes_).count() == 0 == product_join(left, right.limit(0), ["k"], broadcast_bytes=bytes_).count()


@pytest.fixture
def factored(spark, tmp_path):
    parts = spark.createDataFrame([("g", 1, 0.25), ("g", 2, 0.75), ("h", 1, 0.5), ("h", 3, -0.1)], "grp string, store long, share double")
    members = spark.createDataFrame([("g", 10, 4.0), ("g", 11, 2.0), ("h", 12, 8.0), ("none", 13, 1.0)], "grp string, sku long, daily double")
    Factored(parts, members).write(f"file://{tmp_path}/m")
    return Factored.read(spark, f"file://{tmp_path}/m")


def test_factors_tell_what_the_product_does(spark, factored, tmp_path):
    rows = factored.expand(per_task=3)
    assert rows.count() == factored.size().first().rows == 6
    sums = {r.sku: (round(r.s, 9), r.n) for r in rows.groupBy("sku").agg(F.sum("share").alias("s"), F.count("*").alias("n")).collect()}
    assert {r.sku: (round(r.share, 9), r.parts) for r in factored.member_totals(["share"]).collect() if r.parts} == sums
    weighed = {r.store: round(r.s, 9) for r in rows.groupBy("store").agg(F.sum(F.col("share") * F.col("daily")).alias("s")).collect()}
    assert {r.store: round(r.share, 9) for r in factored.part_totals(["share"], "daily").collect()} == weighed
    assert sorted(r.sku for r in factored.off_whole("share").collect()) == [12, 13]
    assert [r.store for r in factored.top_parts("share", 2).collect()] == [2, 1]
    assert factored.repeats().count() == 0
    again = Factored(factored.parts.unionByName(factored.parts.where("store = 3")), factored.members)
    assert [tuple(r) for r in again.repeats().collect()] == [("h", "3", 2)]
    factored.export(f"file://{tmp_path}/csv", 2)
    assert spark.read.csv(f"file://{tmp_path}/csv", sep=";", header=True).count() == 6
    assert all(len(p.read_text().splitlines()) <= 3 for p in (tmp_path / "csv").glob("part-*"))


def test_checks_on_factors(spark, factored):
    parts = factored.parts.unionByName(spark.createDataFrame([("g", 2, 0.1)], factored.parts.schema))
    members = factored.members.unionByName(spark.createDataFrame([("h", 12, 1.0), ("h", 14, -2.0), ("g", 15, 0.0)], factored.members.schema))
    for own in (factored, Factored(parts, factored.members), Factored(parts, members)):
        plain = lambda df: sorted((r.grp, r.sku, round(r.stores_sum, 9), r.negatives, r.doubled, round(r.covered_pct or 0, 6)) for r in df.collect())
        assert plain(forecast.check_factors(own)) == plain(forecast.checks(forecast.daily_forecast(own)))


def test_consolidated_factors(spark, factored):
    online = Factored(spark.createDataFrame([("g", 2, 0.5), ("g", 4, 0.5), ("h", 1, 1.0)], factored.parts.schema), spark.createDataFrame([("g", 10, 3.0), ("h", 10, 5.0), ("h", 16, 1.0)], factored.members.schema))
    rows = lambda f: forecast.daily_forecast(f)
    plain = lambda df: sorted((r.sku, r.store, r.key, round(r.offline, 9), round(r.online, 9), round(r.total, 9), round(r.offline_part, 9)) for r in df.collect())
    assert plain(forecast.consolidate_factors(factored, online)) == plain(forecast.consolidate(rows(factored), rows(online)))


def test_filled_factors(spark):
    stores = spark.createDataFrame([(1,), (2,), (2,)], "store long")
    skus = spark.createDataFrame([(10, "g"), (11, "h"), (12, None)], "sku long, grp string")
    found = spark.createDataFrame([("g", 1, 0.5), ("g", 1, 0.7), ("x", 2, 1.0), ("g", 9, 1.0)], "grp string, store long, share double")
    got = shares.fill_factors(stores, skus, found, ["share"]).expand().collect()
    assert sorted((r.sku, r.store, r.share) for r in got) == [(10, 1, 0.7), (10, 2, 0.0), (11, 1, 0.0), (11, 2, 0.0)]
