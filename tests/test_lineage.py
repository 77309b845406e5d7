"""Writers and running totals: rows in are rows out, whatever adaptive execution does to the partitions."""

import pytest
from pyspark.sql import functions as F

from shelfshare import functions as fn
from shelfshare.operators import export, forecast, lineage, panel, shares
from shelfshare.sources import sinks, versioned


@pytest.fixture
def coalescing(spark):
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_parts_have_every_row(spark, tmp_path, coalescing):
    """Wide rows, many partitions that are put together: every row in one part, in order."""
    df = spark.range(60_000).select(F.col("id"), (F.col("id") / 8).alias("p"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 6).alias("wide"))
    sinks.export_parts(df, f"file://{tmp_path}/p", ["id"], ["p"], most=7_000)
    back = spark.read.csv(f"file://{tmp_path}/p", sep=";", header=True).select(F.col("id").cast("long").alias("id"), "part")
    assert back.count() == 60_000 and back.select("id").distinct().count() == 60_000
    assert back.where("part <> id div 7000").count() == 0


def test_running_total(spark, coalescing):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit(2).alias("v"))
    got = lineage.running_total(df, [F.desc("k")], F.col("v"), "upto")
    assert got.columns == ["k", "v", "upto"] and got.count() == 5_000
    assert got.where("upto <> 2 * (5000 - k)").count() == 0
    assert lineage.running_total(df.limit(0), [F.asc("k")], F.col("v"), "upto").count() == 0


def test_files_are_numbered_alike(spark, coalescing):
    df = spark.range(3_000).select((F.col("id") % 100).alias("sku"), F.col("id").alias("store"))
    got = export.file_numbers(df, "sku", 250)
    assert got.count() == 3_000 and got.where("file_no <> sku * 30 div 250").count() == 0


def test_doubled_lists_change_nothing(spark):
    rows = spark.createDataFrame([(1, "g", 14, 0.2, True), (1, "g", 20, 0.3, True), (1, "g", 5, 0.5, False)], "sku long, grp string, store long, share double, is_dc boolean")
    twice = spark.createDataFrame([(14,), (14,), (20,), (20,)], "store long")
    assert {r.store: r.share for r in export.transfer_to_dc(rows, twice, 14).collect()} == {14: 0.2, 20: 0.3, 5: 0.5}
    frame = spark.createDataFrame([("g", 1, 7)], "grp string, store long, sku long")
    share = spark.createDataFrame([("g", 1, 0.4), ("g", 1, 0.6)], "grp string, store long, s double")
    assert [r.s for r in shares.fill_matrix(frame, share, ["s"]).collect()] == [0.6]


def test_layers_in_one_pass(spark):
    df = spark.createDataFrame([("g", 1, 1.0, 5.0), ("g", 2, 3.0, 0.0), ("g", 3, 4.0, 2.0), ("h", 1, 0.0, 0.0)], "grp string, store long, a double, b double")
    centre = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "store long, dc string")
    product = shares.final_share(shares.dc_share(df, centre, "a"), shares.inner_share(df, centre, ["a", "b"]), ["a", "b"])
    key = lambda r: (r.grp, r.store)
    assert sorted(shares.layered_share(df, centre, "a", ["a", "b"]).collect(), key=key) == sorted(product.collect(), key=key)


def test_share_without_windows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "k string, v double")
    assert sorted((r.k, r.s) for r in fn.with_share(df, {"s": "v"}, ["k"], 100).collect()) == [("a", 25.0), ("a", 75.0), ("b", 0.0)]


def test_backfill_is_repeatable(spark, tmp_path):
    import datetime

    day = lambda m, n: datetime.date(2024, m, n)
    rows = [(day(m, n), 1, 1, "S", 1, float(m), 10.0) for m in (1, 2, 3, 4) for n in (3, 20)]
    sold = spark.createDataFrame(rows, "day date, sku long, store long, mandatory string, on_hand long, qty double, revenue double")
    path = f"file://{tmp_path}/panel"
    for _ in range(2):
        assert panel.backfill(sold, 202402, 202404, lambda part, start, end: versioned.replace_period(part, path, start, end), size=2) == [(202402, 202403), (202404, 202404)]
    got = {r.day: r.mean_qty for r in versioned.read(spark, path).collect()}
    assert len(got) == 6 and got[day(2, 3)] == pytest.approx((1 + 1 + 2) / 3)


def test_delivery(spark):
    df = spark.createDataFrame([(s,) for s in (1, 2, 3, 14, 9)], "store long")
    plan = spark.createDataFrame([(1, 3), (2, None), (14, None)], "store long, delivery long")
    assert {r.store: r.delivery for r in forecast.with_delivery_centre(df, plan).collect()} == {1: 3, 3: 3, 14: 14}


def test_orders_and_names(spark):
    df = spark.createDataFrame([("b",), ("z",), ("a",)], "r string")
    assert [r.r for r in df.orderBy(fn.in_order("r", ["b", "a"])).collect()] == ["b", "a", "z"]
    assert fn.suffixed(df.withColumn("x", F.lit(1)), ["r"], "_new", "p_").columns == ["r", "p_x_new"]
