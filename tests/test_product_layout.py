"""Products come in an order in which files of them stay small."""

import pytest
from pyspark.sql import functions as F

from shelfshare.operators import forecast, shares
from shelfshare.operators.product import Factored, product_join


def bytes_a_row(df, path):
    df.write.parquet(f"file://{path}")
    return sum(p.stat().st_size for p in path.glob("*.parquet")) / df.sparkSession.read.parquet(f"file://{path}").count()


@pytest.fixture(scope="module")
def factors(spark):
    """Three groups of 700 skus and 1,000 stores, shares in no order."""
    mixed = lambda n, m: F.pmod(F.xxhash64("id"), F.lit(n)) / m
    parts = spark.range(3000).repartition(3).select((F.col("id") % 3).cast("string").alias("grp"), F.floor(F.col("id") / 3).alias("store"), mixed(40, 1e4).alias("share"))
    members = spark.range(2100).repartition(3).select((F.col("id") % 3).cast("string").alias("grp"), "id", mixed(90, 7).alias("daily")).withColumnRenamed("id", "sku")
    return Factored(parts, members)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 24])
def test_forecast_rows_take_less_than_a_byte(factors, tmp_path, broadcast_bytes):
    rows = forecast.daily_forecast(factors, broadcast_bytes)
    assert bytes_a_row(rows.withColumn("forecast", F.round("forecast", 6)), tmp_path / "f") < 0.8


def test_categories_and_skeleton_take_less_than_a_byte(spark, factors, tmp_path):
    half = Factored(factors.parts.where("store < 500"), factors.members)
    assert bytes_a_row(forecast.union_factors({"a": half, "b": factors}), tmp_path / "c") < 0.8
    stores = factors.parts.select("store")
    assert bytes_a_row(shares.skeleton(stores, factors.members.select("sku", "grp")), tmp_path / "s") < 0.3


def test_shipments_take_less_than_a_byte(spark, factors, tmp_path):
    cells = factors.parts.select("grp", "store", (F.col("store") % 5).cast("int").alias("dc"), F.lit("ONLINE").alias("channel"), "share")
    extra = factors.members.select("sku", "grp", F.lit(107.0).alias("pieces"))
    assert bytes_a_row(forecast.extra_shipment(cells, extra), tmp_path / "x") < 0.8


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 24])
def test_blocks_lose_and_double_nothing(spark, broadcast_bytes):
    """Many blocks of each side, with blocks that two keys share, in several ranges."""
    left = spark.range(3000).select(F.when(F.col("id") < 2500, 1).otherwise(2).alias("k"), "id")
    right = spark.range(900).select((F.col("id") % 3).cast("int").alias("k"), F.col("id").alias("other"), (F.col("id") % 7).alias("z"))
    got = product_join(left, right, ["k"], 200_000, broadcast_bytes).cache()
    assert got.count() == 3000 * 300 == got.distinct().count()
    assert got.where("other % 3 <> k or (id < 2500) <> (k = 1) or z <> other % 7").count() == 0


def test_checks_make_equal_rows_once(spark, factors, monkeypatch):
    """The rows of a sku used to be as many as its group's stores."""
    parts = factors.parts.unionByName(factors.parts.where("store % 400 = 7").withColumn("share", F.lit(-0.03)))
    members = factors.members.unionByName(factors.members.where("sku % 300 = 1").withColumn("daily", -F.col("daily")))
    own, made = Factored(parts, members), []
    monkeypatch.setattr(forecast, "product_join", lambda *a, **k: made.append(product_join(*a, **k)) or made[-1])
    plain = lambda df: sorted((r.grp, r.sku, round(r.stores_sum, 9), r.sku_daily, r.negatives, r.doubled, round(r.covered_pct or 0, 6)) for r in df.collect())
    got = forecast.check_rows(own)
    want = forecast.checks(Factored(parts, members).expand().withColumn("forecast", F.col("daily") * F.col("share")))
    assert got.dtypes == want.dtypes and plain(got) == plain(want)
    assert sum(r.negatives > 0 for r in got.collect()) > 2000 and sum(r.doubled == 1000 for r in got.collect()) == 7
    assert made[0].count() < 2100 * 60


def test_exports_have_no_task_for_each_file(spark, factors, tmp_path):
    """Small files of a large product used to be a task each; and the lines have the same text as the product's values."""
    own = Factored(factors.parts.where("store < 30").withColumn("other", F.col("share") / 3), factors.members)
    own.export(f"file://{tmp_path}/z", 1000, "gzip")
    files = [p.name for p in (tmp_path / "z").glob("part-*.csv.gz")]
    assert len(files) >= 63 and len({n.split("-")[1] for n in files}) < 10
    got = spark.read.csv(f"file://{tmp_path}/z", sep=";", header=True)
    assert got.columns == ["grp", "sku", "daily", "store", "share", "other"]
    assert got.groupBy(F.input_file_name()).count().where("count > 1000").count() == 0
    want = own.expand().select(*[F.col(c).cast("string") for c in got.columns])
    assert got.count() == 63_000 and got.exceptAll(want).count() == 0
