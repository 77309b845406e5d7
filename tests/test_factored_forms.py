"""Forms that work on factors before there are rows, held against those that work on the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfshare.operators import forecast, shares
from shelfshare.operators.product import Factored, product_join
from shelfshare.sources import sinks


def rounded(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r) for r in df.collect())


def factors(spark):
    parts = spark.createDataFrame([("g", 1, 0.25), ("g", 2, 0.75), ("g", 2, -0.75), ("h", 1, 0.5), ("h", 3, -0.1)], "grp string, store long, share double")
    members = spark.createDataFrame([("g", 10, 4.0), ("g", 11, 2.0), ("h", 11, 8.0), ("h", 11, 1.0), ("none", 13, 1.0)], "grp string, sku long, daily double")
    return Factored(parts, members)


def test_skeleton_is_dealt_out(spark):
    """It used to have as many tasks as the skus' one file."""
    stores = spark.range(3000).select((F.col("id") % 1500).alias("store"))
    skus = spark.range(2000).select(F.col("id").alias("sku"), F.lit("g").alias("grp")).coalesce(1)
    rows = shares.skeleton(stores, skus)
    assert rows.columns == ["store", "sku", "grp"]
    tasks = [r.n for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 1500 * 2000 and len(tasks) == 3


def test_large_products_have_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr("shelfshare.operators.product.PER_TASK", 100)
    monkeypatch.setattr("shelfshare.operators.product.MOST_PER_TASK", 50_000)
    left, right = spark.range(1000).select(F.lit(1).alias("k"), "id"), spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("other"))
    assert product_join(left, right, ["k"]).rdd.getNumPartitions() == 8 * spark.sparkContext.defaultParallelism  # not 10,000


def test_checks_of_rows_put_together_before(spark):
    f = factors(spark)
    want = rounded(forecast.checks(forecast.daily_forecast(f)))
    for bytes_ in (0, 1 << 24):
        assert rounded(forecast.check_rows(f, bytes_)) == want


def test_categories_of_factors(spark):
    f = factors(spark)
    rows = forecast.daily_forecast(f)
    half = Factored(f.parts.where("store = 1"), f.members)
    both = Factored(f.parts.unionByName(f.parts.where("store = 1")), f.members)
    want = forecast.union_categories({"a": forecast.daily_forecast(half), "b": rows.unionByName(rows.where("store = 1"))})
    assert rounded(forecast.union_factors({"a": half, "b": both})) == rounded(want)


def test_consolidation_meets_only_skus_of_several_groups(spark):
    f = factors(spark)
    off = Factored(f.parts.where("share > 0"), f.members.groupBy("grp", "sku").agg(F.sum("daily").alias("daily")))
    on = Factored(off.parts.where("store < 3"), off.members.where("sku <> 10"))
    want = rounded(forecast.consolidate(forecast.daily_forecast(off), forecast.daily_forecast(on)))
    for bytes_ in (0, 1 << 24):
        assert rounded(forecast.consolidate_factors(off, on, bytes_)) == want
    single = Factored(off.parts, off.members.where("sku <> 11"))
    plan = forecast.consolidate_factors(single, single)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1  # rows of the product were joined with the list of such skus


def test_extra_shipment_sums_before_it_spreads(spark):
    cells = [("g", 1, 7, "OFFLINE", 0.5), ("g", 1, 7, "ONLINE", 0.2), ("g", 2, 7, "OFFLINE", 0.3), ("g", 3, None, "ONLINE", 0.8), ("g", 4, None, "OFFLINE", 0.2), ("h", 1, 7, "ONLINE", 1.0)]
    per = spark.createDataFrame(cells, "grp string, store long, dc int, channel string, share double")
    extra = spark.createDataFrame([(10, "g", 100.0), (10, "h", 3.0), (11, "g", 5.0), (12, "x", 1.0)], "sku long, grp string, pieces double")
    plain = forecast.blended(per).join(extra, "grp").withColumn("sent", F.col("pieces") * F.col("share"))
    want = plain.select("sku", "grp", "store", "dc", "share", "sent", F.sum("sent").over(Window.partitionBy("sku", "dc")).alias("dc_sent"))
    got = forecast.extra_shipment(per, extra)
    assert got.columns == want.columns and rounded(got) == rounded(want)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()  # rows of stores go through none


def test_percentages_of_many_stores(spark):
    """Each below 1, as there are many stores; together they are 100."""
    sold = spark.createDataFrame([("g", 10, 7.0, None)], "grp string, sku long, qty double, delta double")
    percent = spark.range(200).select(F.lit("g").alias("grp"), F.col("id").alias("store"), F.lit(0.5).alias("share"))
    assert {r.share for r in forecast.daily_factors(sold, percent, 7).parts.collect()} == {0.005}
    fractions = percent.withColumn("share", F.col("share") / 100)
    assert {r.share for r in forecast.daily_factors(sold, fractions, 7).parts.collect()} == {0.005}


def test_large_numbers_are_written_out(spark, tmp_path):
    df = spark.createDataFrame([("a", 12345678.0), ("b", -98765432.5), ("c", 0.25), ("d", None), ("e", 1e15)], "k string, qty double")
    sinks.single_csv(df, f"file://{tmp_path}/r")
    assert {r.k: r.qty for r in spark.read.csv(f"file://{tmp_path}/r", header=True).collect()} == {"a": "12345678.0", "b": "-98765432.5", "c": "0.25", "d": None, "e": "1000000000000000.0"}


def test_exports_can_be_compressed(spark, tmp_path):
    f = factors(spark)
    rows = lambda df: sorted(tuple(r) for r in df.select("grp", "sku", "store", "daily", "share").collect())
    f.export(f"file://{tmp_path}/z", 3, "gzip")
    assert list((tmp_path / "z").glob("part-*.csv.gz")) and not list((tmp_path / "z").glob("part-*.csv"))
    want = [tuple(str(x) for x in r) for r in rows(f.expand())]
    assert rows(spark.read.csv(f"file://{tmp_path}/z", sep=";", header=True)) == sorted(want)
