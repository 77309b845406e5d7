"""Tables laid out by day: what a scan opens."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfshare.sources import layout

DAY = datetime.date(2024, 3, 1)


@pytest.fixture
def path(spark, tmp_path):
    rows = [(DAY + datetime.timedelta(d), c, d * 10 + i) for d in range(6) for c in "abc" for i in range(4)]
    where = f"file://{tmp_path}/t"
    layout.write(spark.createDataFrame(rows, "day date, category string, x long"), where, ["category"])
    return where


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def opened(df):
    """The days whose files the scan of df would open."""
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles()}


def test_newest_day_is_read_off_the_names(spark, path):
    got = layout.newest(spark, path)
    text = plan(got)
    assert "PartitionFilters: [isnotnull(day" in text and "2024-03-06" in text
    assert sorted(r.x for r in got.collect()) == sorted(5 * 10 + i for _ in "abc" for i in range(4))
    scan = got._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1 and scan.metrics().apply("numPartitions").value() == 1
    assert layout.days(spark, path) == [(DAY + datetime.timedelta(d)).isoformat() for d in range(6)]


def test_filters_reach_the_scan(spark, path):
    rows = layout.since(spark, path, "2024-03-03", "2024-03-04").where("category = 'b'")
    text = plan(rows)
    assert "PushedFilters: [IsNotNull(category), EqualTo(category,b)]" in text and "PartitionFilters: [isnotnull(day" in text
    assert sorted(r.x for r in rows.collect()) == [20, 21, 22, 23, 30, 31, 32, 33]
    assert rows._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value() == 2


def test_a_join_prunes_folders(spark, path):
    spark.createDataFrame([(DAY + datetime.timedelta(d), "promo" if d == 2 else "plain") for d in range(6)], "day date, kind string").write.parquet(f"{path}-calendar")
    calendar = spark.read.parquet(f"{path}-calendar")
    got = layout.of_days(spark, path, calendar.where("kind = 'promo'"))
    assert "dynamicpruning" in plan(got).lower()
    assert {r.day for r in got.collect()} == {DAY + datetime.timedelta(2)}


def test_days_are_replaced_as_wholes(spark, path):
    layout.write(spark.createDataFrame([(DAY, "z", 1)], "day date, category string, x long"), path, ["category"], files=3)
    assert [tuple(r) for r in layout.since(spark, path, "2024-03-01", "2024-03-01").select("category", "x").collect()] == [("z", 1)]
    assert layout.read(spark, path).count() == 5 * 12 + 1
    with pytest.raises(Exception, match="a row has no day"):
        layout.write(spark.createDataFrame([(None, "z", 1)], "day date, category string, x long"), path, ["category"])


def test_rows_of_a_category_lie_together(spark, path):
    order = [r.category for r in layout.newest(spark, path).select("category", F.monotonically_increasing_id().alias("n")).orderBy("n").collect()]
    assert order == sorted(order)


def test_months(spark, tmp_path):
    where = f"file://{tmp_path}/m"
    rows = [(DAY + datetime.timedelta(d), c, d) for d in range(0, 90, 7) for c in "ab"]
    layout.write(spark.createDataFrame(rows, "day date, category string, x long"), where, ["category"], by=layout.MONTH)
    got = layout.newest(spark, where)
    assert got.columns == ["day", "category", "x"] and sorted(r.x for r in got.collect()) == [84, 84]
    assert "PartitionFilters: [isnotnull(month_" in plan(got) and "2024-05" in plan(got)
    part = layout.since(spark, where, "2024-03-20", "2024-04-10")
    assert sorted({(r.day - DAY).days for r in part.collect()}) == [21, 28, 35] and "PartitionFilters: [isnotnull(month_" in plan(part)
    assert layout.read(spark, where).count() == len(rows)
