"""Tables are dealt out by their counted size: a task has as many rows however large the table, and shuffle partitions few."""

import pytest

from shelfshare.operators import bitmaps, lineage
from shelfshare.plans import QUERIES, base
from shelfshare.sources import export_set

D = "/root/testdata/sf0.001"


@pytest.fixture
def small_tasks(spark, monkeypatch):
    monkeypatch.setattr(lineage, "TASK_ROWS", 500)
    return -(-base.line_count(spark, D) // 500)


@pytest.mark.parametrize("name", ["rolling_mean_days", "stockout_block", "mirror_stores", "integrity_report", "integrity_report_damaged", "tolerance_check_damaged", "tolerance_check_centres"])
def test_partitions_follow_the_input(spark, small_tasks, name):
    assert small_tasks > 8
    assert QUERIES[name](spark, D).rdd.getNumPartitions() >= small_tasks


def test_bitmaps_are_made_where_rows_met(spark, small_tasks):
    s = base.sales(spark, D)
    days = bitmaps.daily(s, ["grp", "day"], "sku", rows=base.line_count(spark, D))
    assert days.rdd.getNumPartitions() == small_tasks
    assert days.count() == days.select("grp", "day", "bucket").distinct().count()


def test_export_rows_are_dealt_by_count(spark, small_tasks, monkeypatch, tmp_path):
    asked = []
    monkeypatch.setattr(export_set, "dealt", lambda df, rows, *keys: asked.append((rows, keys)) or lineage.dealt(df, rows, *keys))
    rows = spark.range(3000).selectExpr("if(id % 2 = 0, 'a', 'b') AS category", "cast(id div 3 AS string) AS SKU", "'ONLINE' AS CANAL", "'0021_00001' AS LOJA", "19991231 AS `DATA FIM`", "1.5D AS PERCENTUAL")
    total = export_set.write(rows, f"file://{tmp_path}/set", 100)
    assert asked == [(3000, ("category", "SKU")), (3000, ("category", "file_no"))]
    assert total["rows"] == 3000 and export_set.read(spark, f"file://{tmp_path}/set").count() == 3000
