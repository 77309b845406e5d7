"""The queries that leave nothing out, held against what the tables have."""

import duckdb

from shelfshare.operators import reports
from shelfshare.plans import QUERIES

D = "/root/testdata/sf0.001"


def one(sql):
    return duckdb.sql(sql.replace("$D", D)).fetchall()


def test_forecast_has_every_sku(spark):
    sold = {r[0] for r in one("SELECT DISTINCT l_partkey FROM '$D/lineitem.parquet' WHERE l_returnflag <> 'R' AND year(l_shipdate) = 1998")}
    assert len({k % 10 for k in sold}) == 10
    assert {r.sku for r in QUERIES["daily_forecast_full"](spark, D).select("sku").collect()} == sold
    assert {r.sku for r in QUERIES["forecast_consolidation_full"](spark, D).select("sku").collect()} == sold
    assert {r.sku for r in QUERIES["forecast_checks_full"](spark, D).select("sku").collect()} == sold


def test_matrix_has_every_category(spark):
    want = set(one("SELECT p_brand, p_partkey FROM '$D/part.parquet' WHERE p_size % 2 = 0"))
    got = QUERIES["matrix_full"](spark, D)
    assert len({k for k, _ in want}) == 25
    assert {(r.category, r.sku) for r in got.select("category", "sku").collect()} == want
    assert got.count() == len(want) * one("SELECT count(*) FROM '$D/supplier.parquet'")[0][0]


def test_every_day_and_month(spark):
    days = {r[0] for r in one("SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) FROM '$D/lineitem.parquet' WHERE l_returnflag <> 'R' AND year(l_shipdate) >= 1998")}
    got = QUERIES["daily_lost_revenue_full"](spark, D).collect()
    assert {r.day for r in got} == days and len(got) == 3 * len(days) > 9
    months = {r[0] for r in one("SELECT DISTINCT year(l_shipdate) * 100 + month(l_shipdate) FROM '$D/lineitem.parquet' WHERE l_returnflag <> 'R'")}
    for name in ("monthly_share_full", "monthly_share_by_group"):
        assert {r.year_month for r in QUERIES[name](spark, D).collect()} == months and len(months) > 3


def test_months_without_sales_are_zero(spark):
    df = spark.createDataFrame([("g", "A", 1, 3.0), ("g", "B", 1, 1.0), ("g", "A", 2, 2.0), ("h", "C", 3, 5.0)], "grp string, band string, year_month int, qty double")
    got = {(r.grp, r.band, r.year_month): (r.qty, r.pct) for r in reports.month_rows(df, "band", "qty", ["grp"]).collect()}
    assert got == {("g", "A", 1): (3.0, 75.0), ("g", "B", 1): (1.0, 25.0), ("g", "A", 2): (2.0, 100.0), ("g", "B", 2): (0.0, 0.0), ("h", "C", 3): (5.0, 100.0)}
