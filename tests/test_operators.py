"""Small frames by hand: worked examples and the edge cases of each operator."""

import datetime

import pytest
from pyspark.sql import functions as F

from shelfshare import functions as fn
from shelfshare.operators import cleaning, demand, export, forecast, metrics, panel, pilot, reports, shares
from shelfshare.sources import scans, sinks


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def test_normalise_worked_example(spark):
    df = spark.createDataFrame([(5356458, "OFFLINE", 1057, 25.5), (5356458, "OFFLINE", 2035, 20.0), (5356458, "ONLINE", 1057, 18.2), (5356458, "ONLINE", 2035, 15.8)], "sku long, channel string, store long, share double")
    got = {(r.channel, r.store): r.percent for r in export.normalise_to_100(df).collect()}
    assert got == {("OFFLINE", 1057): 56.044, ("OFFLINE", 2035): 43.956, ("ONLINE", 1057): 53.529, ("ONLINE", 2035): 46.471}


def test_normalise_zero_and_ties(spark):
    df = spark.createDataFrame([(1, "A", 2, 0.0), (1, "A", 1, 0.0), (2, "A", 3, 1.0), (2, "A", 1, 1.0), (2, "A", 2, 1.0)], "sku long, channel string, store long, share double")
    got = {(r.sku, r.store): r.percent for r in export.normalise_to_100(df).collect()}
    assert got == {(1, 1): 100.0, (1, 2): 0.0, (2, 1): 33.334, (2, 2): 33.333, (2, 3): 33.333}


def test_single_row_series_stays(spark):
    df = spark.createDataFrame([("g", 1, 5.0)], "grp string, store long, qty double")
    assert cleaning.winsorise(df).first().qty == 5.0
    assert cleaning.atypical_months(df.withColumn("year_month", F.lit(202401))).count() == 0


def test_month_of_calculation_stays(spark):
    months = spark.createDataFrame([("g", 202401), ("g", 202402)], "grp string, year_month int")
    df = spark.createDataFrame([("g", 202401, 1.0), ("g", 202402, 2.0), ("g", 202403, 3.0)], "grp string, year_month int, qty double")
    assert sorted(r.year_month for r in cleaning.filter_atypical_months(df, months, 202402).collect()) == [202402, 202403]


def test_robust_demand(spark):
    df = spark.createDataFrame([(1, 10.0, 9.0), (2, 10.0, 2.0), (3, 10.0, None), (4, None, None), (7, 10.0, 1.0)], "store long, qty double, delta double")
    got = {r.store: r.demand for r in demand.robust_demand(df, outlet=F.col("store") == 7).collect()}
    assert got == {1: 13.0, 2: 12.0, 3: 10.0, 4: 0.0, 7: 0.0}


def test_trimmed_mean_short_frame_is_plain(spark):
    df = spark.createDataFrame([("g", 1, day(i), float(i)) for i in range(5)], "grp string, store long, day date, demand double")
    got = demand.rolling_trimmed_mean(df, (3,)).orderBy("day").collect()
    assert [r.trimmed_3 for r in got] == [0.0, 0.5, 1.0, 1.5, 2.5]


def test_trimmed_mean_by_own_bounds(spark):
    values = [1.0] * 15 + [1000.0] + [1.0] * 4
    df = spark.createDataFrame([("g", 1, day(i), v) for i, v in enumerate(values)], "grp string, store long, day date, demand double")
    got = demand.rolling_trimmed_mean(df, (19,), alpha=0.1).orderBy("day").collect()
    assert got[-1].trimmed_19 == 1.0


def test_mirror_one_to_many(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "store long, x string")
    mirror = spark.createDataFrame([(1, 2), (1, 3)], "reference long, mirrored long")
    assert sorted(map(tuple, cleaning.mirror_stores(df, mirror).select("store", "x").collect())) == [(1, "a"), (2, "a"), (3, "a")]


def test_ids_and_groups(spark):
    df = spark.createDataFrame([("007", "PLACA", "110V"), (" 12 ", "X", None), ("0", None, "220V"), (None, "Y", "bivolt")], "id string, m string, v string")
    got = df.select(fn.normalised_id("id").alias("i"), fn.need_group("m", "v").alias("g")).collect()
    assert [tuple(r) for r in got] == [("7", "PLACA_110"), ("12", "X_"), ("0", "SEM_GN"), (None, "Y_biv")]


def test_codes_and_numbers(spark):
    df = spark.createDataFrame([(1057, "12,5", "PORTE 4"), (14, "x", "-")], "store long, t string, band string")
    got = df.select(fn.store_code(F.col("store"), F.col("store") == 14).alias("c"), fn.number_from_comma("t").alias("n"), fn.band_number("band").alias("b"), fn.band_weight("band").alias("w"), fn.comma_number(F.col("store") * 1.5).alias("k")).collect()
    assert [tuple(r) for r in got] == [("0021_01057", 12.5, 4, 6.0, "1585,50"), ("0099_00014", None, None, 1.0, "21,00")]
    assert got[0].c and df.select(fn.store_code(F.col("store"), F.lit(False)).alias("c")).select(fn.store_from_code("c").alias("s")).first().s == 1057


def test_store_without_centre(spark):
    df = spark.createDataFrame([(1, "10"), (2, None), (3, "14"), (4, "9")], "store long, dc string")
    got = dict(map(tuple, shares.dc_map(df, {"14": "1", "9": "0"}).collect()))
    assert got == {1: "10", 2: "SEM_CD", 3: "1"}


def test_zero_group_has_share_zero(spark):
    df = spark.createDataFrame([("g", 1, 0.0), ("g", 2, 0.0)], "grp string, store long, m double")
    stores = spark.createDataFrame([(1, "a"), (2, "b")], "store long, dc string")
    assert [r.dc_share for r in shares.dc_share(df, stores, "m").collect()] == [0.0, 0.0]
    assert [r.inner_m for r in shares.inner_share(df, stores, ["m"]).collect()] == [0.0, 0.0]


def test_smape_of_zeros(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.smape(F.col("a"), F.col("b"))).collect()] == [0.0, 200.0, 100.0]


def test_days_out_of_stock_do_not_count(spark):
    df = spark.createDataFrame([(1, 1, day(0), 4.0, 5), (1, 1, day(1), 100.0, 0), (1, 1, day(100), 6.0, 5)], "sku long, store long, day date, qty double, on_hand long")
    assert [r.mean_qty for r in panel.rolling_days(df, ["qty"]).orderBy("day").collect()] == [4.0, 4.0, 6.0]


def test_batches_and_lookback(spark):
    assert panel.batches(202311, 202403) == [(202311, 202401), (202402, 202403)]
    rows = [(day(-30), 1, 1, "S", 1, 9.0, 90.0), (day(5), 1, 1, "S", 1, 3.0, 30.0)]
    sales = spark.createDataFrame(rows, "day date, sku long, store long, mandatory string, on_hand long, qty double, revenue double")
    got = panel.period_panel(sales, 202401, 202401).collect()
    assert len(got) == 1 and got[0].mean_qty == 6.0 and got[0].delta == 5.0


def test_transfer_keeps_total(spark):
    df = spark.createDataFrame([(1, "g", 14, 0.2, True), (1, "g", 30, 0.3, True), (1, "g", 5, 0.5, False)], "sku long, grp string, store long, share double, is_dc boolean")
    valid = spark.createDataFrame([(14,)], "store long")
    got = {r.store: r.share for r in export.transfer_to_dc(df, valid, 14).collect()}
    assert got == {14: 0.5, 30: 0.0, 5: 0.5}


def test_reference_listed_twice(spark):
    df = spark.createDataFrame([(1,), (2,), (14,)], "store long")
    reference = spark.createDataFrame([(1, "LOJA"), (1, "CD")], "store long, kind string")
    got = {r.store: (r.eligible, r.is_dc) for r in export.eligibility(df, reference, [14]).collect()}
    assert got == {1: (True, True), 2: (False, False), 14: (True, True)}


def test_integrity_report_finds_each_rule(spark):
    df = spark.createDataFrame([(1, 1, "ONLINE", 60.0), (1, 1, "ONLINE", 30.0), (2, 1, "SHOP", 100.0)], "sku long, store long, channel string, percent double")
    assert {r.rule for r in export.integrity_report(df).collect()} == {"sum", "unique", "both_channels", "channel_name", "rows"}


def test_percent_shares_are_divided(spark):
    sold = spark.createDataFrame([("g", 1, 60.9, None)], "grp string, sku long, qty double, delta double")
    share = spark.createDataFrame([("g", 1, 25.0), ("g", 2, 75.0)], "grp string, store long, share double")
    got = {r.store: round(r.forecast, 6) for r in forecast.daily_forecast(forecast.daily_factors(sold, share, 71)).collect()}
    assert got == {1: 0.25, 2: 0.75}


def test_missing_channel_is_zero(spark):
    one = spark.createDataFrame([(1, 1, 2.0)], "sku long, store long, forecast double")
    other = spark.createDataFrame([(1, 2, 3.0)], "sku long, store long, forecast double")
    assert sorted((r.key, r.total, r.offline_part) for r in forecast.consolidate(one, other).collect()) == [("1-1", 2.0, 1.0), ("1-2", 3.0, 0.0)]


def test_did_by_hand(spark):
    rows = [("test", "baseline", 10.0), ("test", "pilot", 6.0), ("control", "baseline", 10.0), ("control", "pilot", 9.0)]
    df = spark.createDataFrame([(*r, 0, 0.0, 1.0) for r in rows], "arm string, period string, cover double, stockout int, lost_revenue double, revenue double")
    got = {r.kpi: r.did for r in pilot.difference_in_differences(df).collect()}
    assert got["median_cover"] == -3.0


def test_sunday_has_no_percentage(spark):
    df = spark.createDataFrame([(day(6), 10.0, 1.0), (day(7), 10.0, 1.0)], "day date, revenue double, lost_revenue double")
    got = {r.metric: r for r in pilot.daily_lost_revenue(df, ["2024-01-07", "2024-01-08"]).collect()}
    assert got["lost pct"]["2024-01-07"] is None and got["lost pct"]["2024-01-08"] == "10,00"


def test_running_share_drops_what_crosses(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 40.0), ("c", 10.0)], "k string, v double")
    assert [r.k for r in reports.running_share(df, "k", "v").collect()] == ["a"]


def test_metrics_of_equal_shares(spark):
    df = spark.createDataFrame([("g", 0.5, 0.5), ("g", 0.5, 0.5)], "g string, y double, h double")
    r = metrics.allocation_metrics(df, "y", "h", ["g"]).first()
    assert r.wmape == 0 and r.share_error == 0 and abs(r.divergence) < 1e-9


@pytest.mark.parametrize("f", [lambda e: cleaning.winsorise(e), lambda e: demand.robust_demand(e), lambda e: cleaning.atypical_months(e), lambda e: reports.running_share(e, "grp", "qty")])
def test_empty_input(spark, f):
    empty = spark.createDataFrame([], "grp string, store long, day date, year_month int, qty double, delta double")
    assert f(empty).count() == 0


def test_scans(spark):
    stock = spark.createDataFrame([(day(0), 1, 2, "L", "A", 4.0, 2.0, 3.0, 1.0, "S", "110V", "SEM_CD"), (day(0), 1, 2, "L", "A", 4.0, 2.0, 5.0, None, "S", "110V", "7"), (day(0), 1, 3, "D", "A", 4.0, 0.0, 3.0, 1.0, "S", None, "7")], "day date, sku long, store long, place string, status string, stock_value double, sales_cost double, stock_offline double, stock_online double, mandatory string, voltage string, dc string")
    assert [(r.store, r.on_hand, r.cover, r.dc) for r in scans.stock(stock).collect()] == [(2, 5.0, 2.0, 7)]
    assert sorted((r.store, r.on_hand, r.cover) for r in scans.stock(stock, ("L", "D"), online=True).collect()) == [(2, 5.0, 2.0), (3, 4.0, None)]
    facts = spark.createDataFrame([(1, day(0), 5, 1, "new", "shop", 10.0, 5.0), (2, day(0), 5, 0, "new", "web", 10.0, 5.0), (3, day(0), 5, 8, "new", "web", 10.0, 5.0), (4, day(0), 5, 1, "saldo", "shop", 1.0, 1.0)], "fact long, day date, sku long, store long, state string, business string, revenue double, cost double")
    quantity = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, 1.0)], "fact long, qty double")
    assert [r.store for r in scans.sales(facts, quantity, "2024-01-01", "2024-01-02").collect()] == [1]
    assert [r.store for r in scans.sales(facts, quantity, "2024-01-01", "2024-01-02", shop=False, moved={8: 9}).collect()] == [9]
    assert scans.mirror_csv(spark, None).count() == 0 and scans.matrices(spark, {"x": "no_such_table"}) is None


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "m.csv").write_text("CODIGO;CODIGO_FILIAL;PERCENTUAL_MATRIZ;CANAL;TIPO_FILIAL\n5;0021_01057;12,5;OFFLINE;LOJA\n5;0021_01057;12,5;OFFLINE;LOJA\n")
    assert [tuple(r) for r in scans.incumbent_csv(spark, f"file://{tmp_path}/m.csv").collect()] == [(5, 1057, 12.5)]
    (tmp_path / "g.csv").write_text(" Sku Loja ;Gêmeos\n1;a\n1;a\n;b\n", encoding="ISO-8859-1")
    got = scans.mapping_csv(spark, f"file://{tmp_path}/g.csv", "sku_loja")
    assert got.columns == ["sku_loja", "gêmeos"] and got.count() == 1
    df = spark.createDataFrame([(s, n, n / 8) for s in range(4) for n in range(3)], "sku long, n long, p double")
    sinks.export_by_key(df, f"file://{tmp_path}/k", "sku", 5, ["p"])
    back = spark.read.csv(f"file://{tmp_path}/k", sep=";", header=True)
    assert back.count() == 12 and back.groupBy("sku").agg(F.count_distinct("file_no").alias("f")).where("f > 1").count() == 0
    assert "0,125" in {r.p for r in back.collect()}
    sinks.export_parts(df, f"file://{tmp_path}/p", ["sku", "n"], ["p"], most=5)
    assert sorted(r["count"] for r in spark.read.csv(f"file://{tmp_path}/p", sep=";", header=True).groupBy("part").count().collect()) == [2, 5, 5]
    sinks.single_csv(df, f"file://{tmp_path}/s")
    assert len(list((tmp_path / "s").glob("part-*"))) == 1
