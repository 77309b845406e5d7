"""The sparse panel, distinct counts by bitmaps, and text files with damaged lines."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfshare.operators import bitmaps, reports, sparse
from shelfshare.operators.lineage import stored
from shelfshare.sources import checked

DAY = datetime.date(2024, 1, 1)


def at(n):
    return DAY + datetime.timedelta(n)


def test_means_over_zero_days(spark):
    rng = random.Random(1)
    data = {k: {d: float(rng.randint(0, 9)) for d in rng.sample(range(60), n)} for k, n in (("a", 7), ("b", 1), ("c", 60))}
    daily = spark.createDataFrame([(k, at(d), v) for k, own in data.items() for d, v in own.items()] + [("n", at(4), None)], "k string, day date, qty double")
    runs = sparse.runs(daily, ["k"], ["qty"], at(59).isoformat())
    assert runs.count() == 7 + 1 + 60 + 1
    full = {(r.k, (r.day - DAY).days): (r.qty, r.sold) for r in sparse.dense(runs, ["k"], ["qty"], DAY.isoformat()).collect()}
    assert full == {(k, d): (data.get(k, {4: 0.0}).get(d, 0.0), int(d in data.get(k, {4: 0.0}))) for k in "abcn" for d in range(60)}
    asked = [(k, d) for k in "abc" for d in range(60)] + [("a", 5), ("nobody", 30)]
    got = sorted((r.k, (r.day - DAY).days, round(r.mean_qty, 9), round(r.coverage, 9)) for r in sparse.over_last_days(runs, spark.createDataFrame([(k, at(d)) for k, d in asked], "k string, day date"), ["k"], ["qty"], 10, DAY.isoformat()).collect())

    def slow(k, d):
        span = range(max(0, d - 9), d + 1)
        own = data.get(k, {})
        return k, d, round(sum(own.get(x, 0.0) for x in span) / len(span), 9), round(sum(x in own for x in span) / len(span), 9)

    assert got == sorted(slow(k, d) for k, d in asked)
    assert sparse.over_last_days(runs, spark.createDataFrame([], "k string, day date"), ["k"], ["qty"], 10, DAY.isoformat()).count() == 0


def test_distinct_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randint(1, 5), rng.choice([None, 0, -3, 5, 70_000, rng.randint(1, 200_000)]), rng.choice([None, "x", "y", "z" * rng.randint(1, 9)])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, day int, id long, name string")
    days = bitmaps.daily(df, ["g", "day"], "id")
    for keys in (["g", "day"], ["g"]):
        want = {tuple(r)[:-1]: r.n for r in df.groupBy(*keys).agg(F.count_distinct("id").alias("n")).collect()}
        assert {tuple(r)[:-1]: r.n for r in bitmaps.counts(bitmaps.merged(days, keys), keys, "n").collect()} == want
    codes = stored(bitmaps.numbers(df, "name"))
    assert sorted(r.code for r in codes.collect()) == list(range(1, df.select("name").where("name is not null").distinct().count() + 1))
    named = bitmaps.counts(bitmaps.merged(bitmaps.daily(df, ["g", "day"], "name", codes), ["g"]), ["g"], "n")
    assert {r.g: r.n for r in named.collect()} == {r.g: r.n for r in df.groupBy("g").agg(F.count_distinct("name").alias("n")).collect()}
    assert bitmaps.counts(bitmaps.daily(df.limit(0), ["g"], "id"), ["g"], "n").count() == 0


def test_report_without_expand(spark):
    df = spark.createDataFrame([("a", 1, 1, 2.0, 1.0), ("a", 2, 1, 3.0, 1.0), (None, 1, 4, 5.0, 1.0), ("c", None, None, 0.0, 0.0)], "g string, sku long, store long, revenue double, qty double")
    got = reports.revenue_by(df, "g")
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.g: (r.revenue, r.skus, r.stores, r.per_sku) for r in got.collect()} == {"a": (5.0, 2, 1, 2.5), None: (5.0, 1, 1, 5.0), "c": (0.0, 0, 0, None)}


FIELDS = [checked.Field("id", "sku", checked.whole_number, True), checked.Field("part", "share", checked.comma_decimal), checked.Field("note", "note")]


def test_damaged_lines(spark, tmp_path):
    (tmp_path / "good.csv").write_text('id;part;note\n1;0,5;x\n 2 ;;\n1;0,5;x\n3;1,25;"a;b"\n\n  \nid;part;note\n')
    (tmp_path / "bad.csv").write_text("id;part;note\nx;0,5;y\n;1;y\n5;half;y\n6;1\n7;1;2;3\n8;9;z\n")
    (tmp_path / "headless.csv").write_text("id;share;note\n9;1;y\n")
    good, rejected = checked.split(spark, f"file://{tmp_path}", FIELDS)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([(1, 0.5, "x"), (1, 0.5, "x"), (2, None, None), (3, 1.25, "a;b"), (8, 9.0, "z")], key=str)
    assert sorted(map(tuple, rejected.collect())) == sorted([
        ("bad.csv", "x;0,5;y", "value: id"), ("bad.csv", ";1;y", "missing: id"), ("bad.csv", "5;half;y", "value: part"), ("bad.csv", "6;1", "columns"), ("bad.csv", "7;1;2;3", "columns"),
        ("headless.csv", "id;share;note", "header"), ("headless.csv", "9;1;y", "header"),
    ])
    lines = spark.read.text(f"file://{tmp_path}").where("trim(value) not in ('', 'id;part;note')").count()
    assert good.count() + rejected.count() == lines


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    good, rejected = checked.split(spark, f"file://{tmp_path}", FIELDS)
    assert good.count() == rejected.count() == 0 and good.columns == ["sku", "share", "note"]
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        checked.split(spark, f"file://{tmp_path}/none", FIELDS)
