"""A table in versions: periods of days, failed and overtaken writers, clearing up."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from shelfshare.sources import versioned

DAY = datetime.date(2024, 1, 1)


def rows(spark, first, last, x):
    return spark.createDataFrame([(DAY + datetime.timedelta(i), x) for i in range(first, last + 1)], "day date, x long")


def read(spark, root, **bounds):
    return sorted(((r.day - DAY).days, r.x) for r in versioned.read(spark, root, **bounds).collect())


@pytest.fixture
def root(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    versioned.replace_period(rows(spark, 0, 59, 1), path, "2024-01-01", "2024-02-29")
    return path


def test_other_days_of_a_month_stay(spark, root):
    versioned.replace_period(rows(spark, 15, 35, 2), root, "2024-01-16", "2024-02-05")
    assert read(spark, root) == [(i, 2 if 15 <= i <= 35 else 1) for i in range(60)]
    assert read(spark, root, number=1) == [(i, 1) for i in range(60)]
    assert read(spark, root, start="2024-01-10", end="2024-01-17") == [(i, 2 if i >= 15 else 1) for i in range(9, 17)]
    assert read(spark, root, start="2024-02-20") == [(i, 1) for i in range(50, 60)]


def test_empty_and_repeated_rows(spark, root):
    versioned.replace_period(spark.createDataFrame([], "x long, day date"), root, "2024-01-01", "2024-02-28")
    assert read(spark, root) == [(59, 1)]
    again = rows(spark, 3, 3, 7)
    versioned.replace_period(again.unionByName(again), root, "2024-01-01", "2024-01-31")
    assert read(spark, root) == [(3, 7), (3, 7), (59, 1)]
    fresh = root + "-empty"
    versioned.replace_period(spark.createDataFrame([], "day date, x long"), fresh, "2024-01-01", "2024-01-31")
    assert read(spark, fresh) == []
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, root + "-none")


def test_untouched_months_are_not_read_or_written(spark, root):
    before = versioned.current(spark, root).parts
    after = versioned.replace_period(rows(spark, 31, 40, 3), root, "2024-02-01", "2024-02-10").parts
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"]
    files = versioned.read(spark, root, start="2024-02-01", end="2024-02-03").inputFiles()
    assert files and all("2024-02" in f for f in files)


def test_a_write_that_fails_leaves_the_old_version(spark, root):
    broken = rows(spark, 15, 20, 2).withColumn("x", F.when(F.col("day") == "2024-01-21", F.raise_error(F.lit("killed"))).otherwise(F.col("x")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        versioned.replace_period(broken, root, "2024-01-16", "2024-01-21")
    for wrong in (rows(spark, 14, 20, 2), rows(spark, 16, 17, 2).withColumn("day", F.lit(None).cast("date"))):
        with pytest.raises(Exception, match="outside 2024-01-16"):
            versioned.replace_period(wrong, root, "2024-01-16", "2024-01-21")
    with pytest.raises(ValueError, match="columns differ"):
        versioned.replace_period(rows(spark, 16, 17, 2).withColumn("y", F.lit(1)), root, "2024-01-16", "2024-01-21")
    assert read(spark, root) == [(i, 1) for i in range(60)] and versioned.current(spark, root).number == 1


def test_a_writer_that_dies_before_it_publishes(spark, root, monkeypatch):
    held = versioned.read(spark, root)

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versioned, "_publish", dies)
        with pytest.raises(KeyboardInterrupt):
            versioned.replace_period(rows(spark, 0, 30, 9), root, "2024-01-01", "2024-01-31")
    folder = root.removeprefix("file://") + "/parts"
    assert read(spark, root) == [(i, 1) for i in range(60)] and len(os.listdir(folder)) == 2
    assert versioned.vacuum(spark, root) == 1 and len(os.listdir(folder)) == 1
    assert held.count() == 60


def test_an_overtaken_writer_is_refused(spark, root, monkeypatch):
    publish = versioned._publish

    def late(files, where, version):
        with monkeypatch.context() as m:
            m.setattr(versioned, "_publish", publish)
            versioned.replace_period(rows(spark, 0, 0, 5), root, "2024-01-01", "2024-01-01")
        return publish(files, where, version)

    with monkeypatch.context() as m:
        m.setattr(versioned, "_publish", late)
        with pytest.raises(versioned.Overtaken):
            versioned.replace_period(rows(spark, 1, 1, 6), root, "2024-01-02", "2024-01-02")
    assert read(spark, root)[:3] == [(0, 5), (1, 1), (2, 1)]
    versioned.replace_period(rows(spark, 1, 1, 6), root, "2024-01-02", "2024-01-02")
    assert read(spark, root)[:3] == [(0, 5), (1, 6), (2, 1)]
    assert versioned.vacuum(spark, root, keep=1) > 0 and read(spark, root)[:3] == [(0, 5), (1, 6), (2, 1)]


def test_rows_without_a_day_stay(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    versioned.replace_period(rows(spark, 0, 3, 1), path, "2024-01-01", "2024-01-31")
    old = versioned.current(spark, path)
    spark.createDataFrame([(None, 8)], "day date, x long").withColumn(versioned.PART, F.lit(versioned.NO_DAY)).write.partitionBy(versioned.PART).parquet(f"{path}/parts/loose")
    files = versioned._Files(spark, path)
    versioned._publish(files, path, versioned.Version(2, old.schema, old.parts | {versioned.NO_DAY: f"parts/loose/{versioned.PART}={versioned.NO_DAY}"}))
    versioned.replace_period(rows(spark, 0, 1, 2), path, "2024-01-01", "2024-01-02")
    assert sorted((r.x, r.day is None) for r in versioned.read(spark, path).collect()) == [(1, False), (1, False), (2, False), (2, False), (8, True)]
