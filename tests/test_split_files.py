"""Files that many tasks write."""

from pyspark.sql import functions as F

from shelfshare.plans import source_plans
from shelfshare.sources import sinks

D = "/root/testdata/sf0.001"


def test_damaged_lines_are_written_by_all_tasks(spark, monkeypatch):
    """They went through one task."""
    monkeypatch.setattr(source_plans, "stored", lambda df, name: df.repartition(3))
    lines = spark.read.text(source_plans._damaged_csv(spark, D)).select(F.col("_metadata.file_path").alias("file"), "value")
    header = ";".join(f.source for f in source_plans._FIELDS)
    files = [r.n for r in lines.groupBy("file").agg(F.count_if(F.col("value") == header).alias("n")).collect()]
    assert sorted(files) == [0, 0, 0, 1, 1, 1]


def test_tasks_move_their_own_files(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), (F.col("id") / 8).alias("x"))
    sinks.split_writer(df).partitionBy("k").csv(f"file://{tmp_path}/a")
    assert spark.read.csv(f"file://{tmp_path}/a").count() == 100 and not list(tmp_path.glob("a/_temporary"))
