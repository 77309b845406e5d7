"""Cutting lineage, and running totals that no single task sums up."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. A local session without that setting gets a folder of its own; on a
    cluster executors would not see each other's files, so there it is an error."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not root:
        root = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


class Tables:
    """Tables that one computation writes to the shared folder: the lineage ends there, and lost executors lose nothing."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """df written as Parquet and read again. A table of the same name stays until drop() or the end."""
        path = scratch(self.spark, name)
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Removes tables that nothing will read any more."""
        for name in names:
            for path in self.paths.pop(name, []):
                remove(self.spark, path)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """df computed once and kept in the shared folder for as long as the driver's Python runs, so that two uses see the same rows."""
    return Tables(df.sparkSession).store(df, name)


#: A side is broadcast only when its measured size is below this; beyond it Spark shuffles both sides.
BROADCAST_BYTES = 16 << 20


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if its counted rows fit BROADCAST_BYTES; otherwise as it is. Use on stored tables."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


#: Rows that a task sorts or holds where a table is dealt out by its counted size.
TASK_ROWS = 1 << 18


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt out by keys in as many partitions as its rows ask for, so that a task's memory doesn't grow with the table,
    whatever spark.sql.shuffle.partitions says. rows: how many there are at most. What groups by these and more keys, or takes
    windows over them, stays in these partitions."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)), *keys)


def running_total(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """df with the sum of value over all rows up to this one in an order that no two rows share.

    Rows are dealt out in ranges of the order and summed up within each; a range's total is added to those after it. The
    ranges are stored first, since the two steps must see the same ones: so a job runs when this is called, not only when
    the result is read.
    """
    ranged = stored(df.withColumn("value_", value).repartitionByRange(*order).withColumn("range_", F.spark_partition_id()))
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    totals = ranged.groupBy("range_").agg(F.sum("value_").alias("total_")).select("range_", F.coalesce(F.sum("total_").over(before), F.lit(0)).alias("before_"))
    within = Window.partitionBy("range_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("within_", F.sum("value_").over(within)).join(F.broadcast(totals), "range_")
    return summed.withColumn(name, F.col("before_") + F.col("within_")).drop("range_", "value_", "within_", "before_")
