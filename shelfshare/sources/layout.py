"""Tables laid out by day or by month: a folder each, rows of a category side by side in its files, so that scans open few of them.

The newest day is read off the folders' names, without opening a file; of a table by month the newest folder alone is looked
through. A filter on days becomes a partition filter; one on the category skips row groups by their statistics; a join with
a table of days prunes folders while it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import small
from .versioned import _Files

DAY, MONTH = "day", "month_"


def write(df: DataFrame, path: str, cluster: list[str], files: int = 1, by: str = DAY) -> None:
    """df by day, or by month where days are many and small (a date column `day`, not null). A folder's rows go to `files` files
    at most, dealt out by the cluster columns and sorted by them. Other folders of the table stay; those that df has rows for
    are replaced as wholes."""
    salt = F.pmod(F.xxhash64(*cluster), F.lit(files))
    rows = df.where(F.col(DAY).isNotNull() | F.raise_error(F.lit("a row has no day")).isNotNull())
    rows = rows.withColumn(MONTH, F.date_format(DAY, "yyyy-MM")) if by == MONTH else rows
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # folders, not bytes, make the work, so none are joined up
    rows = rows.repartition(tasks, F.col(by), salt).sortWithinPartitions(by, *cluster)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def _folders(spark: SparkSession, path: str, by: str) -> list[str]:
    return sorted(n.removeprefix(f"{by}=") for n in _Files(spark, path).names(path) if n.startswith(f"{by}="))


def days(spark: SparkSession, path: str) -> list[str]:
    """The days of a table by day in order, as ISO dates, from its folders' names: one name per day, no file is opened."""
    return _folders(spark, path, DAY)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(DAY, F.col(DAY).cast("date"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path).drop(MONTH)


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest day; only its folder is scanned. An empty table has no newest day and gives no rows."""
    found, months = days(spark, path), _folders(spark, path, MONTH)
    rows = _read(spark, path)
    if months:
        rows = rows.where(F.col(MONTH) == months[-1])
        found = [str(rows.agg(F.max(DAY).alias("last")).first()["last"])]
    return (rows.where(F.col(DAY) == F.lit(found[-1]).cast("date")) if found else rows.limit(0)).drop(MONTH)


def since(spark: SparkSession, path: str, start: str, end: str | None = None) -> DataFrame:
    """The rows from one day to another, both included."""
    rows = _read(spark, path).where(F.col(DAY) >= F.lit(start).cast("date"))
    rows = rows.where(F.col(DAY) <= F.lit(end).cast("date")) if end else rows
    if MONTH in rows.columns:
        rows = rows.where((F.col(MONTH) >= start[:7]) & (F.col(MONTH) <= (end or "9999")[:7])).drop(MONTH)
    return rows


def of_days(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The rows of the days that another table lists; its filters prune folders of a table by day when the join runs."""
    return read(spark, path).join(small(wanted.select(DAY).distinct(), 8), DAY, "left_semi")
