"""Writing tables and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ..functions import comma_number
from ..operators.export import file_numbers
from ..operators.lineage import running_total


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """The table's rows and columns are replaced; with a path its files lie there, not in the warehouse."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def with_commas(df: DataFrame, columns: list[str], decimals: int = 3) -> DataFrame:
    return df.withColumns({c: comma_number(F.col(c), decimals) for c in columns})


def export_csv(df: DataFrame, path: str, numbers: list[str], decimals: int = 3) -> None:
    """Semicolons, decimal commas, a header."""
    with_commas(df, numbers, decimals).write.mode("overwrite").csv(path, sep=";", header=True)


def split_writer(df: DataFrame) -> DataFrameWriter:
    """A writer for many folders: each task moves its own files to their place when it ends, instead of the driver all of
    them one by one at the end of the job. A job that fails may leave files, so that what is read is published by other means
    or written again as a whole."""
    return df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")


def export_by_key(df: DataFrame, path: str, key: str, most: int, numbers: list[str]) -> None:
    """CSV files of about `most` rows, no key in two of them: a folder file_no=<n> each."""
    numbered = file_numbers(df, key, most).repartition("file_no")
    split_writer(with_commas(numbered, numbers)).mode("overwrite").partitionBy("file_no").csv(path, sep=";", header=True)


def plain_number(value: Column) -> Column:
    """A double as text without an exponent where it has up to 29 digits before the point: 12345678.0, not 1.2345678E7."""
    digits = F.regexp_replace(value.try_cast("decimal(38,9)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when((F.abs(value) >= 1e7) & (F.abs(value) < 1e29), digits).otherwise(value.cast("string"))


def single_csv(df: DataFrame, path: str) -> None:
    """One file with a header, for small reports; what computes them keeps its tasks. Large numbers are written out, without
    a power of ten."""
    floats = [c for c, kind in df.dtypes if kind in ("double", "float")]
    df.withColumns({c: plain_number(F.col(c)) for c in floats}).repartition(1).write.mode("overwrite").csv(path, header=True)


def export_parts(df: DataFrame, path: str, order: list[str], numbers: list[str], most: int = 250_000) -> None:
    """CSV parts of exactly `most` rows but the last, in order, which must be a full one. Rows are counted per range, so no
    task sorts them all; the ranges are stored before they are counted, so every row has one number."""
    numbered = running_total(df, [F.asc(c) for c in order], F.lit(1), "nth_")
    parts = numbered.withColumn("part", F.floor((F.col("nth_") - 1) / most).cast("int")).drop("nth_")
    split_writer(with_commas(parts, numbers).repartition("part")).mode("overwrite").partitionBy("part").csv(path, sep=";", header=True)
