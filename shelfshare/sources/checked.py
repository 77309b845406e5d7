"""Text files whose damaged lines are neither lost nor turned into nulls: good rows, and rejected ones with the reason."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import small, stored


@dataclass(frozen=True)
class Field:
    """A column of the file: its name there, the name of the result, what makes a value of its text (null if it can't), and
    whether it may be empty."""

    source: str
    name: str
    value: Callable[[Column], Column] = lambda text: text
    needed: bool = False


def whole_number(text: Column) -> Column:
    return F.trim(text).try_cast("long")


def comma_decimal(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def split(spark: SparkSession, path: str, fields: list[Field], sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """The good rows, and the rejected ones: file, line (its text), reason.

    The files are read once, line by line, and what is found is stored, so both results are of the same lines; every line
    but the headers and empty ones is in one of them. A line is rejected for its first fault in this order: `header` (its file
    has no line with exactly these columns), `columns` (too few or too many), `missing: <column>` (an empty one that is
    needed), `value: <column>` (a text that states none). Repeated lines stay. Quoted separators are understood, quoted line
    ends are not.
    """
    header = sep.join(f.source for f in fields)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line")).where(F.trim("line") != "")
    headed = lines.where(F.trim("line") == header).select("file").distinct().withColumn("headed", F.lit(True))
    lines = lines.where(F.trim("line") != header).join(small(headed, 200), "file", "left")
    schema = ", ".join(f"c{i} string" for i in range(len(fields))) + ", rest string"
    parsed = lines.withColumn("c", F.from_csv("line", schema, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "rest"}))
    text = [F.when(F.trim(F.col(f"c.c{i}")) != "", F.col(f"c.c{i}")) for i in range(len(fields))]
    faults = [F.when(F.col("headed").isNull(), "header"), F.when(F.col("c.rest").isNotNull(), "columns")]
    for f, t in zip(fields, text, strict=True):
        faults += [F.when(t.isNull(), f"missing: {f.source}")] if f.needed else []
        faults.append(F.when(t.isNotNull() & f.value(t).isNull(), f"value: {f.source}"))
    found = stored(parsed.select("file", "line", F.coalesce(*faults).alias("reason"), *[f.value(t).alias(f.name) for f, t in zip(fields, text, strict=True)]), "checked-lines")
    return found.where("reason is null").select(*[f.name for f in fields]), found.where("reason is not null").select(F.element_at(F.split("file", "/"), -1).alias("file"), "line", "reason")
