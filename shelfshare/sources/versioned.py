"""A table in versions, of which a period is replaced all or nothing.

    <root>/parts/<id>/part_=<month>/*.parquet   rows of one month, written once and never changed
    <root>/versions/<n>.json                    the manifest of version n: the schema, and the folder of each month

A writer stages new folders for the months it touches and then publishes the next manifest with one rename. Readers take the
newest manifest, so they see the old version or the new one; a writer that dies before the rename has changed nothing, and
one that was overtaken is refused. Months that a write does not touch are carried over by name, without being read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "part_"
NO_DAY = "none"


class Overtaken(RuntimeError):
    """Another writer published a version first; nothing was changed."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    schema: StructType | None = None
    parts: dict[str, str] = field(default_factory=dict)  # month: folder under the root


class _Files:
    """The few calls on the table's own file system that versions need."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, text: str, name: str) -> None:
        """The text under its name at once, or an error if the name is taken."""
        staged, target = self.path(f"{name}.{uuid.uuid4().hex}.tmp"), self.path(name)
        stream = self.fs.create(staged, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(target) or not self.fs.rename(staged, target):
            self.fs.delete(staged, False)
            raise Overtaken(f"{name} is there already")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _numbers(files: _Files, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(f"{root}/versions") if n.endswith(".json"))


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or the one of a number; number 0 without months for a table that was never written."""
    files = _Files(spark, root)
    found = _numbers(files, root)
    if not found and number is None:
        return Version()
    own = json.loads(files.read(f"{root}/versions/{(found[-1] if number is None else number):010d}.json"))
    return Version(own["version"], StructType.fromJson(own["schema"]), own["parts"])


def _rows(spark: SparkSession, root: str, version: Version, parts: list[str]) -> DataFrame:
    folders = [f"{root}/{version.parts[p]}" for p in parts]
    return spark.read.schema(version.schema).parquet(*folders) if folders else spark.createDataFrame([], version.schema)


def read(spark: SparkSession, root: str, start: str | None = None, end: str | None = None, day: str = "day", number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of the one of a number, with days from start to end if given: only the folders of
    those months are opened."""
    version = current(spark, root, number)
    if version.schema is None:
        raise FileNotFoundError(f"no version of {root}")
    wanted = [p for p in sorted(version.parts) if start is None and end is None or p != NO_DAY and (start or "")[:7] <= p <= (end or "9999")[:7]]
    rows = _rows(spark, root, version, wanted)
    for bound, keep in ((start, F.col(day) >= F.lit(start).cast("date")), (end, F.col(day) <= F.lit(end).cast("date"))):
        rows = rows.where(keep) if bound else rows
    return rows


def _month(day: str):
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_DAY))


def replace_period(df: DataFrame, root: str, start: str, end: str, day: str = "day") -> Version:
    """The table's rows with days from start to end (ISO dates, both included) become df; all other rows stay, also of the same months.

    A df without rows empties the period. A row of df outside the period, or without a day, fails the write: it would be
    there twice after the next one. Stored rows without a day are in no period and stay. df must have the table's columns
    and types, in any order; the first write sets them. Repeated rows are kept as often as they come.
    """
    spark = df.sparkSession
    files, old = _Files(spark, root), current(spark, root)
    if start > end:
        raise ValueError(f"the period from {start} to {end} is empty")
    inside = F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    checked = F.when(F.coalesce(inside, F.lit(False)), F.col(day)).otherwise(F.raise_error(F.concat(F.lit(f"outside {start} to {end}: "), F.coalesce(F.col(day).cast("string"), F.lit("no day")))).cast(df.schema[day].dataType))
    rows = df.withColumn(day, checked)
    if old.schema is not None:
        if {(f.name, f.dataType) for f in df.schema} != {(f.name, f.dataType) for f in old.schema}:
            raise ValueError(f"columns differ: {df.schema.simpleString()} and {old.schema.simpleString()}")
        touched = [p for p in sorted(old.parts) if start[:7] <= p <= end[:7]]
        kept = _rows(spark, root, old, touched).where(~F.coalesce(inside, F.lit(False)))
        rows = kept.unionByName(rows)
    else:
        touched = []
    staged = f"parts/{uuid.uuid4().hex}"
    rows.withColumn(PART, _month(day)).write.partitionBy(PART).parquet(f"{root}/{staged}")
    written = {n.removeprefix(f"{PART}="): f"{staged}/{n}" for n in files.names(f"{root}/{staged}") if n.startswith(f"{PART}=")}
    parts = {p: folder for p, folder in old.parts.items() if p not in touched} | written
    return _publish(files, root, Version(old.number + 1, old.schema or df.schema, parts))


def _publish(files: _Files, root: str, version: Version) -> Version:
    text = json.dumps({"version": version.number, "schema": version.schema.jsonValue(), "parts": version.parts}, indent=1)
    files.publish(text, f"{root}/versions/{version.number:010d}.json")
    return version


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Removes all but the newest `keep` versions, and every folder that none of those names: also what dead writers left.
    Call it when no writer or reader of an older version is at work. Returns the number of folders removed."""
    files = _Files(spark, root)
    numbers = _numbers(files, root)
    kept = {folder.split("/")[1] for n in numbers[-keep:] for folder in current(spark, root, n).parts.values()}
    for n in numbers[:-keep]:
        files.delete(f"{root}/versions/{n:010d}.json")
    gone = [name for name in files.names(f"{root}/parts") if name not in kept]
    for name in gone:
        files.delete(f"{root}/parts/{name}")
    return len(gone)
