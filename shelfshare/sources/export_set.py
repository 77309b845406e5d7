"""Exported files as one set that is there as a whole or not at all.

    <path>/data/category=<c>/file_no=<n>/*.csv   semicolons, decimal commas, a header each
    <path>/manifest/*.parquet                    a row per file: its folder, rows, sum of percentages, digest of its lines
    <path>/committed.json                        what all files add up to; written last, with one rename

A reader refuses a folder without the last, and one whose files are not those of the manifest: files that are missing, too
many, cut short or changed are found by rows, sums and digests, in one pass over the files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import export
from ..operators.lineage import dealt, running_total, stored
from .sinks import with_commas
from .versioned import _Files

COMMITTED = "committed.json"


class Refused(RuntimeError):
    """The folder holds no whole set of files."""


def export_rows(offline: DataFrame, online: DataFrame, reference: DataFrame, always: list[int], end_date: int) -> DataFrame:
    """category and the five columns of the files, of both channels and all categories in one job.

    offline, online: category, sku, store, share. The mean share per sku and store is taken, rows of stores that aren't
    eligible go, and what is left of each sku and channel is scaled to exactly 100. A sku's category is its own: a sku of two
    categories is scaled in each.
    """
    keys = ["category", "sku", "store"]

    def side(df: DataFrame, channel: str) -> DataFrame:  # a channel by itself, in the partitions that it comes in
        rows = df.groupBy(*keys).agg(F.avg(100 * F.col("share")).alias("share")).withColumn("channel", F.lit(channel))
        rows = export.eligibility(rows, reference, always).where("eligible")
        return export.final_export(export.normalise_to_100(rows, ("category", "sku", "channel")), end_date, ["category"])

    return side(offline, "OFFLINE").unionByName(side(online, "ONLINE"))


def write(rows: DataFrame, path: str, most: int = 150_000, number: str = "PERCENTUAL") -> dict:
    """Writes rows (category, SKU and the files' other columns) as a set of files of about `most` rows, no SKU in two of them, and
    publishes it. A folder that holds a set already is refused, as is a second writer; a writer that dies leaves no set."""
    spark = rows.sparkSession
    files = _Files(spark, path)
    if files.names(path):
        raise Refused(f"{path} is in use")
    rows = stored(rows, "export-rows")  # numbered and written from the same rows, in partitions by their count
    count = rows.count()
    per_sku = running_total(rows.groupBy("category", "SKU").agg(F.count("*").alias("rows_")), [F.asc("category"), F.asc("SKU")], F.col("rows_"), "upto_")
    numbers = per_sku.select("category", "SKU", F.floor((F.col("upto_") - F.col("rows_")) / most).cast("int").alias("file_no"))
    columns = [c for c in rows.columns if c != "category"]
    numbered = with_commas(dealt(rows, count, "category", "SKU").join(numbers, ["category", "SKU"]), [number]).select("category", "file_no", *columns)
    dealt(numbered, count, "category", "file_no").write.partitionBy("category", "file_no").csv(f"{path}/data", sep=";", header=True)
    _seen(spark, path, columns, number).write.parquet(f"{path}/manifest")
    total = _total(spark.read.parquet(f"{path}/manifest")) | {"columns": columns, "number": number}
    files.publish(json.dumps(total), f"{path}/{COMMITTED}")
    return total


def _seen(spark: SparkSession, path: str, columns: list[str], number: str) -> DataFrame:
    """file, rows, total, digest of each file that is there. The digest doesn't depend on the order of lines."""
    lines = spark.read.schema("value string").text(f"{path}/data").select(F.regexp_extract(F.col("_metadata.file_path"), r"/data/(.*)$", 1).alias("file"), "value")
    row = F.col("value") != ";".join(columns)  # not a header
    value = F.replace(F.split("value", ";")[columns.index(number)], F.lit(","), F.lit(".")).try_cast("decimal(18,3)")
    return lines.groupBy("file").agg(F.count_if(row).alias("rows"), F.sum(F.when(row, value)).alias("total"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("digest"))


def _total(manifest: DataFrame) -> dict:
    row = manifest.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("total"), F.lit(0)).cast("string").alias("total"), F.coalesce(F.sum("digest"), F.lit(0)).cast("string").alias("digest")).first()
    return row.asDict()


def read(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The rows of a committed set, with category and file_no; all but those two are text. Raises Refused where there is no
    committed set or, if check, where the files differ from the manifest; that takes one pass over them."""
    files = _Files(spark, path)
    if COMMITTED not in files.names(path):
        raise Refused(f"{path} has no committed set of files")
    committed = json.loads(files.read(f"{path}/{COMMITTED}"))
    manifest = spark.read.parquet(f"{path}/manifest")
    if {k: committed[k] for k in ("files", "rows", "total", "digest")} != _total(manifest):
        raise Refused(f"the manifest of {path} isn't the one that was committed")
    if committed["rows"] == 0:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in committed["columns"]) + ", category string, file_no int")
    if check:
        names = ["file", "rows", "total", "digest"]
        seen = _seen(spark, path, committed["columns"], committed["number"]).select(names)
        odd = seen.exceptAll(manifest.select(names)).select("file").union(manifest.select(names).exceptAll(seen).select("file")).distinct()
        wrong = [r["file"] for r in odd.limit(5).collect()]
        if wrong:
            raise Refused(f"files of {path} are not as they were committed: {', '.join(wrong)}")
    kinds = ", ".join(f"`{c}` string" for c in committed["columns"]) + ", category string, file_no int"
    return spark.read.csv(f"{path}/data", sep=";", header=True, schema=kinds)
