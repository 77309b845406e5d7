"""Joins on a handful of keys, each of which is a product, dealt out evenly; and tables kept as the factors of such a product."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lineage import BROADCAST_BYTES, TASK_ROWS, Tables

#: Rows that one task makes, at least and at most, and bytes a row of the smaller side is taken to have.
PER_TASK, MOST_PER_TASK, ROW_BYTES = 1_000_000, 16_000_000, 100

#: Rows of a left block and of a right one, at most. A task holds the rows of two blocks' product at once.
LEFT_BLOCK, RIGHT_BLOCK = 256, 64


def _blocks(df: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    """keys, block_ and an array of up to `most` rows each, which lie side by side when the columns with the fewest values are
    sorted first. Numbers of blocks follow each other, but for as many gaps as there are tasks."""
    others = [c for c in df.columns if c not in keys]
    if len(others) > 1:
        values = df.agg(*[F.approx_count_distinct(c) for c in others]).first()
        others = [c for _, c in sorted(zip(values, others, strict=True), key=lambda x: x[0])]
    order = [*keys, *others]
    ranged = df.repartitionByRange(max(1, -(-df.count() // TASK_ROWS)), *order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("block_", F.expr(f"monotonically_increasing_id() div {most}"))
    return numbered.groupBy(*keys, "block_").agg(F.sort_array(F.collect_list(F.struct(*others or [F.lit(1).alias("one_")]))).alias(name))


def product_join(left: DataFrame, right: DataFrame, keys: list[str], per_task: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """left.join(right, keys) where few keys have many rows on both sides: each task makes about per_task rows, whatever the keys.
    Without that number it lies between PER_TASK and MOST_PER_TASK, so that a large product has no task for every million of rows.

    Both sides are stored, counted per key and cut into blocks of rows that are alike. If the right side is small by its count,
    every task gets it whole and the left blocks are dealt out evenly. Otherwise each key's product is a grid of cells of
    per_task rows: a left block belongs to one strip of cells and is sent to each cell of it, a right block likewise, so a key
    is spread over as many tasks as it needs and the copies grow with the square root of the product at most. Null keys join
    with nothing; repeated rows count each.

    Rows are made block by block: each right row with all rows of a left block, one right row after the other. So the columns
    of the right side stay the same for a block's length and those of the left side come again with every right row, and a
    columnar file of the product takes a tenth to a third of a byte for a row, where the columns are ids and values of few digits.
    """
    tables = Tables(left.sparkSession)
    columns = [*keys, *[c for c in left.columns + right.columns if c not in keys]]
    left, right = tables.store(left, "product-left"), tables.store(right, "product-right")
    sizes = left.groupBy(*keys).agg(F.count("*").alias("l")).join(right.groupBy(*keys).agg(F.count("*").alias("r")), keys)
    sizes = tables.store(sizes, "product-sizes")
    total = sizes.agg(F.sum(F.col("l") * F.col("r")).alias("rows"), F.sum("r").alias("right"), F.max("r").alias("most"), F.count("*").alias("keys")).first()
    if per_task is None:
        per_task = min(MOST_PER_TASK, max(PER_TASK, math.ceil((total["rows"] or 0) / (8 * left.sparkSession.sparkContext.defaultParallelism))))
    tasks = max(1, math.ceil((total["rows"] or 0) / per_task))
    side, whole = math.isqrt(per_task), (total["right"] or 0) * ROW_BYTES <= broadcast_bytes
    high, wide = min(LEFT_BLOCK, max(1, per_task // (total["most"] or 1)) if whole else side), min(RIGHT_BLOCK, side)  # rows of a block
    a, b = tables.store(_blocks(left, keys, high, "left_"), "product-left-blocks"), tables.store(_blocks(right, keys, wide, "right_"), "product-right-blocks")
    tables.drop("product-left", "product-right")
    if whole:
        pairs = a.repartition(tasks).join(F.broadcast(b), keys)
    else:
        l, r = F.ceil(F.col("l") / high), F.ceil(F.col("r") / wide)  # blocks of a key
        columns_of = F.least(r, F.greatest(F.lit(side // wide), F.floor(F.lit(per_task // (high * wide)) / l)))  # right blocks of a cell
        rows_of = F.least(l, F.greatest(F.lit(1), F.floor(F.lit(per_task // (high * wide)) / columns_of)))
        grid = sizes.select(*keys, F.ceil(l / rows_of).cast("int").alias("rows_"), F.ceil(r / columns_of).cast("int").alias("columns_"))
        grid = F.broadcast(grid) if total["keys"] * ROW_BYTES <= broadcast_bytes else grid
        of = lambda n: F.pmod("block_", n).cast("int")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        a = a.join(grid, keys).select(*keys, "left_", of("rows_").alias("row_"), upto("columns_").alias("column_"))
        b = b.join(grid, keys).select(*keys, "right_", of("columns_").alias("column_"), upto("rows_").alias("row_"))
        cell = [*keys, "row_", "column_"]
        pairs = a.repartition(tasks, *cell).join(b.repartition(tasks, *cell).hint("shuffle_hash"), cell)
    # No partition is merged here: it ends the stretch of generated code, which would hold all rows of a left block at once.
    pairs = pairs.coalesce(tasks)
    return pairs.select(*keys, "left_", F.inline("right_")).select("*", F.inline("left_")).select(*columns)


class Factored:
    """A matrix of every member (a sku) with every part of its group (a store), as its factors: parts has a row per group and
    part with the shares, members a row per group and member. Both are kept, joined and checked as they are; only expand()
    makes the product. Each (group, part) and each (group, member) must be there once: see repeats()."""

    def __init__(self, parts: DataFrame, members: DataFrame, group: str = "grp", part: str = "store", member: str = "sku"):
        self.parts, self.members, self.group, self.part, self.member = parts, members, group, part, member

    def write(self, path: str) -> None:
        self.parts.write.parquet(f"{path}/parts")
        self.members.write.parquet(f"{path}/members")

    @classmethod
    def read(cls, spark: SparkSession, path: str, group: str = "grp", part: str = "store", member: str = "sku") -> Factored:
        return cls(spark.read.parquet(f"{path}/parts"), spark.read.parquet(f"{path}/members"), group, part, member)

    def repeats(self) -> DataFrame:
        """group, name, n of parts and members that are there more than once, which the sums below would count too often."""
        often = lambda df, c: df.groupBy(self.group, F.col(c).cast("string").alias("name")).agg(F.count("*").alias("n")).where("n > 1")
        return often(self.parts, self.part).unionByName(often(self.members, self.member))

    def member_totals(self, names: list[str]) -> DataFrame:
        """Per member the sums of the shares over all parts, and how many parts it has: a group's sums hold for all its members."""
        sums = self.parts.groupBy(self.group).agg(*[F.sum(n).alias(n) for n in names], F.count("*").alias("parts"))
        return self.members.join(sums, self.group, "left").withColumn("parts", F.coalesce("parts", F.lit(0)))

    def part_totals(self, names: list[str], weight: str | None = None) -> DataFrame:
        """Per part the sums of the shares over all members, each counted by its weight: one row per group is joined with the parts."""
        weights = self.members.groupBy(self.group).agg((F.sum(weight) if weight else F.count("*").cast("double")).alias("weight_"))
        weighed = self.parts.join(weights, self.group)
        return weighed.groupBy(self.part).agg(*[F.sum(F.col(n) * F.col("weight_")).alias(n) for n in names])

    def off_whole(self, name: str, whole: float = 1.0, tolerance: float = 0.01) -> DataFrame:
        """The members whose shares do not add up to the whole within a tolerance."""
        return self.member_totals([name]).where(F.abs(F.coalesce(F.col(name), F.lit(0.0)) - whole) > tolerance)

    def top_parts(self, name: str, most: int, weight: str | None = None) -> DataFrame:
        """The parts with the largest sums over all members; of equal ones the smaller part."""
        return self.part_totals([name], weight).orderBy(F.desc(name), self.part).limit(most)

    def size(self) -> DataFrame:
        """How many rows expand() makes, as one row."""
        counts = self.parts.groupBy(self.group).agg(F.count("*").alias("p")).join(self.members.groupBy(self.group).agg(F.count("*").alias("m")), self.group)
        return counts.agg(F.coalesce(F.sum(F.col("p") * F.col("m")), F.lit(0)).alias("rows"))

    def expand(self, per_task: int | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """A row per member and part, spread over tasks as product_join() does it."""
        return product_join(self.members, self.parts, [self.group], per_task, broadcast_bytes)

    def export(self, path: str, per_file: int = PER_TASK, compression: str = "none") -> None:
        """The expanded rows as CSV, at most per_file rows a file; a task writes several files where there are many. Lines come in
        the order of expand(), which compresses well. Numbers become text in the factors, not in every row of the product."""
        text = lambda df: df.select(*[F.col(c).cast("string") if c != self.group and kind in ("bigint", "int", "double") else c for c, kind in df.dtypes])
        rows = product_join(text(self.members), text(self.parts), [self.group])
        columns = [self.group, *[c for c in self.members.columns + self.parts.columns if c != self.group]]
        rows.select(*columns).write.option("maxRecordsPerFile", per_file).csv(path, sep=";", header=True, compression=compression)
