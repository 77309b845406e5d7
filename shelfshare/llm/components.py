"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them. Edges point downwards already."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return tied.union(least.select("a", F.col("low").alias("b"))).distinct()


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (its least node) for every node of links (a, b).

    Links stay distributed; each round is written to the shared folder, so lineage is short and lost executors lose nothing.
    A hub's neighbours are summed up per task before they meet. The rounds needed grow with the logarithm of the longest
    chain; it ends when a round changes nothing.
    """
    tables, before = Tables(links.sparkSession), None
    edges = tables.store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges 0")
    for i in range(1, most_rounds + 1):
        edges = tables.store(_small(_large(edges)), f"edges {i}")
        tables.drop(f"edges {i - 1}")
        # Stars only: every edge ends in a root. Counts and sums tell whether the round changed anything.
        now = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    found = tables.store(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots), "components")
    tables.drop(f"edges {i}")
    return found
