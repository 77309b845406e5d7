"""From raw documents to packed sequences: a quality filter, a language filter, near-duplicate removal, secret masking, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfshare.llm import language_id, ngram_jaccard, packing, quality, secret_scan
from shelfshare.llm.common import scratch, small, stored, table
from shelfshare.llm.language_id import remainder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts 1 for.

    Each row is judged by its own text: null and empty texts by the score of an empty one, repeated rows and ids alike. An
    empty table stays empty; columns are passed on as they are, whatever their names.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return quality.keep(docs, model)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.

    Each row is judged by its own text; one that is null, empty or without a letter has no language and goes. Repeated rows
    stay or go together; an empty table stays empty; columns are passed on as they are, whatever their names.
    """
    model = language_id.train(table(spark, sf_dir, "documents"), remainder("doc_id", 4) != 2)
    return language_id.keep(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that 3-word shingles with a Jaccard likeness of 0.9 link: that of the smallest id, or of a null id where there are no others.

    Of rows of the smallest id one stays; a null or empty text, or one without words, links with nothing and stays, also if it
    is repeated. An empty table stays empty; columns are passed on as they are, whatever their names.
    """
    key = "row_key"  # of the rows, as ids may be null or repeated
    while key.lower() in {c.lower() for c in docs.columns}:
        key += "_"
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")  # the key depends on how the rows were read
    found = stored(ngram_jaccard.components(rows, key).select("doc_id", "component_id"), "components")
    ranks = rows.select(F.col(key).alias("doc_id"), F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), F.col(key).alias("row")).alias("rank"))
    kept = found.join(ranks, "doc_id").groupBy("component_id").agg(F.min("rank").alias("least")).select(F.col("least.row").alias("doc_id"))
    gone = stored(found.join(kept, "doc_id", "left_anti").select(F.col("doc_id").alias(key)), "rejected")
    return rows.join(small(gone, 16), key, "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mask.

    Every row stays, repeated ones too; null and empty texts stay as they are; an empty table stays empty.
    """
    return secret_scan.redact_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens.

    A null or empty text is the one token that ends it; each repeated row is packed; an empty table gives no piece. Only the
    ids and the texts are read, so other columns don't matter.
    """
    return packing.pack(docs, known=250_000).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("language ID", keep_languages),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", mask_secrets),
    ("packing", pack_sequences),
]

#: Classifiers and tokenizers are beyond SQL; tests hold the pipeline against brute-force versions of its stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on documents, each one's result written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
