"""The registered query of each operator: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, context_mixing, language_id, line_crf, ngram_jaccard, order_minhash, packing, periodic_runs, quality, secret_scan, sharding, spelling, warc
from .common import table
from .language_id import remainder
from .sql import ORACLE_SQL  # noqa: F401

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def _with_fold(spark: SparkSession, sf_dir: str, result: DataFrame, of: int, held: int) -> DataFrame:
    """result with held_out, which the id alone decides."""
    return result.select("doc_id", F.coalesce(remainder("doc_id", of) == held, F.lit(False)).alias("held_out"), *[c for c in result.columns if c != "doc_id"])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, remainder("doc_id", 4) != 2)
    return _with_fold(spark, sf_dir, language_id.predict(docs, model), 4, 2)


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf_dir, "documents"))


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.label_lines(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.components(table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("content", 256).alias("decoded_sha256"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document goes, and where it would go if the first shard were lost."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    whole = sharding.place(docs, "doc_id", SHARDS)
    return sharding.place(whole, "doc_id", SHARDS[1:], shard_col="shard_after_loss").select("doc_id", "slot", "shard", "shard_after_loss")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return _with_fold(spark, sf_dir, quality.score(docs, model), 5, 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def with_repeats(docs: DataFrame) -> DataFrame:
    """documents, where h, the CRC-32 of the id as text, is divisible by ten, with words that repeat from the word number a on with period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", g.alias("g"), words.alias("words")).withColumn("n", F.size("words"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.pmod("g", "n")).cast("int"))
    left = F.col("n") - F.col("a")
    docs = docs.withColumn("p", (1 + F.floor(left / (3 + F.pmod("g", F.lit(8))))).cast("int"))
    group = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(group, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    again = F.concat_ws(" ", F.concat(F.slice("words", F.lit(1), F.col("a")), tail))
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(with_repeats(table(spark, sf_dir, "documents"))).withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent.alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), damage=spelling.DAMAGE))


def op13_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trained = context_mixing.train(docs, remainder("doc_id", 7) != 2)
    return _with_fold(spark, sf_dir, context_mixing.score(docs, trained), 7, 2)


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_language_id, op3_order_minhash, op4_line_crf, op5_warc, op6_ngram_jaccard, op7_byte_bpe, op8_sharding, op9_quality, op10_packing, op11_periodic_runs, op12_spelling_variants, op13_context_mixing)}
