"""Order MinHash fingerprints: sensitive to which k-mers a text has and to the order they stand in.

Each of `sketches` hash functions picks the `tuple_size` least k-mers of the text, numbered by occurrence so that repeats
differ, puts the picked ones back into text order and hashes the tuple. Two texts' likeness is the share of equal tuples.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import U64, mix, texts_of

K, TUPLE, SKETCHES = 5, 2, 64
_seeds = np.random.default_rng(11)
ODD = _seeds.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
XOR = _seeds.integers(1, 1 << 63, 256, dtype=np.uint64)
NONE = U64(0xFFFFFFFFFFFFFFFF)
CELLS = 1 << 19


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """A hash per place of the k-mer there and its occurrence number; a text shorter than k is one k-mer, an empty one none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    if not len(codes):
        return codes
    k = min(k, len(codes))
    n = len(codes) - k + 1
    h = np.zeros(n, U64)
    for i in range(k):
        h = (h ^ codes[i : i + n]) * U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(31)
    h = mix(h)
    low = U64(max(1, (n - 1).bit_length()))
    ordered = np.sort((h >> low << low) | np.arange(n, dtype=U64))  # by k-mer, then by place
    gram, place = ordered >> low, (ordered & ((U64(1) << low) - U64(1))).astype(np.int64)
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    if len(first) == n:
        return h
    nth = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    again = nth > 0
    h[place[again]] = mix(h[place[again]] + nth[again].astype(U64) * U64(0xD6E8FEB86659FD93))
    return h


def signature(text: str, sketches: int = SKETCHES, tuple_size: int = TUPLE) -> np.ndarray:
    """One 32-bit value per sketch; all zero for an empty text."""
    h = numbered_kmers(text)
    n = len(h)
    if not n:
        return np.zeros(sketches, np.uint32)
    out, take = np.empty(sketches, np.uint32), min(tuple_size, n)
    step = max(1, CELLS // n)  # so many sketches at once that the working memory stays bounded
    for lo in range(0, sketches, step):
        hi = min(sketches, lo + step)
        ranks = (h[None, :] ^ XOR[lo:hi, None]) * ODD[lo:hi, None]
        rows = np.arange(hi - lo)
        picked = np.empty((hi - lo, take), np.int64)
        for i in range(take):
            picked[:, i] = ranks.argmin(axis=1)
            ranks[rows, picked[:, i]] = NONE
        picked.sort(axis=1)
        value = np.full(hi - lo, U64(n < tuple_size))
        for i in range(take):
            value = mix(value * U64(0x9E3779B97F4A7C15) + h[picked[:, i]])
        out[lo:hi] = value >> U64(32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last floor(n/2) code points replaced by the first as many (or all) of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _cuts(df: DataFrame, parts: int) -> list[int]:
    """At most parts-1 ids that deal the rows out evenly."""
    return sorted({int(x) for x in df.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (20 * parts))}) if parts > 1 else []


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per document: its length, the edited text's digest, both fingerprints, and the likeness to the edited text and to the next document.

    The next document is the one with the next smaller id; after the smallest comes the largest. Rows of one id follow each
    other in the order of their texts. A null id comes last. Null text is empty. A lone document is followed by itself.
    An empty table gives an empty result.

    Whole texts are shuffled once, into ranges of ids; each range also gets the first row of the range after it. So the only
    rows sent twice are one per range, and a task holds two texts at a time. Ids are taken to be nearly unique: rows of one
    id, and those without, are in one range, since the order has nothing else to part them by than whole texts.
    """
    docs = texts_of(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select("doc_id")
    cuts = _cuts(ids, parts)
    # Range 0 holds the largest ids, so that ranges and rows both go downwards; null ids are in the last range.
    bound = F.lit(cuts).cast(ArrayType(LongType())) if cuts else F.array().cast(ArrayType(LongType()))
    part = F.lit(len(cuts)) - F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(bound, lambda x: x <= F.col("doc_id"))))
    firsts = {r["part"]: r["top"] for r in ids.select(part.alias("part"), "doc_id").groupBy("part").agg(F.max("doc_id").alias("top")).collect()}  # one row per range
    full = sorted(firsts)
    # Where the first row of each range is also needed: at the end of the range before it. A range of null ids only has no top.
    wanted = [(firsts[p], full[i - 1]) for i, p in enumerate(full)]
    order = F.when(F.col("doc_id").isNull(), 1).otherwise(0)
    rows = docs.select(part.alias("part"), F.lit(0).alias("guest"), order.alias("last"), (-F.col("doc_id")).alias("down"), "doc_id", "text")
    if wanted:
        lend = F.broadcast(df.sparkSession.createDataFrame([(x, p) for x, p in wanted], "top long, part int"))  # a row per range
        tops = docs.join(lend, F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("top", "part").agg(F.min("text").alias("text"))
        rows = rows.unionByName(tops.select(F.col("part"), F.lit(1).alias("guest"), F.lit(2).alias("last"), F.lit(None).cast("long").alias("down"), F.lit(None).cast("long").alias("doc_id"), "text"))
    rows = rows.repartitionById(max(1, len(cuts) + 1), F.col("part").cast("int")).sortWithinPartitions("part", "guest", "last", "down", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []  # the row before this one waits for its text
        for batch in batches:
            for p, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")), strict=True):
                sig = signature(text)
                if held is not None:
                    own_id, own, own_sig = held
                    new = edited(own, text)
                    new_sig = own_sig if new == own else signature(new)
                    out.append((own_id, len(own), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(own_sig), fingerprint(new_sig), likeness(own_sig, new_sig), likeness(own_sig, sig)))
                held = None if guest else (doc_id, text, sig)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), KINDS, strict=True)], names=NAMES)
                out = []

    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(NAMES, ("long", "long", "string", "string", "string", "double", "double"), strict=True)))


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
