"""Language-model scores: bit predictors over hashed contexts, mixed in the logistic domain by gated weights that adapt online.

What is scored are a text's words, A-Z lower-cased, with one space between them, and its end: the tokens of the unigram model
beside it. A byte is spelled in the bits of a prefix code that the byte before it chooses (frequent bytes have few bits). For each of several orders, the bytes before it and
the code's node hash to a slot; the slot's counts of zeros and ones over all training texts are the predictor, as a log-odds.
A gate, the number of predictors that know their context, picks the weights that combine the log-odds. Every text starts from
the same fixed weights, and refines them block after block from its errors so far, as context mixers do: what is learned from
the corpus are counts, and those are of all training texts. The sum over a text's bits, and its end, is its log-probability.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Tables, gather, map_texts, run_hashes, slices, utf8, words

ORDERS = (2, 4, 6)
#: Slots of each order's table, as a power of two.
SLOT_BITS = (18, 22, 22)
#: UTF-8 has no such byte: it ends a text, so that texts of all lengths make up one distribution.
END = 0xFF
#: What a slot's counts start from, and the steps in which its log-odds are kept in a byte.
PRIOR, STEPS = 0.4, 15.0
#: Weights are refined at these places of a text, in bytes; from the last on, after so many bytes each.
FIRST_BLOCKS = (32, 64, 128, 256, 512, 1024, 2048)
EVERY = 2048
SEGMENT = 1 << 17
#: The weights that every text starts from, by order and by how many predictors know their context; parameters, not fitted.
FIRST_WEIGHTS = ((0.35, 0.6, 0.3, 0.15), (0.35, 0.7, 0.7, 0.6), (0.35, 0.3, 0.4, 0.45))
#: How many bits' worth of trust the first weights have in a text.
TRUST = 2000.0
#: How far one bit's error moves them, against that trust.
RATE = 10.0
#: Tokens whose counts every task holds; those of the others are joined.
FREQUENT = 1 << 16
#: Slots whose counts travel as one row, and bytes of text that are counted, and scored, at once.
BLOCK, COUNTED_BYTES, SCORED_BYTES = 1 << 10, 1 << 20, 1 << 17
#: Bytes whose slots are counted at once: their arrays stay in a processor's cache.
COUNTED_SEGMENT = 1 << 15
#: Token counts that a task holds before it sends them on.
HELD = 1 << 19
U32 = np.uint32
_M, NODE = U32(0x9E3779B1), U32(0x85EBCA6B)


# --- the code of bytes ----------------------------------------------------------------------


@dataclass(frozen=True)
class Code:
    """Per byte before (0 for none, else the byte + 1) and byte, as one index: where its path begins, and its length; per step of a path: the node and the bit."""

    at: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def _paths(counts: list[int]) -> list[list[tuple[int, int]]]:
    """The path of each byte from the root of a prefix code, as nodes and bits; ties go by number, so equal counts give equal codes."""
    heap: list[tuple[int, int, list[int]]] = [(c + 1, b, [b]) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    node = 0
    while len(heap) > 1:
        (n, i, low), (m, _, high) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, members in ((0, low), (1, high)):
            for b in members:
                paths[b].append((node, bit))
        node += 1
        heapq.heappush(heap, (n + m, i, low + high))
    return [p[::-1] for p in paths]


def prefix_codes(counts: np.ndarray) -> Code:
    """A prefix code of all bytes after each byte, which spends few bits on those that are frequent there."""
    same: dict[tuple[int, ...], list[list[tuple[int, int]]]] = {}
    paths = []
    for row in np.minimum(counts, 1 << 52).tolist():
        key = tuple(row)
        if key not in same:
            same[key] = _paths(row)
        paths += same[key]
    length = np.array([len(p) for p in paths])
    flat = [step for p in paths for step in p]
    return Code((np.cumsum(length) - length).astype(np.int32), length.astype(np.uint8), np.array([x for x, _ in flat], np.uint8), np.array([x for _, x in flat], np.int8))


# --- contexts and bits ----------------------------------------------------------------------


def with_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text's lower-cased words, with a space after each but the last, and END; and each byte's place in its text."""
    data, offsets = utf8(texts)
    start, end = words(data, offsets)
    n = len(texts)
    count = np.bincount(np.searchsorted(offsets, start, "right") - 1, minlength=n)
    size = end - start + 1
    out = gather(np.append(LOWER[data], np.uint8(32)), start, size).copy()
    stop = np.cumsum(size)
    out[stop - 1] = 32
    last = np.cumsum(count)  # how many words there are up to each text's end
    out[stop[last[count > 0] - 1] - 1] = END
    length = np.diff(np.append(0, np.append(0, stop)[last]))
    at = np.cumsum(length) - length
    out = np.insert(out, at[count == 0], END)
    length[count == 0] = 1
    return out, np.arange(len(out)) - np.repeat(np.cumsum(length) - length, length)


def contexts(data: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """The index of each byte in the code, by the byte before; and for each order a hash of the bytes before, none from before its text."""
    h, out = np.zeros(len(data), U32), []
    for back in range(1, max(ORDERS) + 1):
        before = np.zeros(len(data), U32)
        before[back:] = data[:-back].astype(U32) + U32(1)
        before[place < back] = 0
        if back == 1:
            out.append(before * U32(256) + data)
        h = (h ^ before) * _M
        h ^= h >> U32(15)
        if back in ORDERS:
            out.append(h)
    return out


def _bits(code: Code, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each bit of the bytes' codes: the byte it belongs to, its node and its value."""
    count = code.length[coded]
    stop = np.cumsum(count, dtype=np.int32)
    byte = np.repeat(np.arange(len(coded), dtype=np.intp), count)
    step = np.take(code.at[coded] - stop + count, byte) + np.arange(len(byte), dtype=np.intp)
    return byte, np.take(code.node, step), np.take(code.bit, step)


def _slot(context: np.ndarray, byte: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    slot = np.take(context, byte)
    slot += node
    slot *= U32(0xC2B2AE35)
    slot >>= U32(32 - bits)
    return slot


def _segments(data: np.ndarray, place: np.ndarray, most: int = SEGMENT) -> Iterator[list[np.ndarray]]:
    """The contexts of the bytes in parts of bounded size; they reach back into the part before."""
    reach = max(ORDERS)
    for lo in range(0, len(data), most):
        first = max(0, lo - reach)
        found = contexts(data[first : lo + most], np.minimum(place[first : lo + most], reach))
        yield [c[lo - first :] for c in found]


# --- the model ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    code: Code
    odds: tuple[np.ndarray, ...]  # per order and slot: the predictor's log-odds of a one
    weights: np.ndarray  # order x gate

    def inputs(self, coded: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each bit: its byte, its value, the gate, and the log-odds of each order."""
        byte, node, bit = _bits(self.code, coded)
        node = node * NODE
        x, gate = np.empty((len(ORDERS), len(bit)), np.float32), np.zeros(len(bit), np.int8)
        for k, context in enumerate(found):
            kept = np.take(self.odds[k], _slot(context, byte, node, SLOT_BITS[k]).astype(np.intp))
            gate += kept != 0
            np.multiply(kept, np.float32(1 / STEPS), out=x[k])
        return byte, bit, gate, x

    def score(self, texts: pa.Array) -> np.ndarray:
        """The log10-probability of each text."""
        data, place = with_ends(texts)
        start = np.flatnonzero(place == 0)
        size = np.diff(np.append(start, len(data)))
        short = size <= SEGMENT
        out = np.zeros(len(texts))
        if short.any():
            keep = np.repeat(short, size)
            out[short] = self._scored(data[keep], place[keep], size[short], Refined(int(short.sum())))
        for i in np.flatnonzero(~short).tolist():  # long texts in segments, what was learned going along
            refined = Refined(1)
            for lo in range(0, int(size[i]), SEGMENT):
                skip = min(lo, max(ORDERS))
                a, b = start[i] + lo - skip, start[i] + min(int(size[i]), lo + SEGMENT)
                out[i] += self._scored(data[a:b], place[a:b], np.array([b - a - skip]), refined, skip)[0]
        return out

    def _scored(self, data: np.ndarray, place: np.ndarray, size: np.ndarray, refined: Refined, skip: int = 0) -> np.ndarray:
        """The log10-probability of rows of bytes of the given sizes; of a single one the first `skip` bytes are only context."""
        coded, *found = (c[skip:] for c in contexts(data, place))
        place = place[skip:]
        block = np.searchsorted(FIRST_BLOCKS, place, "right") + np.maximum(0, place - FIRST_BLOCKS[-1]) // EVERY
        order = np.argsort(block, kind="stable")  # first blocks of all rows, then second ones, ...
        byte, bit, gate, x = self.inputs(coded[order], [c[order] for c in found])
        sign, gate = (2 * bit - 1).astype(np.float32), gate.astype(np.intp)
        for own, weight in zip(x, self.weights, strict=True):
            own *= np.take(weight, gate)
            own *= sign  # each order's say for the bit that came
        row = np.repeat(np.arange(len(size)), size)[order]
        # Where the bits of a row's block begin.
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (block[order][1:] != block[order][:-1])))
        at = np.searchsorted(byte, first)
        of, in_block = row[first], block[order][first]
        total = np.zeros(len(size))
        starts = np.flatnonzero(np.append(True, in_block[1:] != in_block[:-1]))
        for lo, hi in zip(starts.tolist(), np.append(starts[1:], len(first)).tolist(), strict=True):
            a, b = at[lo], at[hi] if hi < len(at) else len(bit)
            begin, rows = at[lo:hi] - a, of[lo:hi]
            count = np.diff(np.append(begin, b - a))
            own = x[:, a:b]
            mixed = np.einsum("kn,kn->n", own, np.repeat(refined.factor[:, rows], count, axis=1))
            p = 1 / (1 + np.exp(-np.clip(mixed, -60, 60)))
            total[rows] += np.add.reduceat(np.log(p), begin, dtype=np.float64)
            refined.learn(rows, count, np.add.reduceat(own * (1 - p), begin, axis=1))
        return total / np.log(10)


class Refined:
    """How far each row's orders are trusted against the first weights; it starts at 1 and learns from the errors."""

    def __init__(self, rows: int):
        self.factor, self.seen = np.ones((len(ORDERS), rows), np.float32), np.full(rows, TRUST, np.float32)

    def learn(self, rows: np.ndarray, bits: np.ndarray, gradient: np.ndarray) -> None:
        self.seen[rows] += bits
        self.factor[:, rows] += RATE * gradient / self.seen[rows]


# --- what is learned from the corpus --------------------------------------------------------


def _odds(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(STEPS * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)


def _tables_of(rows: list[dict]) -> tuple[np.ndarray, ...]:
    odds = tuple(np.zeros(1 << bits, np.int8) for bits in SLOT_BITS)
    for row in rows:
        odds[row["k"]][row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["odds"], np.int8)
    return odds


def _packed(counts: np.ndarray) -> bytes:
    """The counts of a block in one, two or four bytes each, as the largest needs."""
    most = counts.max()
    return counts.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else U32).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, {1: np.uint8, 2: np.uint16, 4: U32}[len(raw) // (2 * BLOCK)])


def _slot_counts(code: Code, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of zeros and ones of all slots over a task's texts, in blocks that have any."""
    counts = [np.zeros(2 << bits, np.uint32) for bits in SLOT_BITS]
    for piece in slices(batches, most=COUNTED_BYTES):
        for coded, *found in _segments(*with_ends(piece.column("text")), COUNTED_SEGMENT):
            byte, node, bit = _bits(code, coded)
            node = node * NODE
            for k, context in enumerate(found):
                cell = _slot(context, byte, node, SLOT_BITS[k]).astype(np.intp)
                cell *= 2
                cell += bit
                np.add.at(counts[k], cell, U32(1))
    for k, own in enumerate(counts):
        rows = own.reshape(-1, 2 * BLOCK)
        full = np.flatnonzero(rows.any(axis=1))
        for lo in range(0, len(full), 256):
            part = full[lo : lo + 256]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k), pa.int32()), pa.array(part, pa.int32()), pa.array([_packed(rows[i]) for i in part], pa.binary())], names=["k", "block", "counts"])


def _summed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The log-odds of each block, from rows that come block after block; one block's sum is held."""

    def done(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
        odds = _odds(total[0::2], total[1::2]).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([odds], pa.binary())], names=["k", "block", "odds"])

    key, total = None, np.zeros(2 * BLOCK, np.int64)
    for batch in batches:
        for own in zip(batch.column("k").to_pylist(), batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            if own[:2] != key:
                if key is not None:
                    yield done(key, total)
                key, total = own[:2], np.zeros(2 * BLOCK, np.int64)
            total += _unpacked(own[2])
    if key is not None:
        yield done(key, total)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token of each row's words and end, as a 64-bit hash with its sign, and the row; A-Z count as a-z. 0 is the end."""
    data, offsets = utf8(texts)
    start, end = words(data, offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    n = len(texts)
    return np.append(run_hashes(LOWER[data], start, end).view(np.int64), np.zeros(n, np.int64)), np.append(row, np.arange(n))


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: a token and how often it comes in training texts and in all; kind 1: a byte after another in training texts."""
    bytes_seen, held, rows = np.zeros(257 * 256, np.int64), [], 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("key").aggregate([("train", "sum"), ("whole", "sum")]).rename_columns(["key", "train", "whole"])

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from table.add_column(0, "kind", pa.array(np.zeros(table.num_rows), pa.int32())).combine_chunks().to_batches()

    for piece in slices(batches, most=COUNTED_BYTES):
        key, row = tokens(piece.column("text"))
        train = piece.column("train").to_numpy(zero_copy_only=False).astype(bool)
        own, which = np.unique(key, return_inverse=True)
        held.append(pa.table([pa.array(own), pa.array(np.bincount(which[train[row]], minlength=len(own))), pa.array(np.bincount(which, minlength=len(own)))], names=["key", "train", "whole"]))
        data, place = with_ends(piece.column("text").filter(pa.array(train)))
        before = np.append(np.zeros(1, np.int64), data[:-1].astype(np.int64) + 1)[: len(data)]
        bytes_seen += np.bincount(np.where(place > 0, before, 0) * 256 + data, minlength=len(bytes_seen))
        rows += len(own)
        if rows > HELD:
            held = [summed()]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from out(held[0])
                held, rows = [], 0
    if held:
        yield from out(summed())
    seen = np.flatnonzero(bytes_seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(seen)), pa.int32()), pa.array(seen), pa.array(bytes_seen[seen]), pa.array(bytes_seen[seen])], names=["kind", "key", "train", "whole"])


@dataclass(frozen=True)
class Trained:
    model: Model
    tokens: DataFrame  # key, train, whole: every token of the texts, with its counts in training texts and in all
    frequent: np.ndarray  # the keys that every task knows, sorted, and their counts in training texts
    frequent_train: np.ndarray
    train_tokens: int
    distinct: int


def train(df: DataFrame, allowed: Column, text_col: str = "text") -> Trained:
    """Counts over the whole texts of all rows where allowed holds. Null texts are empty.

    The driver gets the counts of the `FREQUENT` most frequent tokens and a table of fixed size per order; the counts of all
    tokens stay in the shared folder. A repeated row counts as often as it is there. Without a training row every bit has the probability 1/2.
    """
    tables = Tables(df.sparkSession)
    texts = df.select(F.col(text_col).cast("string").alias("text"), F.coalesce(allowed, F.lit(False)).alias("train"))
    counted = texts.mapInArrow(_token_counts, "kind int, key long, train long, whole long").groupBy("kind", "key").agg(F.sum("train").alias("train"), F.sum("whole").alias("whole"))
    counted = tables.store(counted, "token-counts")
    known = counted.where("kind = 0").select("key", "train", "whole")
    total = known.agg(F.sum("train").alias("n"), F.sum((F.col("train") > 0).cast("long")).alias("v")).first()
    frequent = known.orderBy(F.col("whole").desc(), "key").limit(FREQUENT).select("key", "train").toPandas().sort_values("key")
    seen = np.zeros(257 * 256, np.int64)
    for row in counted.where("kind = 1").collect():  # one row per pair of bytes
        seen[row["key"]] = row["train"]
    code = prefix_codes(seen.reshape(257, 256))
    learned = texts.where("train").select("text")
    blocks = learned.mapInArrow(lambda batches: _slot_counts(code, batches), "k int, block int, counts binary").repartition("k", "block").sortWithinPartitions("k", "block")
    odds = _tables_of(blocks.mapInArrow(_summed_blocks, "k int, block int, odds binary").collect())  # a table of fixed size
    return Trained(Model(code, odds, np.array(FIRST_WEIGHTS, np.float32)), known, frequent["key"].to_numpy(np.int64), frequent["train"].to_numpy(np.int64), total["n"] or 0, total["v"] or 0)


def _scores(trained: tuple[Model, np.ndarray, np.ndarray], batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of each row its score, tokens, the known of the frequent ones and their log10(count + 1), and the others with their counts."""
    model, frequent, frequent_train = trained
    n = batch.num_rows
    key, row = tokens(batch.column("text"))
    own, which = np.unique(key, return_inverse=True)
    at = np.minimum(np.searchsorted(frequent, own), max(0, len(frequent) - 1))
    common = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
    count = np.where(common, frequent_train[at], 0) if len(frequent) else np.zeros(len(own), np.int64)
    rare = np.flatnonzero(~common[which])
    cell, times = np.unique(row[rare] * len(own) + which[rare], return_counts=True)
    ends = np.searchsorted(cell, np.arange(n + 1) * len(own)).astype(np.int32)
    others = pa.StructArray.from_arrays([pa.array(own[cell % len(own)] if len(own) else own), pa.array(times.astype(np.int64))], names=["key", "times"])
    # fmt: off
    columns = [
        batch.column("doc_id"), pa.array(np.bincount(row, minlength=n)), pa.array(np.bincount(row, (count > 0)[which], n).astype(np.int64)),
        pa.array(np.bincount(row, np.log10(count + 1.0)[which], n)), pa.array(model.score(batch.column("text"))), pa.ListArray.from_arrays(pa.array(ends), others),
    ]
    # fmt: on
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "log_sum", "score", "others"])


def score(df: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each whole text.

    score is the mixed model's log10-probability of the text's words, lower-cased and one space apart, and its end. base_score is that of a unigram model of
    words and an end, with one added to every count; n_known tells how many tokens training texts have. A null or empty text
    has the one token of its end. One row out per row in, also for null and repeated ids; equal texts have equal scores. An
    empty table gives an empty result. Tokens are told apart by 64-bit hashes.

    The most frequent tokens are looked up in the tasks; of the others each row's counts are joined with the corpus's. No
    such key has more than one in `FREQUENT` of all tokens counted, so none is a hot one.
    """
    spark = df.sparkSession
    held = spark.sparkContext.broadcast((trained.model, trained.frequent, trained.frequent_train))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kinds = "doc_id long, n_tokens long, n_known long, log_sum double, score double, others array<struct<key:long,times:long>>"
    rows = map_texts(docs, lambda batch: _scores(held.value, batch), kinds, SCORED_BYTES).withColumn("row", F.monotonically_increasing_id())
    rows = Tables(spark).store(rows, "mixing-scores")  # so that each row keeps its number
    others = rows.select("row", F.explode("others").alias("other")).select("row", "other.key", "other.times")
    count = F.coalesce(F.col("train"), F.lit(0))
    found = others.join(trained.tokens.select("key", "train"), "key", "left").groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(count + 1)).alias("more_sum")
    )
    base = F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(trained.train_tokens + trained.distinct + 1)))
    known = F.col("n_known") + F.coalesce("more_known", F.lit(0))
    return rows.drop("others").join(found, "row", "left").select("doc_id", "n_tokens", known.alias("n_known"), F.lit(trained.train_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
