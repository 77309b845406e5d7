"""Helpers that several operators share: shared scratch tables, Arrow text access, hashing of words in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import Tables, remove, scratch, shared_root, small, stored  # noqa: F401  tables in the shared folder, as the rest of the library keeps them

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_of(key: Column, wanted: int, total: int) -> Column:
    """True for about wanted of total rows, chosen by a hash of key, so that the choice doesn't depend on partitions."""
    return F.lit(True) if total <= wanted else F.shiftrightunsigned(F.xxhash64(key), 1) < F.lit((wanted << 63) // total)


# --- Arrow text -----------------------------------------------------------------------------


#: Bytes of text that are worked on at once: the temporary arrays of a piece are ten to fifty times as large.
PIECE_BYTES = 1 << 18


def slices(batches: Iterator[pa.RecordBatch], column: str | int = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows so that a piece has about `most` bytes of text; one longer text is a piece of its own."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(size, dtype=np.int64), 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, end to end, and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    at = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def map_texts(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, most: int = PIECE_BYTES) -> DataFrame:
    """f on pieces of df of bounded text size, inside the tasks that read them; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, most=most):
            out = f(piece)
            if out is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so that clashing extra columns don't matter."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def keep_rows(df: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of df whose text keep() is true for, with all their columns as they are; each text travels once."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, at):
            yield piece.filter(pa.array(keep(piece.column(at)), pa.bool_()))

    return numbered(df).mapInArrow(run, df.schema)


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns named by number, for tasks that know them by place: names with dots don't pass mapInArrow."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


# --- hashing --------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche (a xor-shift and multiply finaliser)."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_BASE = U64(0x9E3779B97F4A7C15)
#: A random 64-bit value per byte, from a fixed seed.
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
#: Bytes that are hashed at once.
BLOCK = 1 << 16
UP, DOWN = (np.multiply.accumulate(np.append(U64(1), np.full(BLOCK, U64(step)))) for step in (int(_BASE), pow(int(_BASE), -1, 1 << 64)))


def _long_sum(data: np.ndarray, values: np.ndarray) -> np.uint64:
    """The polynomial of a run longer than BLOCK, taken a block at a time."""
    total, factor = np.zeros(1, U64), np.ones(1, U64)
    for lo in range(0, len(data), BLOCK):
        part = data[lo : lo + BLOCK]
        total += (values[part] * UP[: len(part)]).sum() * factor
        factor *= UP[BLOCK]
    return total[0]


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each run, by prefix sums of a polynomial; equal runs give equal hashes.

    values has a random number for each value in data. The runs are in order and don't overlap. Blocks of runs are hashed one after the other, so the working memory is fixed.
    """
    out, lo = np.zeros(len(start), U64), 0
    while lo < len(start):
        first = int(start[lo])
        hi = int(np.searchsorted(end, first + BLOCK, "right"))
        if hi <= lo:
            out[lo] = _long_sum(data[first : int(end[lo])], values)
            lo += 1
            continue
        part = data[first : int(end[hi - 1])]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * UP[: len(part)], out=total[1:])
        a, b = start[lo:hi] - first, end[lo:hi] - first
        out[lo:hi] = (total[b] - total[a]) * DOWN[a]
        lo = hi
    return mix(out + (end - start).astype(U64))


def runs(member: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of bytes with the same kind where member holds, none across a row's end."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    cut[1:n] = kind[1:] != kind[:-1]
    cut[offsets] = True
    at = np.flatnonzero(cut)
    start, end = at[:-1], at[1:]
    keep = member[start]
    return start[keep], end[keep]


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs without space, tab to carriage return; in UTF-8 those bytes stand for nothing else."""
    inside = ~SPACE[data]
    return runs(inside, inside, offsets)


# --- pieces of text already encoded ---------------------------------------------------------


def gather(source: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """source[begin:begin+count] of all entries, end to end."""
    if not len(begin):
        return source[:0]
    at = np.cumsum(count)
    return source[np.repeat(begin - at + count, count) + np.arange(at[-1])]


class Known:
    """The ids of the pieces of text that a task has met. When there are too many, those met once are forgotten."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 250_000, most_chars: int = 16 << 20):
        """encode gives the ids of all pieces, end to end, and the count of each."""
        self.encode, self.most, self.most_chars = encode, most, most_chars
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.at, self.count, self.uses = (np.zeros(1 << 12, np.int64) for _ in range(3))
        self.used = self.chars = 0

    def _thin_out(self) -> None:
        """Keeps the pieces used most, at most half of what there may be."""
        n = len(self.index)
        uses = self.uses[:n]
        least = 2
        while (uses >= least).sum() > self.most // 2:
            least *= 2
        keep = np.flatnonzero(uses >= least)
        names = list(self.index)
        names = [names[i] for i in keep]
        at, count = self.at[keep], self.count[keep]
        ids = gather(self.ids, at, count)
        self.forget()
        self.chars = sum(map(len, names))
        if self.chars > self.most_chars // 2:
            self.chars = 0
            return
        self.index = dict(zip(names, range(len(names)), strict=True))
        self.ids, self.used = ids, len(ids)
        self.at, self.count, self.uses = np.cumsum(count) - count, count, np.ones(len(keep), np.int64)

    def _learn(self, pieces: list[str]) -> None:
        ids, count = self.encode(pieces)
        first = len(self.index)
        if first + len(pieces) > len(self.at):
            grown = np.zeros(max(len(self.at), first + len(pieces) - len(self.at)), np.int64)
            self.at, self.count, self.uses = (np.append(x, grown) for x in (self.at, self.count, self.uses))
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(len(self.ids), self.used + len(ids) - len(self.ids)), np.int32))
        self.ids[self.used : self.used + len(ids)] = ids
        self.at[first : first + len(pieces)] = self.used + np.cumsum(count) - count
        self.count[first : first + len(pieces)] = count
        self.uses[first : first + len(pieces)] = 0
        self.index.update(zip(pieces, range(first, first + len(pieces)), strict=True))
        self.used += len(ids)
        self.chars += sum(map(len, pieces))

    def _index(self, split: list[list[str]]) -> np.ndarray:
        """Where the ids of all pieces of all texts are kept, one text after the other."""
        if len(self.index) > self.most or self.chars > self.most_chars:
            self._thin_out()
        flat = list(chain.from_iterable(split))
        at = np.fromiter(map(self.index.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [flat[i] for i in missing.tolist()]
            self._learn(list(dict.fromkeys(new)))
            at[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        self.uses[: len(self.index)] += np.bincount(at, minlength=len(self.index))
        return at

    def flat(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each given as its pieces, end to end, and the count of each text."""
        index = self._index(split)
        total = np.append(0, np.cumsum(self.count[index]))
        stop = np.cumsum([len(own) for own in split])
        return gather(self.ids, self.at[index], self.count[index]), np.diff(total[np.append(0, stop)])

    def __call__(self, split: list[list[str]]) -> list[np.ndarray]:
        """The ids of each text, given as its pieces."""
        if not split:
            return []
        ids, count = self.flat(split)
        return np.split(ids, np.cumsum(count)[:-1])
