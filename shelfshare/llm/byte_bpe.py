"""Byte-level BPE encoding and decoding in numpy.

A text falls into stretches by a pattern, and each stretch is encoded on its own. Stretches of about one length make up the
rows of a padded matrix of token ids; in each round every row merges its leftmost pair of least rank, found by a hashed
lookup of pairs, and closes the gap. Further pairs of that rank in the row are merged in the same round if no new pair beside
a merged one ranks as low, since those rounds would come next anyway. Rows without a pair to merge leave the matrix. A
stretch that a task has met before is looked up, so only new ones are merged.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import U64, Known, gather, slices, texts_of

#: White space as the pattern means it; between such places and stretches of other characters a text can be cut.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
NO_RANK = np.iinfo(np.int32).max
#: Bytes of text that are encoded at once; more of it gives taller matrices.
PIECES = 1 << 20
#: Rows with fewer pairs than this seldom have two of one rank, and merge one in each round.
WIDE = 16
#: A matrix has about so many cells at most, or one row.
CELLS = 1 << 18


class Pairs:
    """Rank of a merged pair of ids, in an open-addressing table of numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        key = left.astype(U64) << U64(32) | right.astype(U64)
        self.bits = max(4, (4 * len(key)).bit_length())
        self.key = np.full(1 << self.bits, U64(0xFFFFFFFFFFFFFFFF))
        self.rank = np.full(1 << self.bits, NO_RANK, np.int32)
        self.probes, wait, at = 0, np.arange(len(key)), self._slot(key)
        while len(wait):  # all keys still without a place try their next slot at once; the first there gets it
            self.probes += 1
            open_ = np.flatnonzero(self.rank[at[wait]] == NO_RANK)
            slots, first = np.unique(at[wait[open_]], return_index=True)
            placed = wait[open_[first]]
            self.key[slots], self.rank[slots] = key[placed], rank[placed]
            wait = np.setdiff1d(wait, placed, assume_unique=True)
            at[wait] = (at[wait] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key ^ key >> U64(31)) * U64(0x9E3779B97F4A7C15) >> U64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(U64) << U64(32) | right.astype(U64)).ravel()
        at = self._slot(key)
        out = np.where(self.key[at] == key, self.rank[at], NO_RANK)
        seek = np.flatnonzero((self.key[at] != key) & (self.rank[at] != NO_RANK))
        for _ in range(self.probes):
            if not len(seek):
                break
            at[seek] = (at[seek] + 1) & ((1 << self.bits) - 1)
            hit = self.key[at[seek]] == key[seek]
            out[seek[hit]] = self.rank[at[seek[hit]]]
            seek = seek[~hit & (self.rank[at[seek]] != NO_RANK)]
        return out.reshape(left.shape)


class Codec:
    """Ranks of a vocabulary file, with what encoding and decoding look up."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.ranks = ranks
        # Every way to put a token together from two.
        made = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pairs = Pairs(*np.array(made, np.int64).T.reshape(3, -1)[:2], np.array([m[2] for m in made], np.int32))
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.content = np.frombuffer(b"".join(tokens), np.uint8)

    # --- encoding

    def merge(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches, end to end, and the count of each."""
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers of stretches, their counts, their ids
        size = np.array([len(s) for s in stretches], np.int64)
        bucket = np.where(size <= 16, size, 1 << np.frexp(np.maximum(size, 1) - 1)[1])
        for width in np.unique(bucket):
            pick, step = np.flatnonzero(bucket == width), max(1, CELLS // max(1, int(width)))
            for some in (pick[lo : lo + step] for lo in range(0, len(pick), step)):
                raw = np.frombuffer(b"".join(stretches[i].ljust(width, b"\0") for i in some), np.uint8).reshape(len(some), width)
                ids = np.where(np.arange(width) < size[some, None], self.byte[raw], -1)
                parts += self._merge_rows(ids, size[some].copy(), some)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        names, count, ids = map(np.concatenate, zip(*parts, strict=True))
        begin, order = np.cumsum(count) - count, np.argsort(names)
        return gather(ids, begin[order], count[order]), count[order]

    def _merge_rows(self, ids: np.ndarray, size: np.ndarray, names: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All rows of a matrix; of the rows that each round finishes, the names, counts and ids."""
        rank = np.where(np.arange(ids.shape[1] - 1) + 1 < size[:, None], self.pairs(ids[:, :-1], ids[:, 1:]), NO_RANK)
        while True:
            where = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(ids), np.int64)
            least = rank[np.arange(len(ids)), where] if rank.shape[1] else np.full(len(ids), NO_RANK)
            done = least == NO_RANK
            if done.any():
                yield names[done], size[done], ids[done][np.arange(ids.shape[1]) < size[done, None]]
            go = ~done
            if not go.any():
                return
            ids, rank, size, names, where, least = ids[go], rank[go], size[go], names[go], where[go], least[go]
            row, at = self._round(ids, rank, where, least) if rank.shape[1] >= WIDE else (np.arange(len(ids)), where)
            # Each row loses a cell per merge and is filled up to the longest row again.
            ids[row, at] = least[row]
            keep, keep_rank = np.ones(ids.shape, bool), np.ones(rank.shape, bool)
            keep[row, at + 1] = keep_rank[row, at] = False
            lost = np.bincount(row, minlength=len(ids))
            new = at - (np.arange(len(row)) - np.repeat(np.cumsum(lost) - lost, lost))  # a merge's place when those to its left are made
            size = size - lost
            if (lost == 1).all():
                ids, rank = ids[keep].reshape(len(ids), -1), rank[keep_rank].reshape(len(ids), -1)
            else:
                ids, rank = _packed(ids, keep, -1), _packed(rank, keep_rank, NO_RANK)
            for left in (new - 1, new):  # the pairs on both sides of the new token
                ok = (left >= 0) & (left + 1 < size[row])
                rank[row[ok], left[ok]] = self.pairs(ids[row[ok], left[ok]], ids[row[ok], left[ok] + 1])
                over = (left >= 0) & (left + 1 >= size[row]) & (left < rank.shape[1])
                rank[row[over], left[over]] = NO_RANK

    def _round(self, ids: np.ndarray, rank: np.ndarray, where: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and place of this round's merges, in order: the leftmost least pair, and those that would follow it."""
        row, at = np.nonzero(rank == least[:, None])
        if len(row) == len(ids):
            return row, at
        first = np.append(True, row[1:] != row[:-1])
        start = first | np.append(True, at[1:] != at[:-1] + 1)  # of pairs that overlap every second one is merged
        index = np.arange(len(row))
        alone = (index - np.maximum.accumulate(np.where(start, index, 0))) % 2 == 0
        row, at, first = row[alone], at[alone], first[alone]
        # A new pair as low as the merged one would be merged before the next: then the row merges its leftmost alone.
        token, low = least[row], np.full(len(row), NO_RANK)
        left, right = at > 0, at + 2 < ids.shape[1]
        low[left] = self.pairs(ids[row[left], at[left] - 1], token[left])
        low[right] = np.minimum(low[right], self.pairs(token[right], ids[row[right], at[right] + 2]))
        low = np.minimum(low, self.pairs(token, token))
        beside = np.flatnonzero((row[1:] == row[:-1]) & (at[1:] == at[:-1] + 3))  # a cell between two new tokens
        low[beside] = np.minimum(low[beside], self.pairs(ids[row[beside], at[beside] + 2], token[beside]))
        risky = np.zeros(len(ids), bool)
        risky[row[low <= token]] = True
        keep = first | ~risky[row]
        return row[keep], at[keep]

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.content, self.begin[ids], self.length[ids]).tobytes()


def _packed(cells: np.ndarray, keep: np.ndarray, fill: int) -> np.ndarray:
    """The kept cells of each row side by side, filled up to the longest row."""
    count = keep.sum(axis=1)
    out = np.full((len(cells), int(count.max())), fill, cells.dtype)
    out[np.arange(out.shape[1]) < count[:, None]] = cells[keep]
    return out


class Remembering:
    """A task's encoder, with the stretches and the pieces between spaces that it has met."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.pieces = Known(self._pieces)
        self.stretches = Known(lambda new: codec.merge([s.encode("utf-8", "surrogatepass") for s in new]))

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.stretches.flat(list(map(self.codec.pattern.findall, pieces)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as 32-bit integers."""
        return self.pieces([PIECE.findall(t) for t in texts])


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and ids (array of int) of each whole text; null and empty texts have none. One row out per row in, also for
    repeated rows; equal texts have equal ids."""
    path, pattern = path or vocabulary()[0], pattern or vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Remembering(codec(path, pattern))
        for batch in slices(batches, most=PIECES):
            ids = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts_of(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids count as none."""
    path, pattern = path or vocabulary()[0], pattern or vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [codec(path, pattern).decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.binary())], names=["doc_id", "content"])

    return df.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids").mapInArrow(run, "doc_id long, content binary")


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (as little-endian unsigned 32-bit integers), content (the bytes decoded from the ids)."""
    path, pattern = path or vocabulary()[0], pattern or vocabulary()[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Remembering(codec(path, pattern))
        for batch in slices(batches, most=PIECES):
            ids = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            cols = [[len(x) for x in ids], [x.astype("<u4").tobytes() for x in ids], [encoder.codec.decode(x) for x in ids]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols, [pa.int64(), pa.binary(), pa.binary()])], names=["doc_id", "n_tokens", "ids", "content"])

    return texts_of(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, content binary")
