"""Packing documents into sequences of bounded length, in order.

The tokens of a task's documents stand in a row. Dynamic programming chooses where to cut it: a window costs its padding, a
cut inside a document a truncation penalty, a larger one if no sentence ends there. Since padding falls by one with each
token, the best start of a window that ends at j is the least of cost(i) + position(i) over the places i within reach,
which a monotone queue holds ready. Windows whose length is a power of two aren't padded, so those starts are tried too.
The plan is the cheapest one for each block of tokens; what the last window of a block holds goes into the next block.
"""

from __future__ import annotations

import re
import unicodedata
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import U64, Known, gather, run_hashes, slices, texts_of

CAPACITY, END = 4096, 2
#: Costs in tokens of padding: of a sequence, of a cut at a sentence's end, of a cut elsewhere.
SEQUENCE, SENTENCE, HARD = 8, 24, 160
#: Where no sentence or document ends for so many tokens, places in between are tried.
FAR = 128
#: Words that a task remembers.
KNOWN = 400_000
#: Tokens that are planned together.
BLOCK = 1 << 19
#: Characters that end a sentence.
STOPS = ".!?\u2026\u3002\uff01\uff1f"

#: Characters of which it is known how the tokenizer lower-cases and splits them: those up to U+024F, but for the capital I
#: with a dot, whose lower case is two characters. A stretch with others is left to the library.
PLAIN = re.compile("[\x00-\u012f\u0131-\u024f]*")
_lower = sorted({chr(i).lower() for i in range(0x250) if i != 0x130})
_LETTERS, _DIGITS = (re.escape("".join(c for c in _lower if unicodedata.category(c)[0] == kind)) for kind in "LN")
# White space and the pattern of a word, as the tokenizer's file has them.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
STRETCH = re.compile(f"[^{_WHITE}]+")
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_WHITE}{_LETTERS}{_DIGITS}]+")
#: The tokenizer writes each byte of a word as one character: visible ones as themselves, the others from U+0100 on.
_seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _seen)}


class WordTokenizer:
    """ids by the tokenizers library. Texts are cut into its words here, so that each word is encoded once per task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        back = {ord(c): b for b, c in BYTES.items()} | {b: b for b in _seen}
        names = [(self.tokenizer.id_to_token(i) or "").removesuffix("</w>") for i in range(self.tokenizer.get_vocab_size())]
        texts = [bytes(back[ord(c)] for c in n if ord(c) in back).decode("utf-8", "ignore") for n in names]
        self.ends = np.array([any(c in STOPS for c in t) and not any(c.isalnum() for c in t) for t in texts])

    def words(self, text: str) -> list[str]:
        """The words of a text, lower-cased; a space stands before a stretch that the library is to take whole."""
        if text.isascii() or PLAIN.fullmatch(text):
            return WORD.findall(text.lower())
        out: list[str] = []
        for stretch in STRETCH.findall(text):
            out += WORD.findall(stretch.lower()) if PLAIN.fullmatch(stretch) else [f" {stretch}"]
        return out

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, end to end, and the count of each."""
        ids: list[int] = []
        ends, tokenize = [0], self.model.tokenize
        for word in words:
            if word[0] == " ":
                ids += self.tokenizer.encode(word[1:], add_special_tokens=False).ids
            else:
                ids += [t.id for t in tokenize(word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(BYTES))]
            ends.append(len(ids))
        return np.array(ids, np.int32), np.diff(ends)


_codes = np.arange(0x250)
#: Lower case of each plain character; its kind: 0 white space, 1 letter, 2 digit, 3 any other; two random numbers each.
SMALL = np.array([ord(chr(i).lower()) if i != 0x130 else 0 for i in _codes], np.uint16)
_white = set(map(chr, [*range(9, 14), 32, 0x85, 0xA0]))
KIND = np.array([0 if chr(i) in _white else {"L": 1, "N": 2}.get(unicodedata.category(chr(SMALL[i]))[0], 3) for i in _codes], np.int8)
VALUES = np.random.default_rng(13).integers(1, 1 << 63, (2, int(SMALL.max()) + 1), dtype=np.uint64) * U64(2) + U64(1)
_APOSTROPHE = ord("'")


def word_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What WORD finds in plain characters: their lower case, and each word's start and end."""
    small, kind = SMALL[codes], KIND[codes]
    if not len(codes):
        return small, np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.append(True, (kind[1:] != kind[:-1]) | (kind[1:] == 2))
    start = np.flatnonzero(cut)
    end, of = np.append(start[1:], len(codes)), kind[start]
    # A lone apostrophe takes the letters of a short form from the word after it.
    lone = np.flatnonzero((small[start[:-1]] == _APOSTROPHE) & (end[:-1] - start[:-1] == 1) & (of[1:] == 1)) if len(start) > 1 else start[:0]
    if len(lone):
        a = small[end[lone]]
        b = np.where(end[lone] + 1 < end[lone + 1], small[np.minimum(end[lone] + 1, len(small) - 1)], 0)
        takes = np.where(np.isin(a, list(map(ord, "stmd"))), 1, np.where((a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")), 2, 0))
        end[lone] += takes
        start[lone + 1] += takes
    real = (of > 0) & (end > start)
    return small, start[real], end[real]


class Remembering:
    """A task's tokenizer, with the words that it has met. Words of plain characters are told apart by two 64-bit hashes."""

    def __init__(self, tokenizer: WordTokenizer, most: int):
        self.tokenizer, self.most, self.others = tokenizer, most, Known(tokenizer.ids, most)
        self.forget()

    def forget(self) -> None:
        self.names, self.place = np.zeros(0, U64), np.zeros(0, np.int64)  # first hashes in order, and where their words are kept
        self.check, self.ids, self.at, self.count = (np.zeros(0, t) for t in (U64, np.int32, np.int64, np.int64))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        plain = [t.isascii() or PLAIN.fullmatch(t) is not None for t in texts]
        found = iter(self._plain([t for t, p in zip(texts, plain, strict=True) if p]))
        rest = iter(self.others([self.tokenizer.words(t) for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(found if p else rest) for p in plain]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text of plain characters; a line break, which is no word, stands between the texts."""
        if not texts:
            return []
        small, start, end = word_runs(np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32))
        first, second = (run_hashes(small, start, end, v) for v in VALUES)
        names, some, each = np.unique(first, return_index=True, return_inverse=True)
        if (second[some][each] != second).any():
            return self.others([self.tokenizer.words(t) for t in texts])
        if len(self.names) > self.most:
            self.forget()
        where = np.searchsorted(self.names, names)
        hit = np.append(self.names, ~U64(0))[where] == names
        place = np.where(hit, np.append(self.place, -1)[where], -1)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            content = small.tobytes().decode("utf-16-le")
            ids, count = self.tokenizer.ids([content[a:b] for a, b in zip(start[some[missing]].tolist(), end[some[missing]].tolist(), strict=True)])
            place[missing] = len(self.names) + np.arange(len(missing))
            self.names, self.place = (np.insert(old, where[missing], new[missing]) for old, new in ((self.names, names), (self.place, place)))
            self.at = np.append(self.at, len(self.ids) + np.cumsum(count) - count)
            self.ids, self.count = np.append(self.ids, ids), np.append(self.count, count)
            self.check = np.append(self.check, second[some[missing]])
        if (self.check[place] != second[some]).any():
            return self.others([self.tokenizer.words(t) for t in texts])
        word = place[each]
        stop = np.cumsum([len(t) + 1 for t in texts])
        total = np.append(0, np.cumsum(self.count[word]))
        return np.split(gather(self.ids, self.at[word], self.count[word]), total[np.searchsorted(start, stop[:-1])])


@cache
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def places(ends: np.ndarray, docs: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a cut is tried, from 0 to total, and its penalty; ends are the places after sentences, docs those after documents."""
    cost = np.full(total + 1, -1, np.int16)
    cost[ends] = SENTENCE
    cost[docs] = cost[0] = cost[total] = 0
    at = np.flatnonzero(cost >= 0)
    far = np.flatnonzero(np.diff(at) > FAR)
    for lo, hi in zip(at[far].tolist(), at[far + 1].tolist(), strict=True):
        cost[lo + FAR : hi : FAR] = HARD
    at = np.flatnonzero(cost >= 0)
    return at, cost[at].astype(float)


def plan(at: np.ndarray, fee: np.ndarray, capacity: int = CAPACITY, least: int | None = None) -> list[int]:
    """The chosen places, first and last included: windows of at most capacity with the least cost in all.

    Neighbouring places must not be further apart than capacity. Of equal costs the later start wins. Windows without
    padding, of a power of two, are tried from `least` tokens on, an eighth of the capacity if it isn't given.
    """
    n, size = len(at), least or capacity >> 3
    exact: dict[int, list[int]] = {}
    while size < capacity:
        i = np.searchsorted(at, at - size)
        hit = np.flatnonzero((at >= size) & (at[np.minimum(i, n - 1)] == at - size))
        for j, e in zip(hit.tolist(), i[hit].tolist(), strict=True):
            exact.setdefault(j, []).append(e)
        size *= 2
    at, fee = at.tolist(), fee.tolist()
    best, come = [0.0] * n, [0] * n
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])  # cost + place, place, index; rising costs
    for j in range(1, n):
        p = at[j]
        while queue[0][1] < p - capacity:
            queue.popleft()
        key, _, i = queue[0]
        cost = key + capacity - p
        for e in exact.get(j, ()):
            if best[e] < cost:
                cost, i = best[e], e
        best[j], come[j] = cost + fee[j] + SEQUENCE, i
        key = best[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    chosen, j = [n - 1], n - 1
    while j:
        j = come[j]
        chosen.append(j)
    return [at[j] for j in reversed(chosen)]


def _powers(start: int, end: int, capacity: int) -> list[int]:
    """The places that cut the last window into powers of two, if that costs less than its padding; else its end."""
    size = end - start
    parts = [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]
    if (len(parts) - 1) * (HARD + SEQUENCE) >= capacity - size:
        return [end]
    return (start + np.cumsum(parts)).tolist()


class Packer:
    """Packs documents as they come and gives out their pieces; what the last window holds waits for more."""

    def __init__(self, first_id: int, ends: np.ndarray, capacity: int, block: int = BLOCK):
        self.sequence, self.ends, self.capacity, self.block = first_id, ends, capacity, block
        self.docs: list[tuple[int | None, np.ndarray, int, int]] = []  # id, tokens, place of the first of them in the document, the document's tokens
        self.waiting = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.waiting += len(ids)
        if self.waiting >= self.block:
            yield from self.flush(False)

    def flush(self, last: bool = True) -> Iterator[tuple]:
        """doc_id, start, tokens, doc_tokens, sequence_id, offset of each piece of the windows that are full."""
        if not self.docs:
            return
        tokens = np.concatenate([d[1] for d in self.docs])
        stop = np.cumsum([len(d[1]) for d in self.docs])
        cuts = plan(*places(np.flatnonzero(self.ends[tokens]) + 1, stop, len(tokens)), self.capacity)
        if last:
            cuts = cuts[:-1] + _powers(cuts[-2], cuts[-1], self.capacity)
        elif len(cuts) > 2:
            cuts = cuts[:-1]
        else:
            return
        # Pieces end where windows or documents do.
        edge = np.unique(np.concatenate([cuts, stop[stop < cuts[-1]]]))
        doc = np.searchsorted(stop, edge[:-1], "right")
        window = np.searchsorted(cuts, edge[:-1], "right") - 1
        for lo, hi, d, w in zip(edge[:-1].tolist(), edge[1:].tolist(), doc.tolist(), window.tolist(), strict=True):
            doc_id, own, start, whole = self.docs[d]
            yield doc_id, start + lo - (int(stop[d]) - len(own)), tokens[lo:hi], whole, self.sequence + w, lo - cuts[w]
        self.sequence += len(cuts) - 1
        done = int(np.searchsorted(stop, cuts[-1], "right"))
        rest = []
        for doc_id, own, start, whole in self.docs[done:]:
            skip = max(0, len(own) - (int(stop[done]) - cuts[-1])) if not rest else 0
            rest.append((doc_id, own[skip:], start + skip, whole))
        self.docs, self.waiting = rest, sum(len(d[1]) for d in rest)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, known: int = KNOWN) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's tokens are its ids and END; null and empty texts have END alone. Each task packs the rows it reads, in their
    order, and holds BLOCK tokens and one document at a time; nothing is shuffled. A sequence is of one task; its id holds
    the task's number. Rows of one id are documents of their own, repeated rows too; an empty table gives no pieces.
    capacity must be a power of two. known is how many words a task remembers the ids of: memory against time, results are
    the same.
    """
    path = path or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Remembering(tokenizer(path), known)
        packer = Packer(TaskContext.get().partitionId() << 36, encode.tokenizer.ends, capacity)

        def rows(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            got = list(pieces)
            if got:
                doc, start, ids, whole, sequence, offset = zip(*got, strict=True)
                cols = [doc, start, [len(x) for x in ids], [x.astype("<u4").tobytes() for x in ids], whole, sequence, offset]
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays(list(map(pa.array, cols, kinds)), names=NAMES)

        for batch in slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode([t or "" for t in batch.column("text").to_pylist()]), strict=True):
                yield from rows(packer.add(doc_id, np.append(ids, np.int32(END))))
        yield from rows(packer.flush())

    return texts_of(df, id_col, text_col).mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
