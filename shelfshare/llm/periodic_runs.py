"""Periodic runs of words: stretches that repeat a group of q words at least four times, found on the diagonals of equal words.

Word i and its earlier occurrence i-d lie on diagonal (lag) d. An online scan holds the lags that match just now with their
match lengths; each word's earlier occurrences lengthen theirs, and a lag that ends with enough matches is a run at once.

Lags are scanned in classes [2^k, 2^(k+1)), the small ones first. A run of the class needs 3 * 2^k matches in a row, and each
of these words has an earlier occurrence closer than 2^(k+1). Three consequences keep the diagonals few, and lose no run:
only stretches of so many such words are scanned; a lag need only be opened at every (3 * 2^k)-th word, taking in the matches
behind it; and inside a run of period p only multiples of p match for long, which say nothing new, so its interior is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PIECE_BYTES, U64, gather, map_texts, mix, run_hashes, texts_of, utf8, words

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_TIMES = 6, 4
FAR = np.int64(1 << 62)
Run = tuple[int, int, int]


def word_gaps(word: np.ndarray) -> np.ndarray:
    """How far back each word's last occurrence lies; FAR for a first one."""
    order = np.argsort(word, kind="stable")
    ordered = word[order]
    again = ordered[1:] == ordered[:-1]
    gaps = np.full(len(word), FAR)
    gaps[order[1:][again]] = (order[1:] - order[:-1])[again]
    return gaps


def _stretches(member: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of the stretches of at least so many true entries."""
    out = np.flatnonzero(~member)
    start, end = np.append(0, out + 1), np.append(out, len(member))
    long = end - start >= least
    return list(zip(start[long].tolist(), end[long].tolist(), strict=True))


def _least_matches(lag: int) -> int:
    return max(LEAST_WORDS - lag, (LEAST_TIMES - 1) * lag)


def _same_back(word: np.ndarray, at: int, lag: int, low: int) -> int:
    """How many words before `at`, down to `low`, equal those a lag earlier."""
    count, step = 0, 16
    low = max(low, lag)
    while at - count > low:
        lo = max(low, at - count - step)
        differs = np.flatnonzero(word[lo : at - count] != word[lo - lag : at - count - lag])
        if len(differs):
            return count + (at - count - lo) - 1 - int(differs[-1])
        count, step = at - lo, step * 4
    return count


def _same_ahead(word: np.ndarray, at: int, lag: int) -> int:
    """How many words from `at` on equal those a lag earlier."""
    count, step = 0, 16
    while at + count < len(word):
        hi = min(len(word), at + count + step)
        differs = np.flatnonzero(word[at + count : hi] != word[at + count - lag : hi - lag])
        if len(differs):
            return count + int(differs[0])
        count, step = hi - at, step * 4
    return count


def _scan(word: np.ndarray, plain: list[int], lo: int, hi: int, low_lag: int, every: int, emit) -> None:
    """The lags from low_lag to twice that over the words from lo to hi; emit(first match, match length, lag) for each that ends with enough."""
    active: dict[int, int] = {}  # lag: match length up to the word before i
    i = lo
    while i < hi:
        if (i - lo) % every == every - 1:  # lags may open here
            first = max(0, i - 2 * low_lag + 1)
            for j in np.flatnonzero(word[first : i - low_lag + 1] == word[i]).tolist():  # the earlier occurrences
                lag = i - first - j
                if lag not in active:
                    active[lag] = _same_back(word, i, lag, max(lo, i - every))
        elif not active:
            i += every - 1 - (i - lo) % every  # nothing matches until lags may open again
            continue
        here = plain[i]
        longer = {lag: m + 1 for lag, m in active.items() if plain[i - lag] == here}
        if len(longer) < len(active):
            for lag, m in active.items():
                if lag not in longer and m >= _least_matches(lag):
                    emit(i - m, m, lag)
        active, i = longer, i + 1
    for lag, m in active.items():
        if m >= _least_matches(lag):
            emit(hi - m, m, lag)


def periodic_runs(word: np.ndarray, gaps: np.ndarray | None = None) -> list[Run]:
    """(start, length, period) of every run, by start, then period, given a number per word.

    A run is a stretch with smallest period q and a length of at least max(6, 4q) that neither neighbour extends keeping q.
    Words of several documents may follow each other, if no number occurs in two of them: runs then stay within documents.
    """
    gaps = word_gaps(word) if gaps is None else gaps
    found: dict[tuple[int, int], int] = {}  # (start, end): smallest period
    plain: list[int] = []

    def emit(first: int, matches: int, lag: int) -> None:
        matches += _same_ahead(word, first + matches, lag)  # matches may go on where the scanned part ends
        before = _same_back(word, first, lag, 0)
        start, end = first - before - lag, first + matches
        found.setdefault((start, end), lag)  # a stretch with a divisor of lag as its period is there already, from a smaller lag

    low_lag = 1
    while LEAST_TIMES * low_lag <= len(word):
        every = _least_matches(low_lag)
        earlier = sorted((s, e, p) for (s, e), p in found.items() if e - s >= p + 2 * low_lag)  # too long to lie inside a run of this class
        for lo, hi in _stretches(gaps < 2 * low_lag, every):
            parts = [(lo, hi)]
            over = [(s, e, p) for s, e, p in earlier if s < hi and e > lo]
            if over:
                open_, outside = np.ones(hi - lo, bool), np.ones(hi - lo, bool)
                for s, e, p in over:
                    outside[max(0, s - lo) : e - lo] = False
                    open_[max(0, s + p + 2 * low_lag - lo) : max(0, e - p - lo)] = False
                parts = [(lo + a, lo + b) for a, b in _stretches(open_, every) if outside[a:b].any()]
            if parts and not plain:
                plain = word.tolist()
            for a, b in parts:
                _scan(word, plain, a, b, low_lag, every, emit)
        low_lag *= 2
    return sorted((s, e - s, p) for (s, e), p in found.items())


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """The words of each row with one space between them."""
    size = end - start + 1
    out = gather(np.append(data, np.uint8(32)), start, size).copy()
    stop = np.cumsum(size)
    out[stop - 1] = 32
    count = np.bincount(row, weights=size, minlength=rows).astype(np.int64)
    last = np.cumsum(count)[count > 0] - 1
    out = np.delete(out, last)  # no space after a row's last word
    offsets = np.append(0, np.cumsum(np.maximum(count - 1, 0)))
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _piece(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = utf8(batch.column("text"))
    start, end = words(data, offsets)
    n = batch.num_rows
    row = np.searchsorted(offsets, start, "right") - 1
    word = mix(run_hashes(data, start, end) + row.astype(U64) * U64(0x9E3779B97F4A7C15))  # equal words of two rows differ
    first = np.searchsorted(row, np.arange(n + 1))
    gaps = word_gaps(word)
    runs, keep = [[] for _ in range(n)], np.ones(len(word), bool)
    # All rows at once: a first look at which words can lie in a run at all.
    maybe = np.zeros(n, bool)
    low_lag = 1
    while LEAST_TIMES * low_lag <= len(word):
        for lo, hi in _stretches(gaps < 2 * low_lag, _least_matches(low_lag)):
            maybe[row[lo]] = True
        low_lag *= 2
    for r in np.flatnonzero(maybe).tolist():
        lo, hi = first[r], first[r + 1]
        _, code = np.unique(word[lo:hi], return_inverse=True)
        runs[r] = periodic_runs(code, gaps[lo:hi])
        for s, length, period in runs[r]:
            keep[lo + s + period : lo + s + length] = False
    lists = pa.array([[{"start": s, "length": x, "period": p} for s, x, p in own] for own in runs], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))
    collapsed = _joined(data, start[keep], end[keep], row[keep], n)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first)), lists, collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """doc_id, n_words, runs, collapsed: of each whole text its words, its periodic runs by start and period, and the text without repeats.

    A run's words beyond its first period are left out of `collapsed`, whose words are joined by one space. Words are told
    apart by 64-bit hashes. One row out per row in, also for null and repeated ids, each judged by its own text; a null or
    empty text, or one of blanks, has no words, no runs and an empty `collapsed`. An empty table gives an empty result.
    Nothing is shuffled, and a task holds the words of one piece of `piece_bytes` of text, or of one longer text.
    """
    return map_texts(texts_of(df, id_col, text_col), _piece, SCHEMA, piece_bytes)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length/period; of equal ones that of the smallest start, then period. Null without runs."""

    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(F.array_sort(runs), F.lit(None).cast(kind), better)
