"""Rolling quantiles and trimmed means of series, by order statistics that slide along with the window.

Rows are dealt out by series and sorted once. A task goes through them row by row; per window it holds the last values, a
sorted list of them in blocks, and running sums, so a row costs a search among the window's values, not a look at all of
them, and a series of any length needs the memory of its windows.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values in a block of a sorted list; a full one is cut in two.
BLOCK = 512


class SortedWindow:
    """Numbers in order, in blocks: adding, removing and finding the k-th cost a search in one block."""

    __slots__ = ("blocks", "size")

    def __init__(self) -> None:
        self.blocks: list[list[float]] = [[]]
        self.size = 0

    def _block(self, value: float) -> int:
        lo, hi = 0, len(self.blocks) - 1
        while lo < hi:  # the first block whose last value isn't smaller
            mid = (lo + hi) // 2
            if self.blocks[mid][-1] < value:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def add(self, value: float) -> None:
        at = self._block(value) if len(self.blocks) > 1 else 0
        block = self.blocks[at]
        insort(block, value)
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]

    def remove(self, value: float) -> None:
        at = self._block(value) if len(self.blocks) > 1 else 0
        block = self.blocks[at]
        del block[bisect_left(block, value)]
        self.size -= 1
        if not block and len(self.blocks) > 1:
            del self.blocks[at]

    def nth(self, k: int) -> float:
        if len(self.blocks) > 1:
            for block in self.blocks:
                if k < len(block):
                    return block[k]
                k -= len(block)
        return self.blocks[0][k]

    def quantile(self, q: float) -> float:
        """The least value that a share q of the values doesn't exceed."""
        return self.nth(max(0, math.ceil(q * self.size) - 1))


class Sum:
    """The count and the sum of the last n entries, None apart; the sum is taken anew once in n entries, so errors don't pile up."""

    __slots__ = ("count", "held", "n", "since", "total")

    def __init__(self, n: int):
        self.n, self.held, self.count, self.total, self.since = n, deque(), 0, 0.0, 0

    def push(self, value: float | None) -> float | None:
        """The entry that falls out, if any."""
        self.held.append(value)
        old = self.held.popleft() if len(self.held) > self.n else None
        if value is not None:
            self.count += 1
            self.total += value
        if old is not None:
            self.count -= 1
            self.total -= old
        self.since += 1
        if self.since >= self.n:
            self.total, self.since = math.fsum(x for x in self.held if x is not None), 0
        return old

    def mean(self) -> float | None:
        return self.total / self.count if self.count else None


class Trimmed:
    """Trimmed means of one series: per window the mean of the values that lie within the quantiles of their own windows."""

    def __init__(self, windows: tuple[int, ...], low: float, high: float, least: int):
        self.low, self.high, self.least = low, high, least
        self.windows = [(SortedWindow(), Sum(n), Sum(n)) for n in windows]
        self.longest = max(range(len(windows)), key=windows.__getitem__)

    def push(self, value: float | None) -> list[float]:
        found: list[float | None] = []
        for ordered, plain, inside in self.windows:
            old = plain.push(value)
            if old is not None:
                ordered.remove(old)
            if value is not None:
                ordered.add(value)
                inside.push(value if ordered.quantile(self.low) <= value <= ordered.quantile(self.high) else None)
            else:
                inside.push(None)
            mean = inside.mean() if plain.count >= self.least else None
            found.append(plain.mean() if mean is None else mean)
        last = self.windows[self.longest][1].mean()
        return [x if x is not None else last if last is not None else 0.0 for x in found]


class Band:
    """The values of one series that lie within the quantiles of their own window."""

    def __init__(self, rows: int, low: float, high: float):
        self.low, self.high, self.ordered, self.plain = low, high, SortedWindow(), Sum(rows)

    def push(self, value: float | None) -> list[float | None]:
        old = self.plain.push(value)
        if old is not None:
            self.ordered.remove(old)
        if value is None:
            return [None]
        self.ordered.add(value)
        return [value if self.ordered.quantile(self.low) <= value <= self.ordered.quantile(self.high) else None]


def _new_series(batch: pa.RecordBatch, keys: list[int], last: list | None) -> tuple[np.ndarray, list]:
    """Which rows begin a series, and the keys of the last row."""
    first = np.zeros(batch.num_rows, bool)
    now = [batch.column(k)[0].as_py() for k in keys]
    first[0] = last is None or now != last
    for k in keys:
        column = batch.column(k)
        a, b = column.slice(1), column.slice(0, batch.num_rows - 1)
        differ = pc.if_else(pc.and_(pc.is_valid(a), pc.is_valid(b)), pc.fill_null(pc.not_equal(a, b), True), pc.not_equal(pc.is_valid(a), pc.is_valid(b)))
        first[1:] |= differ.to_numpy(zero_copy_only=False)
    return first, [batch.column(k)[batch.num_rows - 1].as_py() for k in keys]


def along_series(df: DataFrame, keys: list[str], order: str, value: str, names: list[str], start: Callable[[], object]) -> DataFrame:
    """df with a double column per name: what start().push(value) gives, row after row of each series, in order.

    A series is the rows of equal keys, null being a key of its own; NaN counts as null. Rows of equal order come in any
    order. One shuffle by the keys and one sort; an empty table gives an empty result.
    """
    for name in names:
        if name in df.columns:
            df = df.drop(name)
    at, by = df.columns.index(value), [df.columns.index(k) for k in keys]
    schema = df.schema
    for name in names:
        schema = schema.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, series = None, start()
        for batch in batches:
            if not batch.num_rows:
                continue
            first, last = _new_series(batch, by, last)
            out = []
            for new, x in zip(first.tolist(), batch.column(at).cast(pa.float64()).to_pylist(), strict=True):
                if new:
                    series = start()
                out.append(series.push(None if x is None or x != x else x))
            columns = [pa.array(c, pa.float64()) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return df.repartition(*keys).sortWithinPartitions(*[F.col(k) for k in keys], F.col(order)).mapInArrow(run, schema)
