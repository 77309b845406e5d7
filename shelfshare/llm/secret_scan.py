"""Secret scan: three fixed patterns, and values in a credential context that would cost many guesses.

The cost of a value is the least total over all ways to cut it into dictionary words, dates, repeats, keyboard walks and
brute-force stretches; it is found by dynamic programming from left to right, as log10 of guesses. A value that costs at
least `strong` is a finding of kind `guess`. The dictionary is the ranked letter-only entries of a public vocabulary file.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, numbered, slices, texts_of

KINDS = ("assign", "access", "hex", "guess")
# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
#: Where a credential is named, or stands in a URL; the value is the group.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth)["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*["']?([^\s"'<>,;|]{4,})""",
    re.I | re.A,
)
USERINFO = re.compile(r"://[^\s/:@]+:([^\s/@]{4,})@")

#: Rows of a keyboard, shifted keys below; a key's neighbours stand beside it in its row and in the next rows.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
PLACE = {c: (r, i + r * 0.5) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
LEET = str.maketrans("4@301!5$7", "aaeoiisst")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d)")
LONGEST_WORD, LONGEST_UNIT, LONGEST_DATE = 16, 16, 10
SEGMENT = math.log10(2)
STRONG = 8.0


@cache
def dictionary(path: str) -> dict[str, float]:
    """log10 of the rank of each letter-only entry of 3 letters or more."""
    out: dict[str, float] = {}
    with open(path, "rb") as lines:
        for line in lines:
            word = base64.b64decode(line.split()[0]).decode("utf-8", "ignore").strip().lower()
            if 3 <= len(word) <= LONGEST_WORD and word.isalpha():
                out.setdefault(word, math.log10(len(out) + 2))
    return out


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


def _step(a: str, b: str) -> tuple[int, int] | None:
    """How the finger moves between neighbouring keys, or None."""
    p, q = PLACE.get(SHIFTED.get(a, a.lower())), PLACE.get(SHIFTED.get(b, b.lower()))
    if not p or not q or p == q or abs(p[0] - q[0]) > 1 or abs(p[1] - q[1]) > 1:
        return None
    return q[0] - p[0], (q[1] > p[1]) - (q[1] < p[1])


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """Maximal keyboard walks of 3 keys or more: a start, a length and the turns must be guessed."""
    at, n = 0, len(value)
    while at < n - 2:
        end, turns, last = at, 0, None
        while end + 1 < n and (move := _step(value[end], value[end + 1])):
            turns += move != last
            last, end = move, end + 1
        if end - at >= 2:
            yield at, end + 1, math.log10(47 * (end - at)) + turns * math.log10(4)
        at = max(end, at + 1)


def _repeats(value: str) -> Iterator[tuple[int, int, float]]:
    """Maximal stretches that repeat a unit: the unit and the number of times must be guessed."""
    n = len(value)
    for unit in range(1, min(LONGEST_UNIT, n // 2) + 1):
        at = 0
        while at + 2 * unit <= n:
            end = at + unit
            while end < n and value[end] == value[end - unit]:
                end += 1
            times = (end - at) // unit
            if times >= (3 if unit == 1 else 2):
                yield at, at + times * unit, sum(map(_brute, value[at : at + unit])) + math.log10(times)
            at = max(at + 1, end - unit + 1)


def guess_cost(value: str, ranks: dict[str, float]) -> float:
    """log10 of the guesses of the cheapest segmentation; 0 for an empty value. Time grows with the length of the value alone."""
    n = len(value)
    plain = value.lower()
    plain = plain if len(plain) == n else value
    leet = plain.translate(LEET)
    spans: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in (*_walks(value), *_repeats(value)):
        spans.setdefault(end, []).append((start, cost))
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for end in range(1, n + 1):
        char = _brute(value[end - 1])
        brute[end] = min(brute[end - 1], best[end - 1] + SEGMENT) + char
        least = brute[end]
        for start in range(max(0, end - LONGEST_WORD), end - 2):
            rank = ranks.get(plain[start:end])
            extra = 0.0
            if rank is None and leet[start:end] != plain[start:end]:
                rank, extra = ranks.get(leet[start:end]), 2 * SEGMENT
            if rank is not None:
                extra += SEGMENT if value[start:end] != plain[start:end] else 0
                least = min(least, best[start] + SEGMENT + rank + extra)
        if value[end - 1].isdigit():
            for start in range(max(0, end - LONGEST_DATE), end - 3):
                if found := DATE.fullmatch(value, start, end):
                    least = min(least, best[start] + SEGMENT + math.log10(365 * 50 if end - start > 4 else 140) + (SEGMENT if found[1] or found[2] else 0))
        for start, cost in spans.get(end, ()):
            least = min(least, best[start] + SEGMENT + cost)
        best[end] = least
    return best[n]


def find(text: str, ranks: dict[str, float], strong: float = STRONG) -> list[tuple[int, int, int, float]]:
    """(start, end, kind, cost) of every finding, by start and kind; cost is 0 for the base kinds."""
    out = []
    if ":" in text or "=" in text:  # every assignment and context has one
        out += [(m.start(), m.end(), 0, 0.0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
        values = {m.span(1) for p in (CONTEXT, USERINFO) for m in p.finditer(text)}
        costs = ((a, b, guess_cost(text[a:b], ranks)) for a, b in values)
        out += [(a, b, 3, cost) for a, b, cost in costs if cost >= strong]
    out += [(m.start(), m.end(), 1, 0.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # A run of hex digits shorter than the least can't match, so the bounded form finds the same runs.
    out += [(m.start(), m.end(), 2, 0.0) for m in HEX.finditer(text)]
    return sorted(out)


def _joined(found: list[tuple[int, int, int, float]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind, _ in found)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", strong: float = STRONG, words: str | None = None) -> DataFrame:
    """Findings per row: doc_id, counts per kind, the digest of the base spans, all spans, the highest guess cost.

    Null or empty text has no findings and keeps its row; repeated rows give repeated results; an empty table gives none.
    """
    words = words or vocabulary()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranks, rows = dictionary(words), []
        for text in batch.column("text").to_pylist():
            found = find(text or "", ranks, strong)
            base = [x for x in found if x[2] < 3]
            counts = [sum(x[2] == k for x in found) for k in range(4)]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found), max((x[3] for x in found), default=0.0)))
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans", "max_cost"])

    return map_texts(texts_of(df, id_col, text_col), run, "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, max_cost double")


MASK = "[SECRET]"


def mask(text: str, found: list[tuple[int, int, int, float]]) -> str:
    """text with every found stretch, overlapping ones as one, replaced by MASK."""
    out, done, end = [], 0, -1
    for start, stop, *_ in found:
        if start > end:
            out += [text[done:start], MASK]
        end = max(end, stop)
        done = end
    return "".join([*out, text[done:]])


def redact(df: DataFrame, text_col: str = "text", strong: float = STRONG, words: str | None = None) -> DataFrame:
    """df with the secrets in text_col masked and all other columns and rows as they are; null text stays null."""
    words = words or vocabulary()
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = dictionary(words)
        for batch in slices(batches, at):
            new = [None if t is None else mask(t, find(t, ranks, strong)) for t in batch.column(at).to_pylist()]
            cols = list(batch.columns)
            cols[at] = pa.array(new, batch.schema.types[at])
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return numbered(df).mapInArrow(run, df.schema)


def redact_documents(docs: DataFrame) -> DataFrame:
    """Documents with masked texts; n_chars, if there is such a column, follows where a text changed."""
    out = redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").contains(MASK), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
