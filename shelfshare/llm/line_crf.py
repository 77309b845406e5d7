"""Line labelling: a linear-chain conditional random field marks each line as content or boilerplate.

Every line gets byte-level features; Viterbi decoding over the whole document finds the likeliest labels; a document stays
if content lines hold enough of its characters.

Documents have labels, lines have none. So the lines' labels are latent, with evidence for each line: its document's label
says a little, that it stands among different lines in other documents, was there before in its own, or is full of symbols
says more. Training maximises the likelihood of the labels that the evidence allows, weighted by it: forward and backward
sums run once with the evidence and once without, and the weights follow the difference. The sample is bounded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, map_texts, run_hashes, share_of, slices, texts_of, utf8, words

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
LEAST_WORDS, SHARE = 50, 0.5
#: About so many training documents at most, of each so many stretches of lines, spread evenly, of so many lines.
SAMPLE, STRETCHES, STRETCH, ROUNDS = 3000, 4, 32, 100
#: Log odds of content: by the document's label, of a line that other documents have elsewhere, one that is repeated, one of symbols.
BY_LABEL, SHARED, REPEATED, SYMBOLS = 1.5, -5.0, -3.0, -3.0
#: A line is shared if it stands between so many different pairs of lines; one in so many bytes makes it full of symbols.
CONTEXTS, SYMBOL_SHARE = 3, 0.1
#: Buckets of words, each with a weight from how often its words are in lines that evidence speaks against.
WORDS = 1 << 12

_byte = np.arange(256)
CLASS = {
    "space": np.isin(_byte, [9, 10, 11, 12, 13, 32]),
    "upper": (_byte >= 65) & (_byte <= 90),
    "letter": (_byte >= 128) | ((_byte | 32) >= 97) & ((_byte | 32) <= 122),
    "digit": (_byte >= 48) & (_byte <= 57),
    "symbol": np.isin(_byte, list(b"#*$%&|<>{}[]\\=+~^_@")),
    "shout": np.isin(_byte, list(b"!?")),
}
FEATURES = ("one", "length", *CLASS, "ends", "again", "short", "wording")


@dataclass(frozen=True)
class Lines:
    """Of all rows' lines, end to end: features (wording still 0), size without spaces, hash, and the buckets of its words."""

    table: np.ndarray
    per_row: np.ndarray
    solid: np.ndarray
    hashes: np.ndarray
    word: np.ndarray
    words_at: np.ndarray

    def with_wording(self, lexicon: np.ndarray) -> np.ndarray:
        table, n = self.table.copy(), np.diff(self.words_at)
        total = np.append(0.0, np.cumsum(lexicon[self.word]))
        table[:, -1] = (total[self.words_at[1:]] - total[self.words_at[:-1]]) / np.maximum(n, 1)
        return table


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Features per line. A row has a line at least."""
    n, rows = len(data), len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    # An empty row and the place after a line break can share a start; each is a line, and its end is the next start or break.
    row = np.searchsorted(offsets[1:], breaks, "right")
    per_row = np.bincount(row, minlength=rows) + 1 if rows else np.zeros(0, np.int64)
    last = np.cumsum(per_row) - 1
    end = np.append(start[1:] - 1, n)
    end[last] = offsets[1:]
    start = np.minimum(start, end)
    size = end - start
    table = np.zeros((len(start), len(FEATURES)))
    sums = {}
    for name, member in CLASS.items():
        total = np.zeros(n + 1, np.int64)
        np.cumsum(member[data], out=total[1:])
        sums[name] = total[end] - total[start]
    solid = size - sums["space"]
    part = lambda x, of: x / np.maximum(of, 1)
    table[:, 0] = 1
    table[:, 1] = np.log1p(solid) / 5
    for i, name in enumerate(CLASS, 2):
        table[:, i] = part(sums[name], sums["letter"] if name == "upper" else size if name == "space" else solid)
    final = data[np.maximum(end - 1, 0)] if n else np.zeros(len(start), np.uint8)
    table[:, 8] = (size > 0) & np.isin(final, list(b".:;,\"')"))
    # A line equal to one before it in its row.
    doc = np.repeat(np.arange(rows), per_row).astype(U64)
    own = run_hashes(data, start, end)
    key = own ^ (doc * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.append(False, key[order][1:] == key[order][:-1])
    again = np.zeros(len(start), bool)
    again[order] = same
    table[:, 9] = again & (solid > 0)
    table[:, 10] = solid < 12
    begin, stop = words(data, offsets)
    owner = np.searchsorted(start, begin, "right") - 1
    word = (run_hashes(LOWER[data], begin, stop) % U64(WORDS)).astype(np.int64)
    return Lines(table, per_row, solid, own, word, np.append(0, np.cumsum(np.bincount(owner, minlength=len(start)))))


@dataclass(frozen=True)
class Weights:
    """State 1 is content: its score is features @ content; state 0 scores 0. step[a, b] is added from a to b; lexicon has
    the weight of each bucket of words."""

    content: np.ndarray
    step: np.ndarray
    lexicon: np.ndarray


#: Used where there is nothing to learn from: symbols, shouting and repeats speak against a line.
DEFAULT = Weights(np.array([1.0, 1.0, 0, -3.0, 1.0, 0, -12.0, -12.0, 0.5, -2.0, -0.5, 0]), np.array([[0.5, -0.5], [-0.5, 0.5]]), np.zeros(WORDS))


def _padded(x: np.ndarray, per_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows side by side, filled up to the longest; and which cells are real."""
    real = np.arange(per_row.max())[None, :] < per_row[:, None]
    out = np.zeros((*real.shape, *x.shape[1:]))
    out[real] = x
    return out, real


def viterbi(score: np.ndarray, per_row: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The likeliest labels of all rows' lines. Rows go together with others of about their length, one line at a time."""
    out, start = np.zeros(len(score), bool), np.cumsum(per_row) - per_row
    group = np.frexp(per_row)[1]
    for g in np.unique(group):
        pick = np.flatnonzero(group == g)
        span = per_row[pick]
        lines = np.repeat(start[pick] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        s, real = _padded(score[lines], span)
        best = np.stack([np.zeros(len(pick)), s[:, 0]], axis=1)
        back = np.zeros((*s.shape, 2), bool)
        for t in range(1, s.shape[1]):
            come = best[:, :, None] + step[None]  # from, to
            back[:, t] = come[:, 1] > come[:, 0]
            new = come.max(axis=1)
            new[:, 1] += s[:, t]
            best = np.where(real[:, t, None], new, best)
        label = np.zeros(s.shape, bool)
        now = best[:, 1] >= best[:, 0]
        for t in range(s.shape[1] - 1, -1, -1):
            label[:, t] = now
            now = np.where(real[:, t], back[np.arange(len(pick)), t, now.astype(int)] if t else now, now)
        out[lines] = label[real]
    return out


def _sums(unary: np.ndarray, real: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of chains of one padded length: log of the sum over all labellings, the probability of state 1 at each place, and the
    expected number of each step. unary is the score of state 1."""
    rows, length = unary.shape
    a, b = np.zeros((rows, length, 2)), np.zeros((rows, length, 2))
    a[:, 0, 1] = unary[:, 0]
    for t in range(1, length):
        for to in (0, 1):
            new = np.logaddexp(a[:, t - 1, 0] + step[0, to], a[:, t - 1, 1] + step[1, to]) + (unary[:, t] if to else 0)
            a[:, t, to] = np.where(real[:, t], new, a[:, t - 1, to])
    for t in range(length - 2, -1, -1):
        for at in (0, 1):
            new = np.logaddexp(b[:, t + 1, 0] + step[at, 0], b[:, t + 1, 1] + step[at, 1] + unary[:, t + 1])
            b[:, t, at] = np.where(real[:, t + 1], new, b[:, t + 1, at])
    z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
    p = np.exp(a[:, :, 1] + b[:, :, 1] - z[:, None]) * real
    after = b[:, 1:] + np.stack([np.zeros_like(unary[:, 1:]), unary[:, 1:]], axis=2)
    joint = np.exp(a[:, :-1, :, None] + step + after[:, :, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
    return z, p, joint.sum(axis=(0, 1))


def objective(theta: np.ndarray, chains: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray]:
    """The log-likelihood per line of what the evidence allows, and its gradient. chains: features, evidence and real cells of
    stretches of about one length."""
    step, value, grad, total = theta[-4:].reshape(2, 2), 0.0, np.zeros_like(theta), 0
    for f, evidence, real in chains:
        score = f @ theta[:-4]
        free, p, joint = _sums(score, real, step)
        held, q, held_joint = _sums(score + evidence, real, step)
        value += (held - free).sum()
        grad += np.concatenate([np.einsum("rt,rtf->f", q - p, f), (held_joint - joint).ravel()])
        total += real.sum()
    return value / total, grad / total


def fit(x: np.ndarray, per_row: np.ndarray, evidence: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The weights of the features and of the steps, by Adam with a small ridge. Evidence is the log odds of content per line."""
    chains, start, group = [], np.cumsum(per_row) - per_row, np.frexp(per_row)[1]
    for g in np.unique(group):
        pick = np.flatnonzero(group == g)
        span = per_row[pick]
        own = np.repeat(start[pick] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        f, real = _padded(x[own], span)
        chains.append((f, _padded(evidence[own], span)[0], real))
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, rounds + 1):
        grad = objective(theta, chains)[1] - 1e-4 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return theta[:-4], theta[-4:].reshape(2, 2)


def _evidence(table: np.ndarray, hashes: np.ndarray, label: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The log odds of content of each line. Copies of a document share their lines' neighbours, so they make no line shared."""
    before, after = np.append(U64(0), hashes[:-1]), np.append(hashes[1:], U64(0))
    before[edge] = 0
    after[np.append(edge[1:], len(hashes)) - 1] = 0
    place = np.unique(np.stack([hashes, before, after]), axis=1)
    line, contexts = np.unique(place[0], return_counts=True)
    contexts = contexts[np.searchsorted(line, hashes)]
    column = FEATURES.index
    out = np.where(label == 1, BY_LABEL, -BY_LABEL)
    out += np.where(contexts >= CONTEXTS, SHARED, 0.0) + np.where(table[:, column("again")] > 0, REPEATED, 0.0)
    return out + np.where(table[:, column("symbol")] + table[:, column("shout")] >= SYMBOL_SHARE, SYMBOLS, 0.0)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from about `sample` labelled documents, at most STRETCHES * STRETCH lines of each; DEFAULT where one of the
    labels is missing. A document labelled more than once has its greatest label; repeated documents all count."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    by = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(by) < 2:
        return DEFAULT
    chosen = F.broadcast(known.where(share_of(F.col("doc_id"), sample, sum(by.values()))))  # about `sample` rows
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = lines_of(*utf8(batch.column("text")))
            at, found = np.append(0, np.cumsum(x.per_row)), []
            for doc_id, quality, lo, hi in zip(batch.column("doc_id").to_pylist(), batch.column("quality").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                pieces = range(lo, hi, STRETCH)
                for k in sorted({len(pieces) * i // STRETCHES for i in range(STRETCHES)}):
                    a, b = pieces[k], min(hi, pieces[k] + STRETCH)
                    w = x.words_at[a : b + 1]
                    found.append((doc_id, quality, a - lo, x.table[a:b].astype(np.float32).tobytes(), x.hashes[a:b].tobytes(), x.word[w[0] : w[-1]].astype(np.int16).tobytes(), (w - w[0]).astype(np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4], strict=True)], names=["doc_id", "quality", "line", "x", "hash", "word", "words_at"])

    got = sorted(map(tuple, rows.mapInArrow(run, "doc_id long, quality int, line long, x binary, hash binary, word binary, words_at binary").collect()))
    if not got:
        return DEFAULT
    parts = [np.frombuffer(r[3], np.float32).reshape(-1, len(FEATURES)) for r in got]
    per_row = np.array([len(p) for p in parts])
    table, hashes = np.concatenate(parts).astype(float), np.concatenate([np.frombuffer(r[4], U64) for r in got])
    word, ends = np.concatenate([np.frombuffer(r[5], np.int16) for r in got]).astype(np.int64), [np.frombuffer(r[6], np.int32) for r in got]
    words_at = np.append(0, np.cumsum(np.concatenate([np.diff(e) for e in ends])))
    evidence = _evidence(table, hashes, np.repeat([r[1] for r in got], per_row), np.cumsum(per_row) - per_row)
    odds = np.repeat(1 / (1 + np.exp(-evidence)), np.diff(words_at))
    good, bad = (np.bincount(word, p, WORDS) + 1 for p in (odds, 1 - odds))
    lexicon = np.log(good / good.sum()) - np.log(bad / bad.sum())
    lines = Lines(table, per_row, table[:, 1], hashes, word, words_at)
    return Weights(*fit(lines.with_wording(lexicon), per_row, evidence), lexicon)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = WORD.findall(text)
    n = len(words)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += bool(WORD.search(line))
        seen.add(line)
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < n - 2:
            count, covered = Counter(windows), 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeat += i + 3 - max(i, covered)
                    covered = i + 3
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup, repeat


def label_lines(df: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """Per document: base counts, number of lines and of content lines, the content share of its characters, base_failed, kept.

    Null text counts as empty; it has no words and fails the base rule. Lines split at line feeds alone. One row out per row
    in, also for repeated rows.
    """
    held = df.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = held.value
        x = lines_of(*utf8(batch.column("text")))
        per_row, solid = x.per_row, x.solid
        content = viterbi(x.with_wording(w.lexicon) @ w.content, per_row, w.step)
        first = np.cumsum(per_row) - per_row
        over = lambda v: np.add.reduceat(v, first) if len(first) else v
        good, whole = over(np.where(content, solid, 0)), over(solid)
        part = np.where(whole > 0, good / np.maximum(whole, 1), 0.0)
        base = np.array([base_counts(t or "") for t in batch.column("text").to_pylist()], np.int64).reshape(-1, 5)
        failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > 50 * base[:, 0])
        cols = [*base.T, per_row.astype(np.int64), over(content.astype(np.int64)), part, failed, ~failed & (part >= share)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols)], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_content_lines", "content_share", "base_failed", "kept"])

    return map_texts(texts_of(df, id_col, text_col), run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_content_lines long, content_share double, base_failed boolean, kept boolean")
