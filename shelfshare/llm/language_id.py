"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else counts as a space; n-grams of 1 to 3 characters fall into `buckets` hash buckets.
The model, one log-probability per bucket and language, is small (bounded by buckets and languages) and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, keep_rows, map_texts, share_of, texts_of

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: About so many training documents of each language at most, chosen by a hash of the id.
SAMPLE = 5_000
UNKNOWN = "und"
#: A text fits its language from here on.
LEAST_FIT = 0.4
CHUNK = 1 << 20
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def has_letter(text: str) -> bool:
    """Whether a text has a letter, as the n-grams know them: digits and numbers such as a raised two are none."""
    return any(map(str.isalpha, text))


def _buckets(codes: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """The bucket of the n-gram at each place but the last order-1."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, U64(order))
    for k in range(order):
        h = (h ^ codes[k : k + n]) * U64(0x9E3779B97F4A7C15)
        h ^= h >> U64(29)
    return ((h * U64(0xD6E8FEB86659FD93)) >> U64(64 - buckets.bit_length() + 1)).astype(np.int64)


def counts(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Counts per bucket over the whole text; long texts are taken in chunks that overlap by the longest n-gram."""
    out = np.zeros(buckets, np.int64)
    overlap = max(ORDERS) - 1
    for lo in range(0, max(1, len(text)), CHUNK):
        before = max(0, lo - overlap)
        raw = np.frombuffer(text[before : lo + CHUNK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        first = len(text[before:lo].lower())
        codes = np.where(_is_letter()[raw], raw, 32).astype(U64)
        for order in ORDERS:
            out += np.bincount(_buckets(codes[max(0, first - order + 1) :], order, buckets), minlength=buckets)
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages
    usual: np.ndarray  # the mean log-probability of an n-gram of each language's own documents

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts with a letter: the language's number, its posterior, and the fit."""
        cols, vals, starts, at = [], [], [], 0
        for text in texts:  # the texts as a sparse matrix, row after row
            c = counts(text, len(self.log_prob))
            hit = np.flatnonzero(c)
            cols.append(hit)
            vals.append(c[hit])
            starts.append(at)
            at += len(hit)
        cols, vals = np.concatenate(cols), np.concatenate(vals)
        likely = np.add.reduceat(vals[:, None] * self.log_prob[cols], starts, axis=0)
        posterior = likely + self.log_prior
        p = np.exp(posterior - posterior.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        even = -np.log(len(self.log_prob))
        mean = likely[np.arange(len(best)), best] / np.add.reduceat(vals, starts)
        return best, np.minimum(p.max(axis=1), 1.0), (mean - even) / (self.usual[best] - even)


def train(df: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, buckets: int = BUCKETS) -> Model | None:
    """A model from the rows where allowed holds and the language is known; None if there are none.

    Of each language about `sample` documents are learned from, so that rare ones are learned too; a repeated row counts as
    often as it is there. What reaches the driver is a count per language, and one per language and bucket.
    """
    rows = df.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    total = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not total:
        return None
    chosen = F.lit(False)
    for lang, n in sorted(total.items()):
        chosen = chosen | (F.col("lang") == lang) & share_of(F.col("id"), sample, n)
    rows = rows.where(chosen).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen[lang] = seen.get(lang, 0) + counts(text, buckets)
                docs[lang] = docs.get(lang, 0) + 1
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(c[at], docs[lang]))], names=["lang", "bucket", "n"])

    found = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(set(found["lang"])))
    if not languages:
        raise ValueError("the sample is empty")
    code = {x: i for i, x in enumerate(languages)}
    matrix, docs = np.ones((buckets, len(languages))), np.zeros(len(languages))
    for lang, part in found.groupby("lang"):
        real = part[part["bucket"] >= 0]
        matrix[real["bucket"].to_numpy(), code[lang]] += real["n"].to_numpy()
        docs[code[lang]] = part[part["bucket"] < 0]["n"].sum()
    log_prob = np.log(matrix / matrix.sum(axis=0))
    return Model(languages, np.log(docs / docs.sum()), log_prob, (matrix * log_prob).sum(axis=0) / matrix.sum(axis=0))


def _predicted(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    langs, scores, fit = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if model and t and has_letter(t)]
    if known:
        best, scores[known], fit[known] = model.predict([texts[i] for i in known])
        for i, k in zip(known, best, strict=True):
            langs[i] = model.languages[k]
    return langs, scores, fit


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, fit: the likeliest learned language of each whole text, its posterior, and how well it fits.

    The posterior only compares the learned languages. fit, which doesn't grow with length, is 1 where a mean n-gram is as
    likely as in the language's own documents, and 0 where it is as likely as any bucket. `und` with score and fit 0 for
    null, empty and letterless texts, and for all if nothing was learned. A tie goes to the language first in the alphabet.
    One row out per row in, also for repeated rows.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores, fit = _predicted(held.value, batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores), pa.array(fit)], names=["doc_id", "lang_pred", "score", "fit"])

    return map_texts(texts_of(df, id_col, text_col), run, "doc_id long, lang_pred string, score double, fit double")


def keep(df: DataFrame, model: Model | None, text_col: str = "text", least_fit: float = LEAST_FIT) -> DataFrame:
    """The rows of df whose text has a recognised language: one was predicted, and fits."""
    held = df.sparkSession.sparkContext.broadcast(model)

    def fits(texts: pa.Array) -> np.ndarray:
        langs, _, fit = _predicted(held.value, texts.to_pylist())
        return (np.array(langs) != UNKNOWN) & (fit >= least_fit)

    return keep_rows(df, text_col, fits)


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(of))
