"""Context mixing against bit-by-bit mixing in plain Python, and its base scores against plain counts."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfshare.llm import context_mixing as m
from shelfshare.llm.common import table
from shelfshare.llm.language_id import remainder

D = "/root/testdata/sf0.001"


def words(text):
    out = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def base(text, counts, total, distinct):
    return sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in [*words(text), ""])


@pytest.fixture(scope="module")
def trained(spark):
    return m.train(table(spark, D, "documents"), remainder("doc_id", 7) != 2)


def test_base_scores(spark, trained, monkeypatch):
    docs = table(spark, D, "documents").select("doc_id", "text").collect()
    fold = {r.doc_id: r.f for r in table(spark, D, "documents").select("doc_id", (remainder("doc_id", 7) == 2).alias("f")).collect()}
    counts = Counter(w for r in docs if not fold[r.doc_id] for w in [*words(r.text), ""])
    total, distinct = sum(counts.values()), len(counts)
    few = m.Trained(trained.model, trained.tokens, trained.frequent[::50], trained.frequent_train[::50], trained.train_tokens, trained.distinct)  # most tokens are joined
    for model in (trained, few):
        got = {r.doc_id: r for r in m.score(table(spark, D, "documents"), model).collect()}
        for r in docs:
            own = [*words(r.text), ""]
            row = got[r.doc_id]
            assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
            assert row.base_score == pytest.approx(base(r.text, counts, total, distinct), rel=1e-9)


def slow_score(model, text):
    """One bit after the other; weights change where blocks end."""
    data = " ".join(words(text)).encode() + bytes([m.END])
    factor, seen, bits, gradient, total = np.ones(len(m.ORDERS)), m.TRUST, 0, 0.0, 0.0
    for i, byte in enumerate(data):
        if i in m.FIRST_BLOCKS or i > m.FIRST_BLOCKS[-1] and (i - m.FIRST_BLOCKS[-1]) % m.EVERY == 0:
            seen += bits
            factor, bits, gradient = factor + m.RATE * gradient / seen, 0, 0.0
        contexts = []
        for order in m.ORDERS:
            h = 0
            for back in range(1, order + 1):
                h = (h ^ (data[i - back] + 1 if i >= back else 0)) * int(m._M) & 0xFFFFFFFF
                h ^= h >> 15
            contexts.append(h)
        own = 256 * (data[i - 1] + 1 if i else 0) + byte
        for k in range(model.code.length[own]):
            node, bit = int(model.code.node[model.code.at[own] + k]), int(model.code.bit[model.code.at[own] + k])
            slots = [((h + node * int(m.NODE)) * 0xC2B2AE35 & 0xFFFFFFFF) >> (32 - size) for h, size in zip(contexts, m.SLOT_BITS, strict=True)]
            odds = [int(model.odds[j][slot]) for j, slot in enumerate(slots)]
            gate = sum(o != 0 for o in odds)
            say = np.array([(2 * bit - 1) * model.weights[j, gate] * o / m.STEPS for j, o in enumerate(odds)])
            p = 1 / (1 + math.exp(-float(say @ factor)))
            total += math.log10(p)
            gradient = gradient + say * (1 - p)
            bits += 1
    return total


def test_scores_bit_by_bit(trained, monkeypatch):
    rng = random.Random(1)
    texts = ["", None, "The the", "Das Haus am See, né?", "the and of " * 400, "".join(chr(rng.randint(33, 0x3000)) for _ in range(900)), "of the\n" * 2]
    got = trained.model.score(pa.array(texts, pa.string()))
    for text, value in zip(texts, got, strict=True):
        assert value == pytest.approx(slow_score(trained.model, text), rel=2e-5)
        assert trained.model.score(pa.array([text], pa.string()))[0] == pytest.approx(value, rel=1e-9)  # whatever stands beside it
    monkeypatch.setattr(m, "SEGMENT", 1 << 11)
    monkeypatch.setattr(m, "FIRST_BLOCKS", (32, 64, 1024))
    monkeypatch.setattr(m, "EVERY", 1024)
    assert trained.model.score(pa.array(texts, pa.string()))[4] == pytest.approx(slow_score(trained.model, texts[4]), rel=2e-5)


def test_probabilities_add_up(trained):
    """Over all next bytes at some place, END among them."""
    for before in ("", "th", "the an"):
        total = 0.0
        for byte in range(256):
            data = np.append(np.frombuffer(before.encode(), np.uint8), np.uint8(byte))
            value = trained.model._scored(data, np.arange(len(data)), np.array([1]), m.Refined(1), len(data) - 1)[0]
            total += 10**value
        assert total == pytest.approx(1, rel=1e-4)


def test_code_is_prefix_free():
    code = m.prefix_codes(np.random.default_rng(1).integers(0, 1000, (257, 256)) ** 2)
    for before in range(0, 257, 64):
        own = slice(256 * before, 256 * before + 256)
        paths = {"".join(map(str, code.bit[a : a + n])) for a, n in zip(code.at[own], code.length[own].astype(int), strict=True)}
        assert len(paths) == 256 and sum(2.0 ** -len(p) for p in paths) == 1


def test_counts_do_not_depend_on_tasks(spark, trained):
    again = m.train(table(spark, D, "documents").repartition(7), remainder("doc_id", 7) != 2)
    assert all((a == b).all() for a, b in zip(again.model.odds, trained.model.odds, strict=True)) and again.train_tokens == trained.train_tokens
    assert np.abs(again.model.weights - trained.model.weights).max() <= 2e-6


def test_held_out_documents_are_likelier_than_words_alone(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = m.score(docs, m.train(docs, remainder("doc_id", 7) != 2)).join(docs.select("doc_id", "text"), "doc_id").where(remainder("doc_id", 7) == 2)
    row = found.agg(F.sum("score").alias("score"), F.sum(F.octet_length("text")).alias("size"), F.sum("base_score").alias("base")).first()
    assert -row.score / math.log10(2) / row.size < 2.4 and row.score > 1.06 * row.base


def test_odd_rows(spark, trained):
    rows = [(1, None), (1, None), (None, "the"), (2, ""), (3, "the"), (3, "nowhere-to-be-found " * 3), (4, "x" * 300_000)]
    got = m.score(spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double"), trained)
    assert got.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = got.collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known) for r in found if r.doc_id) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 2, 2), (3, 4, 1), (4, 2, 1)]
    alone = [r for r in found if r.doc_id is None]
    assert len(alone) == 1 and alone[0].score == [r.score for r in found if r.doc_id == 3 and r.n_tokens == 2][0]
    empty = m.train(table(spark, D, "documents").limit(0), F.lit(True))
    none = m.score(table(spark, D, "documents").limit(0), empty)
    assert none.count() == 0 and (empty.train_tokens, empty.distinct) == (0, 0)
    unlearned = m.score(spark.createDataFrame([(1, "ab")], "doc_id long, text string"), empty).first()
    assert unlearned.base_score == 0.0 and unlearned.score == pytest.approx(3 * 8 * math.log10(0.5))


def test_no_text_counts_for_more_than_its_counts(spark, trained):
    """What is learned besides counts must not come from a share of the texts, such as those that a hash chooses."""
    docs = table(spark, D, "documents")
    others = m.train(docs.where(F.pmod(F.xxhash64("text"), F.lit(32)) != 0), remainder("doc_id", 7) != 2)
    assert (others.model.weights == trained.model.weights).all()
