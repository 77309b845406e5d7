"""Periodic runs against a look at every lag, and what a row of odd texts gives."""

import random

import numpy as np
from pyspark.sql import functions as F

from shelfshare.llm import periodic_runs as p


def brute(words):
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            s, e = i - q, j
            if e - s >= max(6, 4 * q) and not any(all(words[x] == words[x - k] for x in range(s + k, e)) for k in range(1, q)):
                out.add((s, e - s, q))
            i = j
    return sorted(out)


def test_runs_are_those_of_all_lags():
    rng = random.Random(5)
    for _ in range(3000):
        n, most = rng.randint(0, 90), rng.choice([1, 1, 2, 3, 9])
        words = [rng.randint(0, most) for _ in range(n)]
        if rng.random() < 0.7:
            words = []
            while len(words) < n:
                unit = [rng.randint(0, rng.choice([0, 1, 2, 5])) for _ in range(rng.randint(1, 9))]
                words += unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))]
        if rng.random() < 0.2:
            words = words * rng.randint(1, 5)
        assert p.periodic_runs(np.array(words, np.int64)) == brute(words), words


def test_long_texts():
    random_unit = np.random.default_rng(1).integers(0, 50, 5000)
    assert p.periodic_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert p.periodic_runs(np.tile(random_unit, 20)) == [(0, 100_000, 5000)]
    nested = np.tile(np.repeat(np.arange(20), 50), 50)
    assert p.periodic_runs(nested) == sorted([(50 * i, 50, 1) for i in range(1000)] + [(0, 50_000, 1000)])


def test_rows(spark):
    texts = {1: None, 2: "", 3: " \t\n", 4: "a a a a a a", 5: "x y " * 3 + "x y z", 6: "é é b " * 4 + "end", 7: "a a a a a", 8: "A a A a A a A a", 9: "x " + "a " * 7 + "b " * 6}
    rows = [(i, t, 1) for i, t in texts.items()] + [(None, "q q q q q q q", 1), (4, "a a a a a a", 1), (4, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in p.find(df).collect()), key=str)
    want = [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"), (4, 1, [], "b"), (5, 9, [(0, 8, 2)], "x y z"), (6, 9, [(0, 8, 2)], "é é b end"),
        (7, 5, [], "a a a a a"), (8, 8, [(0, 8, 2)], "A a"), (9, 14, [(1, 7, 1), (8, 6, 1)], "x a b"), (None, 7, [(0, 7, 1)], "q"),
    ]
    assert got == sorted(want, key=str)
    best = {(r.doc_id, r.n_words): r.best for r in p.find(df).withColumn("best", p.strongest(F.col("runs"))).collect()}
    assert tuple(best[9, 14]) == (1, 7, 1) and best[1, 0] is None
    assert p.find(df.limit(0)).count() == 0


def test_overlapping_runs_and_equal_exponents(spark):
    text = "a a a a a a b a a a a a a b a a a a a a b a a a a a a b c c c c c c"
    row = p.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).withColumn("best", p.strongest(F.col("runs"))).first()
    assert [tuple(x) for x in row.runs] == brute(text.split()) and tuple(row.best) == (0, 6, 1)
    kept = [w for i, w in enumerate(text.split()) if not any(s + q <= i < s + n for s, n, q in brute(text.split()))]
    assert row.collapsed == " ".join(kept)
