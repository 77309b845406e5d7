"""Many texts of one template that lie just beyond the likeness: few of all pairs may become candidates."""

import random

import numpy as np
import pytest

from shelfshare.llm import ngram_jaccard

VOCABULARY = [f"w{i}" for i in range(5000)]


def from_template(count, changed, words=200):
    base = random.Random(1).choices(VOCABULARY, k=words)
    out = []
    for seed in range(count):
        rng, text = random.Random(seed + 2), list(base)
        for at in rng.sample(range(words), changed):
            text[at] = rng.choice(VOCABULARY)
        out.append((seed, " ".join(text)))
    return out


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute(rows):
    sets, least = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    return {i: find(i) for i, _ in rows}


@pytest.fixture
def candidates(monkeypatch):
    found, plain = [], ngram_jaccard._candidates

    def counted(*args):
        out = plain(*args)
        found.append(out.count())
        return out

    monkeypatch.setattr(ngram_jaccard, "_candidates", counted)
    return found


def test_candidates_of_a_template(spark, candidates):
    for count in (200, 400):
        rows = from_template(count, 3)
        got = dict(ngram_jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
        if count == 200:
            assert got == brute(rows)
    assert all(found <= 0.06 * count * (count - 1) / 2 for found, count in zip(candidates, (200, 400), strict=True)), candidates


@pytest.mark.parametrize("changed", [1, 2])
def test_links_within_a_template(spark, changed):
    """With one change nearly all link, with two some do and some don't."""
    rows = from_template(150, changed) + [(1000 + i, t) for i, t in from_template(40, 4)]
    rng = np.random.default_rng(3)
    rows = [rows[i] for i in rng.permutation(len(rows))]
    got = dict(ngram_jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select("doc_id", "component_id").collect())
    by_place = brute([(i, t) for i, (_, t) in enumerate(sorted(rows))])
    names = [i for i, _ in sorted(rows)]
    assert got == {names[i]: names[j] for i, j in by_place.items()}


def test_hot_keys_are_salted(spark, monkeypatch):
    """Small bounds, so that salts, beacons, parts of a hub's members and heavy nodes all take part."""
    monkeypatch.setattr(ngram_jaccard, "MEMBERS", 3)
    monkeypatch.setattr(ngram_jaccard, "SALTS", 3)
    monkeypatch.setattr(ngram_jaccard, "HEAVY", 20)
    rows = from_template(60, 1) + [(2000 + i, from_template(1, 1)[0][1]) for i in range(30)]
    got = dict(ngram_jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).select("doc_id", "component_id").collect())
    by_place = brute([(i, t) for i, (_, t) in enumerate(rows)])
    assert got == {rows[i][0]: rows[j][0] for i, j in by_place.items()}
