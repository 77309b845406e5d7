"""Spelling variants against all pairs of words."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfshare.llm import spelling as s
from shelfshare.llm.common import Tables

KINDS = "word string, n long"


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(counts, times):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def test_crc_of_a_prefix_and_a_word():
    rng = random.Random(3)
    for _ in range(300):
        a, b = (bytes(rng.randrange(256) for _ in range(rng.randint(0, 30))) for _ in range(2))
        assert s.crc_after(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)]), np.array([zlib.crc32(b)], np.uint32))[0] == zlib.crc32(a + b)


def test_scanning_a_sorted_list():
    rng = random.Random(3)
    for _ in range(300):
        size, letters = rng.randint(1, 6), "abé"[: rng.randint(1, 3)]
        parts = sorted({"".join(rng.choice(letters) for _ in range(size)) for _ in range(rng.randint(1, 60))})
        guests = ["".join(rng.choice(letters) for _ in range(size + 1)) for _ in range(rng.randint(0, 60))]
        got = {}
        computed = s.near_in_list(parts, guests, lambda i, near, got=got: got.__setitem__(i, sorted(near.tolist())))
        for i, part in enumerate(parts):
            assert got.get(i, []) == [j for j, q in enumerate(parts + guests) if one_edit(part, q)]
        assert computed <= len({part[:k] for part in parts for k in range(1, size + 1)})  # no prefix twice


def test_ranges_beyond_one_edit_are_skipped():
    parts = sorted(f"{a}{b}{c}" for a in "xyz" for b in "mno" for c in "pqrst")
    guests = ["abcd"]
    assert s.near_in_list(parts[:1], guests, lambda *_: None) == 3  # x is one replacement, xm is two edits; alone it is near itself
    assert s.near_in_list([p for p in parts if p[0] == "x"], [], lambda *_: None) <= 1 + 3 + 15


@pytest.mark.parametrize("group", [4, 4096])
def test_variants(spark, group):
    rng = random.Random(group)
    words = Counter()
    for _ in range(260):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        words[word] += rng.choice([1, 5, 6, 30, 150, 5000])
    for stem in ("itemidentifier", "ñandúes"):  # words that share a half
        for _ in range(40):
            words[stem + "".join(rng.choice("ab") for _ in range(rng.randint(3, 6)))] += rng.choice([5, 25, 125, 625])
    rows = [(w, n) for w, n in words.items()]
    df = spark.createDataFrame([(w, n - 1) for w, n in rows] + [(w, 1) for w, _ in rows] + [(None, 9), ("", 9)], KINDS)
    got = s.variants(df, group=group)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == slow(words, 5) and got.count() == len(words)
    assert s.variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="round in a circle"):
        s.variants(df, times=1)


def test_large_groups_are_dealt_out_again(spark):
    """No group has more words than allowed, unless its part has two characters at most."""
    words = [f"commonprefix{a}{b}{c}{d}" for a in "abcd" for b in "abcd" for c in "abcd" for d in "abcd"]
    tables = Tables(spark)
    got = {r.word: r.n_near for r in s.near_words(spark.createDataFrame([(w, 5) for w in words], KINDS), tables, 40).collect()}
    assert got == dict.fromkeys(words, 12)
    assert len(tables.paths["spelling-groups"]) > 1


def test_vocabulary(spark):
    texts = [(1, "Hausboot hausboot, HAUSBOOT; Straße straße ×÷× ÀÉ-boot"), (2, None), (3, ""), (None, "hausboot " * 3), (1, "hausboot"), (4, "x" * 70_000 + " " + "hausbot")]
    df = spark.createDataFrame([(i, t, 3) for i, t in texts], "doc_id long, text string, n int")
    got = {r.word: r.n for r in s.vocabulary(df, least_length=2, least_count=1).collect()}
    assert got == {"hausboot": 7, "straße": 2, "×÷×": 1, "ÀÉ": 1, "boot": 1, "x" * 70_000: 1, "hausbot": 1}
    assert s.vocabulary(df).count() == 1 and s.vocabulary(df.limit(0)).count() == 0


def test_damaged_words(spark):
    rng = random.Random(9)
    texts = [(i if i % 9 else None, " ".join("".join(rng.choice("abé") for _ in range(rng.randint(1, 4))) for _ in range(80))) for i in range(30)]
    want = Counter()
    for i, text in texts:
        for run in text.split():
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run
            want[word] += 1
    want = {w: n for w, n in want.items() if len(w) >= 2 and n >= 2}
    got = {r.word: r.n for r in s.vocabulary(spark.createDataFrame(texts, "doc_id long, text string"), least_length=2, least_count=2, damage=7).collect()}
    assert got == want
