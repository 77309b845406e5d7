"""Language ID, quality scores and sharding against slow versions in plain Python, with nulls, ties, repeats and long texts."""

import math
import re
import struct
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from shelfshare.llm import common, language_id, quality, sharding

MASK = (1 << 64) - 1
TEXTS = [(1, None), (2, ""), (3, "12 34"), (4, "Der Hund läuft schnell über die Straße"), (5, "the dog runs over the street"), (6, "A"), (6, "A"), (None, "le chien court dans la rue"), (7, "the dog " * 20_000), (8, "漢字 🙂 Ünï")]
LEARNED = [(100 + i, lang, t) for i, (lang, t) in enumerate([("de", "Der Hund und die Katze"), ("de", "schnell über Straßen"), ("en", "the cat and the dog"), ("en", "over the streets"), ("fr", "le chat et le chien"), ("fr", "dans les rues"), (None, "nothing")])]


def bucket(gram, buckets):
    h = len(gram)
    for c in gram:
        h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) & MASK
        h ^= h >> 29
    return ((h * 0xD6E8FEB86659FD93) & MASK) >> (64 - buckets.bit_length() + 1)


def grams(text, buckets):
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    return Counter(bucket(plain[i : i + n], buckets) for n in (1, 2, 3) for i in range(len(plain) - n + 1))


def test_language_by_brute_force(spark):
    buckets = 1 << 10
    rows = spark.createDataFrame([(i, t, lang, "x") for i, lang, t in LEARNED], "doc_id long, text string, lang string, shard string")
    model = language_id.train(rows, F.lit(True), buckets=buckets)
    found = {r: n for lang in ("de", "en", "fr") for r, n in [(lang, sum((grams(t, buckets) for _, x, t in LEARNED if x == lang), Counter()))]}
    docs = spark.createDataFrame([(i, t, 1.0, 2.0) for i, t in TEXTS], "doc_id long, text string, score double, fit double").repartition(3)
    got = Counter((r.doc_id, r.lang_pred, round(r.score, 7), round(r.fit, 7)) for r in language_id.predict(docs, model).collect())
    want = Counter()
    for i, t in TEXTS:
        if not t or not any(c.isalpha() for c in t):
            want[i, "und", 0.0, 0.0] += 1
            continue
        own = grams(t, buckets)
        logs = {x: {b: math.log((n[b] + 1) / (sum(n.values()) + buckets)) for b in range(buckets)} for x, n in found.items()}
        likely = {x: sum(k * log[b] for b, k in own.items()) for x, log in logs.items()}
        best = max(likely, key=lambda x: (likely[x], [-ord(c) for c in x]))
        score = 1 / sum(math.exp(max(-700.0, v - likely[best])) for v in likely.values())
        usual = sum((found[best][b] + 1) * v for b, v in logs[best].items()) / (sum(found[best].values()) + buckets)
        even = -math.log(buckets)
        want[i, best, round(score, 7), round((likely[best] / sum(own.values()) - even) / (usual - even), 7)] += 1
    assert got == want
    assert language_id.predict(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_rare_languages_are_learned(spark):
    rows = spark.createDataFrame([(i, f"the dog number {i}", "en") for i in range(400)] + [(1000 + i, "der hund", "de") for i in range(3)], "doc_id long, text string, lang string")
    assert language_id.train(rows, F.lit(True), sample=5).languages == ("de", "en")


def test_sample_is_never_empty_at_scale(spark):
    total = 10**12
    rows = spark.range(1 << 16).where(common.share_of(F.col("id"), total // 1000, total)).count()
    assert 40 < rows < 95  # 65.5 expected
    bound = (20_000 << 63) // total
    assert bound > 0 and abs(bound / 2**63 - 2e-8) < 1e-12


TOKEN = re.compile(rb"(?<![A-Z])[A-Z][a-z\x80-\xff]+|[A-Z]+(?![a-z\x80-\xff])|[A-Z]+(?=[a-z\x80-\xff])|[a-z\x80-\xff]+|[0-9]+|([^\sA-Za-z0-9\x80-\xff])\1*")


def mix(x):
    for _ in range(2):
        x = ((x ^ x >> 32) * 0xD6E8FEB86659FD93) & MASK
    return x ^ x >> 32


def words_by_hand(text):
    """Runs of one kind, a lone capital before small letters counted as one of them."""
    data = text.encode()
    kinds = ["s" if b in b" \t\n\x0b\x0c\r" else "l" if b >= 128 or chr(b).islower() else "u" if chr(b).isupper() else "d" if chr(b).isdigit() else str(b) for b in data]
    plain = list(kinds)
    for i in range(len(data) - 1):
        if plain[i] == "u" and plain[i + 1] == "l" and (i == 0 or plain[i - 1] != "u"):
            kinds[i] = "l"
    out, i = [], 0
    while i < len(data):
        j = i
        while j < len(data) and kinds[j] == kinds[i]:
            j += 1
        if kinds[i] != "s":
            h = sum(int(common._BYTE[c + 32 if 65 <= c <= 90 else c]) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, c in enumerate(data[i:j])) + (j - i)
            h = mix(h & MASK) + (0x9E3779B97F4A7C15 if kinds[i] == "u" else 0)
            out.append(((h * 0xD6E8FEB86659FD93) & MASK) >> (64 - quality.BITS))
        i = j
    return out


def test_quality_by_brute_force(spark):
    rng = np.random.default_rng(8)
    width = 2 * quality.SIZE + 3
    model = quality.Model(quality.index_vectors().astype(np.float32), rng.normal(size=width), rng.uniform(1, 2, width), rng.normal(size=(width, 5)), rng.normal(size=6), 1.7, 1e-6)
    texts = [t for t in TEXTS if t[0] != 7] + [(9, "McDonald HTTPServer $$$ !! a.b ÄB"), (10, "Words " * 200)]
    docs = spark.createDataFrame([(i, t, 3.0) for i, t in texts], "doc_id long, text string, score double").repartition(2)
    got = Counter((r.doc_id, round(r.score, 5), r.predicted) for r in quality.score(docs, model).collect())
    want = Counter()
    for i, t in texts:
        own = words_by_hand(t or "")
        x = np.zeros(width)
        if own:
            x[: quality.SIZE] = np.mean([model.vectors[b] for b in own], axis=0)
            x[quality.SIZE : -3] = np.mean([model.vectors[b] for b in set(own)], axis=0)
            x[-2] = len(set(own)) / len(own)
        x[-3], x[-1] = math.log1p(len(own)) / 8, 1
        hidden = [math.tanh(sum((x[j] - model.mean[j]) / model.scale[j] * model.first[j, k] for j in range(width))) for k in range(5)]
        p = 1 / (1 + math.exp(-(sum(h * w for h, w in zip(hidden, model.second[:-1], strict=True)) + model.second[-1]) / 1.7))
        want[i, round(p, 5), int(p >= 0.3)] += 1
    assert got == want


def test_gradient_of_the_network():
    """What training learns from a separable sample is a falling loss, and the temperature is the best of its grid."""
    rng = np.random.default_rng(2)
    x = np.c_[rng.normal(size=(6000, 4)), np.ones(6000)]
    y = (x[:, 0] * x[:, 1] > 0).astype(float)  # needs the hidden layer
    first, second = quality._fit(x, y)
    z = np.tanh(x @ first) @ second[:-1] + second[-1]
    assert ((z > 0) == y).mean() > 0.9
    t = quality._calibrate(z, y)
    loss = lambda s: np.mean(np.logaddexp(0, z / s) - y * z / s)
    assert loss(t) <= min(loss(s) for s in np.geomspace(0.25, 16, 60)) + 1e-6


def test_sharding_by_brute_force(spark):
    """Every shard in turn takes the first free slot of its order; keys are placed by their hash."""
    names, slots = ["a", "b", "c"], 101
    orders = []
    for s in names:
        offset, skip = sharding._hash(s, b"offset") % slots, sharding._hash(s, b"skip") % (slots - 1) + 1
        orders.append([(offset + i * skip) % slots for i in range(slots)])
    owner = {}
    while len(owner) < slots:
        for name, order in zip(names, orders, strict=True):
            free = next((x for x in order if x not in owner), None)
            if free is not None:
                owner[free] = name
    rows = [(i, "old", -1, "x") for i in [*range(-50, 50), 10**17, 5, 5]]
    df = spark.createDataFrame(rows, "doc_id long, shard string, SLOT long, _slot_of_row string").repartition(3)
    got = sharding.place(df, "doc_id", names, slots)
    assert got.columns == ["doc_id", "_slot_of_row", "slot", "shard"]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    place = lambda i: signed(xxhash.xxh64(struct.pack("<q", i), seed=42).intdigest()) % slots
    assert Counter(map(tuple, got.select("doc_id", "slot", "shard").collect())) == Counter((i, place(i), owner[place(i)]) for i, *_ in rows)
    assert sharding.place(df.limit(0), "doc_id", names, slots).count() == 0
    null = spark.createDataFrame([(None,), (None,)], "doc_id long")
    assert {r.shard for r in sharding.place(null, "doc_id", names, slots).collect()} == {owner[42 % slots]}
    assert sharding.place(got, "shard", names, slots).columns == ["doc_id", "_slot_of_row", "slot", "shard"]  # the key is replaced too


def test_numbers_are_no_letters(spark):
    model = language_id.train(common.table(spark, "/root/testdata/sf0.001", "documents"), language_id.remainder("doc_id", 4) != 2)
    texts = ["²", "½ ①", "123", "٣", "Ⅷ", " \n", "", None, "a", "ñ", "12 é"]
    rows = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        letters = bool(text) and any(c.isalpha() for c in text)
        assert (rows[i].lang_pred == "und") is not letters and (letters or (rows[i].score, rows[i].fit) == (0.0, 0.0)), text
    kept = language_id.keep(spark.createDataFrame(list(enumerate(texts[:8])), "doc_id long, text string"), model)
    assert kept.count() == 0
