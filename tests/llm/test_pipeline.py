"""The stages one after another on the smallest tables, each held against a slow version of what it does."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline as p
import numpy as np
import pyarrow as pa
from shelfshare.llm import language_id, packing, quality, secret_scan
from shelfshare.llm.common import table
from shelfshare.llm.language_id import remainder

D = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(tuple, df.collect()))


def shingles(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} - {()}


def test_stages(spark):
    docs = table(spark, D, "documents")
    steps = [docs]
    for _, stage in p.STAGES:
        steps.append(stage(spark, steps[-1], D).persist())
    assert all(s.columns == docs.columns for s in steps[:-1])
    text = docs.columns.index("text")

    # Models are trained by the operators; their verdicts are worked out one text at a time, without Spark.
    model = quality.train(docs, table(spark, D, "labels"), remainder("doc_id", 5) != 0)
    good = lambda t: model.score(quality.pooled(pa.array([t], pa.string()), model.vectors))[0] >= 0.3
    assert rows(steps[1]) == Counter({r: n for r, n in rows(steps[0]).items() if good(r[text])})
    lang = language_id.train(docs, remainder("doc_id", 4) != 2)
    fits = lambda t: bool(t) and any(c.isalpha() for c in t) and lang.predict([t])[2][0] >= 0.4
    assert rows(steps[2]) == Counter({r: n for r, n in rows(steps[1]).items() if fits(r[text])})

    # All pairs of sets; of each group that links reach the row of the smallest id stays.
    own = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    sets, least = [shingles(r[text]) for r in own], list(range(len(own)))

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(own)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    assert rows(steps[3]) == Counter(tuple(r) for i, r in enumerate(own) if find(i) == i)

    # Secrets are masked where the spans say, all else stays.
    ranks = secret_scan.dictionary(secret_scan.vocabulary())
    want = Counter()
    for r in steps[3].collect():
        new, spans = r[text], [x[:2] for x in secret_scan.find(r[text] or "", ranks)]
        hidden = {i for a, b in spans for i in range(a, b)}
        if spans:
            new = "".join(c if i not in hidden else "" if i - 1 in hidden else "[SECRET]" for i, c in enumerate(r[text]))
        want[tuple(new if k == text else len(new) if docs.columns[k] == "n_chars" and new != r[text] else v for k, v in enumerate(r))] += 1
    assert rows(steps[4]) == want

    # Pieces give back each document's ids, as the library has them.
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.vocabulary())
    library.encode_special_tokens = True
    pieces, lengths = defaultdict(list), Counter()
    for r in steps[5].collect():
        pieces[r.doc_id].append(r)
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= 4096 and set(pieces) == {r.doc_id for r in steps[4].collect()}
    for r in steps[4].collect():
        ids, at = np.array([*library.encode(r[text] or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for piece in sorted(pieces[r.doc_id], key=lambda x: x.start):
            assert piece.start == at and piece.doc_tokens == len(ids) and piece.ids_crc32 == zlib.crc32(ids[at : at + piece.length].tobytes())
            at += piece.length
        assert at == len(ids)
    assert {r.doc_id for r in p.run(spark, D).collect()} == set(pieces)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in p.STAGES:
        assert stage(spark, empty, D).count() == 0, name
