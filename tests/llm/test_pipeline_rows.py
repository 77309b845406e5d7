"""The stages decide by row: null and repeated ids."""

import corpus_pipeline as p
from shelfshare.llm import quality
from shelfshare.llm.common import table
from shelfshare.llm.language_id import remainder

D = "/root/testdata/sf0.001"
WORDS = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("ale", "orn", "ite", "und", "ask", "emp")]
A, B, C, E = (" ".join(WORDS[(i * k + k) % len(WORDS)] for i in range(70)) for k in (1, 5, 7, 11))
A1 = f"{A} end"


def texts(spark, rows, stage):
    df = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(spark, df, D)
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_copies_by_row(spark):
    assert texts(spark, [(3, A), (7, A1), (7, B)], p.keep_one_of_each) == [(3, A), (7, B)]
    assert texts(spark, [(None, B), (None, C), (4, A), (4, E), (None, A1), (5, ""), (5, ""), (None, C)], p.keep_one_of_each) == sorted([(None, B), (None, C), (4, A), (4, E), (5, ""), (5, "")], key=str)


def test_quality_and_language_by_row(spark):
    docs = table(spark, D, "documents")
    model = quality.train(docs, table(spark, D, "labels"), remainder("doc_id", 5) != 0)
    found = {r.doc_id: r.predicted for r in quality.score(docs, model).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    good, bad = (next(text[i] for i in sorted(found) if found[i] == k and text[i]) for k in (1, 0))
    assert texts(spark, [(1, good), (1, bad), (None, bad), (None, good)], p.keep_quality) == [(1, good), (None, good)]
    assert texts(spark, [(1, good), (1, "12 34"), (None, "12 34"), (None, good)], p.keep_languages) == [(1, good), (None, good)]


def test_clashing_columns(spark):
    """Columns with the names that stages might use inside come out as they went in."""
    docs = table(spark, D, "documents")
    model = quality.train(docs, table(spark, D, "labels"), remainder("doc_id", 5) != 0)
    good = [r.doc_id for r in quality.score(docs, model).where("predicted = 1").orderBy("doc_id").limit(6).collect()]
    rows = docs.where(docs.doc_id.isin(good)).collect()
    names = ["row_key", "row_key_", "ROW_KEY__", "key", "node", "score", "component_id", "predicted", "lang_pred", "fit", "rank", "spans", "a.b"]
    df = spark.createDataFrame([(*r, *[f"mine {r.doc_id} {c}" for c in names]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in names))
    for name, stage in p.STAGES[:-1]:
        df = stage(spark, df, D).persist()
        assert df.columns == [*docs.columns, *names], name
        got = df.collect()
        assert got and all(r[c] == f"mine {r.doc_id} {c}" for r in got for c in names), name
    assert {r.doc_id for r in p.STAGES[-1][1](spark, df, D).collect()} == {r.doc_id for r in got}
