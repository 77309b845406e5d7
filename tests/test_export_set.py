"""A set of export files: whole or refused."""

import glob
import os

import pytest

from shelfshare.sources import export_set

KINDS = "category string, SKU string, CANAL string, LOJA string, PERCENTUAL double"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(c, f"{c}{s}", ch, f"0021_{k:05d}", 12.5) for c in ("A#1", "B") for s in range(5) for ch in ("ONLINE", "OFFLINE") for k in range(4)], KINDS)


@pytest.fixture
def path(spark, rows, tmp_path):
    where = f"file://{tmp_path}/set"
    export_set.write(rows, where, 20)
    return where


def folder(path):
    return path.removeprefix("file://")


def test_a_set_comes_back(spark, rows, path):
    got = export_set.read(spark, path)
    assert got.columns == ["SKU", "CANAL", "LOJA", "PERCENTUAL", "category", "file_no"]
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted((s, c, k, "12,500", g) for g, s, c, k, _ in (tuple(r) for r in rows.collect()))
    files = got.groupBy("SKU").agg({"file_no": "min", "category": "count"}).collect()
    assert len(files) == 10 and got.select("category", "file_no").distinct().count() >= 4
    per = got.groupBy("file_no").count().collect()
    assert all(r["count"] <= 20 + 8 for r in per)


def test_an_uncommitted_set_is_refused(spark, rows, tmp_path, monkeypatch):
    where = f"file://{tmp_path}/dead"

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(export_set._Files, "publish", dies)
        with pytest.raises(KeyboardInterrupt):
            export_set.write(rows, where, 20)
    assert os.path.isdir(f"{folder(where)}/manifest")
    with pytest.raises(export_set.Refused, match="no committed set"):
        export_set.read(spark, where)
    with pytest.raises(export_set.Refused, match="in use"):
        export_set.write(rows, where, 20)
    with pytest.raises(export_set.Refused, match="no committed set"):
        export_set.read(spark, f"file://{tmp_path}/nothing")


@pytest.mark.parametrize("harm", ["cut", "gone", "changed", "more"])
def test_other_files_are_refused(spark, path, harm):
    files = sorted(glob.glob(f"{folder(path)}/data/*/*/*.csv"))
    text = open(files[0]).read()
    for crc in glob.glob(f"{folder(path)}/data/*/*/.*.crc"):
        os.remove(crc)
    if harm == "gone":
        os.remove(files[0])
    elif harm == "more":
        open(files[0].replace("part-", "part-9"), "w").write(text)
    else:
        open(files[0], "w").write(text[: text.rindex("\n", 0, -1) + 1] if harm == "cut" else text.replace("12,500", "12,400", 1))
    with pytest.raises(export_set.Refused, match="not as they were committed"):
        export_set.read(spark, path)
    if harm != "gone":
        assert export_set.read(spark, path, check=False).count() > 0


def test_an_empty_set(spark, rows, tmp_path):
    where = f"file://{tmp_path}/none"
    assert export_set.write(rows.limit(0), where)["rows"] == 0
    got = export_set.read(spark, where)
    assert got.count() == 0 and got.columns[:4] == ["SKU", "CANAL", "LOJA", "PERCENTUAL"]
