"""Queries of the training-data part that SQL can express, held against it on whole tables."""

import duckdb
import pytest

from shelfshare.llm.queries import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    got, want = QUERIES[name](spark, D), con.sql(ORACLE_SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    place = [want.columns.index(c) for c in order]
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=str) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=str)
