"""Every query with SQL gives what the SQL gives, on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from shelfshare.plans import ORACLE_SQL, QUERIES

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, (decimal.Decimal, float)) or isinstance(x, int) and not isinstance(x, bool):
            return repr(round(float(x), 6) + 0.0)
        return str(x.date() if isinstance(x, datetime.datetime) else x)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, db, name):
    got, want = QUERIES[name](spark, D), db.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["grp", "dc", "store", "share_trimmed_90"]


def test_shares_add_up(spark):
    rows = QUERIES["final_share"](spark, D).groupBy("grp").agg({"share_trimmed_90": "sum"}).collect()
    assert all(abs(r[1] - 1) < 1e-4 for r in rows)
    exact = QUERIES["normalise_to_100"](spark, D).groupBy("sku", "channel").agg({"percent": "sum"}).collect()
    assert all(abs(r[2] - 100) < 1e-9 for r in exact)
