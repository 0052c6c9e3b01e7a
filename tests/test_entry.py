"""The driver contract: entry() runs, every query has an oracle, results equal the oracle (sf0.001)."""

import datetime
import decimal
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from lakeshore.plans import registry
from lakeshore.sources.driver import TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["number_of_users", "country"]
    assert 0 < df.count() <= 10


def test_every_query_has_an_oracle():
    # Of the optional text operators only some can be put in SQL; they have tests of their own.
    assert set(registry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = Counter(tuple(norm(x) for x in r) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = [ocols.index(c) for c in df.columns]
    want = Counter(tuple(norm(r[i]) for i in order) for r in res.fetchall())
    assert got == want
