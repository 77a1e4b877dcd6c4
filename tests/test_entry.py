"""Registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from lamellar.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(rows):
    shown = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(shown, r)) for r in rows)


def compare(spark, duck, name, query, sql):
    df = query(spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    rows = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert plain(map(tuple, df.select(*columns).collect())) == plain(rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    compare(spark, duck, name, QUERIES[name], ORACLES[name])


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
