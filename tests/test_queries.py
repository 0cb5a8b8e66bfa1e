"""Registered queries against their SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks import oracles, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are missing")
QUERIES, SQL = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(f.removesuffix(".parquet") for f in os.listdir(SF)):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.date().isoformat()
    return value.isoformat() if isinstance(value, datetime.date) else value


def table(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    got, expected = table(df.columns, df.collect()), table(names, cursor.fetchall())
    assert expected and got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_yields_whole_finite_forecasts(spark, name):
    df = QUERIES[name](spark, SF)
    values = [r["l_quantity"] for r in df.collect()]
    assert len(values) == 210 and all(map(math.isfinite, values))


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
