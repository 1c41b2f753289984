"""Every query that has SQL gives the same rows as DuckDB."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from leafwork.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def text(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{float(v):.9g}" if isinstance(v, (float, Decimal)) else str(v)


def table(columns, found):
    order = sorted(columns)
    return sorted(tuple(text(r[c]) for c in order) for r in found)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = df.collect()
    if name in ORACLES:
        q = duck.execute(ORACLES[name])
        columns = [d[0] for d in q.description]
        assert sorted(columns) == sorted(df.columns)
        assert table(df.columns, found) == table(columns, [dict(zip(columns, r)) for r in q.fetchall()])


def test_entry(spark):
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).columns
