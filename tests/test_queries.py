"""Registered queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

from tabwarden.oracle import ORACLE_SQL
from tabwarden.queries import QUERIES, TABLES

# The wide imputation and the saved and streamed models are covered by tests of their own.
ELSEWHERE = {"model_roundtrip", "stream_score", "assemble"}


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _normal(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    value = float(value)
    return None if math.isnan(value) else round(value, 6) + 0.0


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in ORACLE_SQL if n not in ELSEWHERE])
def test_query_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


def test_streamed_rows_equal_the_batch(spark, sf):
    assert tuple(QUERIES["stream_score"](spark, sf).first()) == (1500, 0)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE_SQL) <= set(QUERIES)
