"""Every registered query against its DuckDB oracle on sf0.001 (the driver does the same at sf0.01)."""
import datetime
import decimal
import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from lakewright.suite.oracle import ORACLE_SQL
from lakewright.suite.spark_side import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("inf" if v == math.inf else "-inf" if v == -math.inf else round(v, 6))
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, got) == _rows(rel.columns, want)


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].status == "success" and rows[0].rows == 1500
