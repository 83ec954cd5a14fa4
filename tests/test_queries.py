"""Every registered query against its SQL check on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from siftwork.plans.registry import CHECKS, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings events pages benchmark labels conversations part".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def checks():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(round(float(value), 8))
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and sum(r["kept"] + r["dropped"] for r in rows) > 100


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, checks, name):
    frame = entry.queries()[name](spark, FOLDER)
    expected = checks.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    assert _rows(frame.columns, frame.collect()) == _rows(expected.columns, expected.fetchall())
