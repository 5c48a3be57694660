"""Every registered query against its SQL, over whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from basketry.catalog.oracle import ORACLE
from basketry.catalog.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(expected)
    ours, theirs = _rows(df.columns, found), _rows(columns, expected)
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    assert not differing, (len(differing), differing[:3])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_model_query_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_has_one_row_per_category(spark):
    assert entry(spark).count() == 6
