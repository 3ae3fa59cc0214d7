"""Every named query against the same question asked of DuckDB."""

import math
import os
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry
from tillstream.plans.oracles import ORACLES
from tillstream.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["lineitem", "orders", "part", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '{FOLDER}/{table}.parquet'"
        )
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    expected = cursor.fetchall()
    assert sorted(ours.columns) == sorted(names)
    got = rows_by_name(ours.columns, ours.collect())
    want = rows_by_name(names, expected)
    assert len(got) == len(want)
    assert got == want
    assert got, "an empty result shows nothing"


def test_entry(spark):
    assert entry(spark).count() == 10
