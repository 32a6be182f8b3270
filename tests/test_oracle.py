"""Every registered query against its SQL counterpart, and the plans behind it."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from analog import oracle
from analog import queries as layers

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        table = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_layer_query_has_an_oracle():
    assert set(layers.ALL) == set(oracle.SQL)


@pytest.mark.parametrize("query", list(layers.ALL))
def test_equals_oracle(spark, duck, query):
    df = driver.queries()[query](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = df.select(*columns).toArrow().to_pylist()
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = duck.sql(f"SELECT {quoted} FROM ({driver.oracle_sql()[query]})")
    assert theirs.columns == columns
    theirs = theirs.to_arrow_table().to_pylist()
    assert len(ours) == len(theirs) > 0
    key = lambda row: repr(list(row.values()))
    assert sorted(ours, key=key) == sorted(theirs, key=key)


def test_entry_returns_rows(spark):
    assert driver.entry(spark).columns == ["year", "month", "mean_amount"]
    assert driver.entry(spark).count() == 83
