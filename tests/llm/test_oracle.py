"""Queries against their SQL counterparts."""

from __future__ import annotations

import os

import duckdb
import pytest

from sedimenta.llm import oracle, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("query", list(oracle.SQL))
def test_equals_oracle(spark, query):
    duck = duckdb.connect()
    for name in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    df = queries.ALL[query](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = df.select(*columns).toArrow().to_pylist()
    quoted = ", ".join(f'"{c}"' for c in columns)
    theirs = duck.sql(f"SELECT {quoted} FROM ({oracle.SQL[query]})").to_arrow_table().to_pylist()
    assert len(ours) == len(theirs) > 0
    key = lambda row: repr(list(row.values()))
    assert sorted(ours, key=key) == sorted(theirs, key=key)
    assert {c: type(v) for c, v in ours[0].items()} == {c: type(v) for c, v in theirs[0].items()}


def test_queries_without_oracle_are_those_that_sql_cannot_express():
    without = set(queries.ALL) - set(oracle.SQL)
    assert sorted(int(q[2:].split("_")[0]) for q in without) == [1, 3, 4, 5, 6, 7, 8]
