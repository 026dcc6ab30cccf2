"""Queries with SQL equal DuckDB's result, every column."""

import duckdb
import pytest
from helpers import MEDIUM

from lakeviews.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, name):
    got = QUERIES[name](spark, MEDIUM)
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{MEDIUM}/{table}.parquet'")
    want = con.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    assert sorted(map(repr, got.select(*names).toPandas().itertuples(index=False, name=None))) == \
        sorted(map(repr, want.df()[names].itertuples(index=False, name=None)))
