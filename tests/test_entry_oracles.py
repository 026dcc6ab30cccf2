"""Driver contract: entry() runs, and every key agrees with its DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from lakeviews.plans.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KEYS = sorted(QUERIES)  # the library's own, with or without its optional parts


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("~",)
    if isinstance(v, (float, decimal.Decimal)):
        return ("f", float(v))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (dt.date, dt.datetime)):
        return ("d", v.isoformat())
    return ("s", str(v))


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck(small_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1011
    assert df.columns == ["department", "region_code", "month_start", "hr_cost", "gl_revenue", "cogs",
                          "gross_margin"]


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, duck, small_dir, key):
    df = E.queries()[key](spark, small_dir)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert rows_of(scols, srows) == rows_of(ocols, orows)
