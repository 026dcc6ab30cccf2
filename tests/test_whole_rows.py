"""The whole-dataset keys return rows with every value, not counts of them."""

import pytest

from lakeviews.contracts import CONTRACTS, STAR_TABLES
from lakeviews.operators import dedupe
from lakeviews.plans.registry import QUERIES


@pytest.mark.parametrize("key", ["coerce_types", "clean_dataset"])
def test_every_column_of_every_dataset(spark, small_dir, key):
    df = QUERIES[key](spark, small_dir)
    assert {c for contract in CONTRACTS.values() for c in contract.columns} | {"dataset"} == set(df.columns)
    assert {r.dataset for r in df.select("dataset").distinct().collect()} == set(CONTRACTS)


def test_every_column_of_every_star_table(spark, small_dir):
    df = QUERIES["load_star_table"](spark, small_dir)
    assert {c for t in STAR_TABLES.values() for c, _, _ in t.columns} | {"table_name"} == set(df.columns)


def test_a_wrong_kept_row_shows(spark, small_dir, monkeypatch):
    def digest():
        from pyspark.sql import functions as F

        df = QUERIES["clean_dataset"](spark, small_dir)
        return df.select(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()[0]

    right = digest()
    monkeypatch.setattr(dedupe.F, "max_by", dedupe.F.min_by)
    assert digest() != right
