"""Dataset catalogue: register / upsert / list / missing."""

import datetime as dt

from lakeviews.plans import catalog as CAT
from lakeviews.session import scratch_path


def _profile(spark, domain, name, n, when):
    df = spark.range(n).selectExpr("cast(id as string) as k")
    return CAT.profile_dataset(df, domain, name, ["dt"], when)


def test_register_and_get(spark):
    cat = CAT.upsert(CAT.empty_catalog(spark), _profile(spark, "sales", "orders", 100, dt.datetime(2024, 1, 1)))
    rows = CAT.catalog_get(cat, "sales", "orders").collect()
    assert len(rows) == 1 and rows[0].row_count == 100
    assert rows[0].schema_json == '{"k":"string"}' and rows[0].partition_keys == '["dt"]'


def test_upsert_replaces(spark):
    cat = CAT.upsert(CAT.empty_catalog(spark), _profile(spark, "hr", "employees", 50, dt.datetime(2024, 1, 1)))
    cat = CAT.upsert(cat, _profile(spark, "hr", "employees", 75, dt.datetime(2024, 1, 2)))
    rows = CAT.catalog_get(cat, "hr", "employees").collect()
    assert [r.row_count for r in rows] == [75]


def test_list_and_missing(spark):
    cat = CAT.upsert(CAT.empty_catalog(spark), _profile(spark, "sales", "orders", 10, dt.datetime(2024, 1, 1))
                     .unionByName(_profile(spark, "hr", "employees", 20, dt.datetime(2024, 1, 1))))
    names = [(r.domain, r.dataset_name) for r in CAT.catalog_list(cat).collect()]
    assert names == [("hr", "employees"), ("sales", "orders")]
    assert CAT.catalog_get(cat, "nonexistent", "dataset").count() == 0


def test_save_and_load(spark):
    root = scratch_path(spark, "catalog-test")
    cat = CAT.upsert(CAT.empty_catalog(spark), _profile(spark, "sales", "orders", 3, dt.datetime(2024, 1, 1)))
    CAT.save_catalog(cat, root)
    assert CAT.load_catalog(spark, root).count() == 1
    assert CAT.load_catalog(spark, scratch_path(spark, "empty")).count() == 0


def test_a_failing_read_raises(spark):
    """Only a catalogue that was never written is empty: a lost version or an empty pointer is an error."""
    import os

    import pytest

    root = scratch_path(spark, "catalog-test")
    first = CAT.upsert(CAT.empty_catalog(spark), _profile(spark, "sales", "orders", 3, dt.datetime(2024, 1, 1)))
    path = CAT.save_catalog(first, root)
    second = CAT.upsert(CAT.load_catalog(spark, root), _profile(spark, "hr", "employees", 4, dt.datetime(2024, 1, 2)))
    newest = CAT.save_catalog(second, root)
    assert newest != path and CAT.load_catalog(spark, root).count() == 2
    os.rename(newest, newest + "-gone")
    with pytest.raises(Exception):
        CAT.load_catalog(spark, root).count()
    empty = scratch_path(spark, "catalog-test")
    spark.createDataFrame([], "value string").write.text(f"{empty}/catalog/_CURRENT")
    with pytest.raises(ValueError):
        CAT.load_catalog(spark, empty)
