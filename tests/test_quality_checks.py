"""Cleaning and quality operators on literal frames (the reference's unit cases plus edge cases)."""

import json

from pyspark.sql import functions as F

from lakeviews.contracts import Contract
from lakeviews.functions.coerce import coerce_types
from lakeviews.operators import quality as QC
from lakeviews.operators.dedupe import dedupe_keep_last

SIMPLE = Contract("test", "widgets", {"id": "string", "name": "string", "amount": "float", "qty": "int"},
                  ("id",), ("id", "name"))
CHILD = Contract("test", "widget_orders", {"order_id": "string", "widget_id": "string"},
                 ("order_id",), ("order_id",), (("widget_id", "test.widgets", "id"),))


def metric(df, check, column=None):
    rows = df.where(F.col("check") == check).collect()
    if column is not None:
        rows = [r for r in rows if r.column == column]
    assert len(rows) == 1, rows
    return rows[0].value


def test_check_nulls_detects_missing_values(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y"), ("c", None)], "id string, name string")
    m = QC.check_nulls(df, SIMPLE)
    assert metric(m, "null", "id") == 1
    assert metric(m, "null", "name") == 1
    assert metric(m, "row_count") == 3


def test_check_nulls_clean_data(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, name string")
    m = QC.check_nulls(df, SIMPLE)
    assert metric(m, "null", "id") == 0 and metric(m, "null", "name") == 0


def test_nan_counts_as_missing(spark):
    c = Contract("t", "f", {"f": "float"}, ("f",), ("f",))
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "f double")
    assert metric(QC.check_nulls(df, c), "null", "f") == 2


def test_check_duplicates_detects_repeated_key(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x2"), ("b", "y")], "id string, name string")
    assert metric(QC.check_duplicates(df, SIMPLE), "duplicate") == 1


def test_duplicates_null_keys_compare_equal(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), ("b", "y")], "id string, name string")
    assert metric(QC.check_duplicates(df, SIMPLE), "duplicate") == 1


def test_duplicates_without_key_columns_is_zero(spark):
    df = spark.createDataFrame([("x",), ("x",)], "name string")
    assert metric(QC.check_duplicates(df, SIMPLE), "duplicate") == 0


def test_dedupe_keeps_last(spark):
    df = spark.createDataFrame([("a", "old", 0), ("a", "new", 1), ("b", "y", 2)], "id string, name string, seq int")
    out = dedupe_keep_last(df, ["id"], "seq").collect()
    assert len(out) == 2
    assert [r.name for r in out if r.id == "a"] == ["new"]


def test_dedupe_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, "old", 0), (None, "new", 1)], "id string, name string, seq int")
    out = dedupe_keep_last(df, ["id"], "seq").collect()
    assert [(r.id, r.name) for r in out] == [(None, "new")]


def test_dedupe_without_key_is_unchanged(spark):
    df = spark.createDataFrame([("x", 0), ("x", 1)], "name string, seq int")
    assert dedupe_keep_last(df, ["id"], "seq").count() == 2


def test_referential_integrity_flags_orphans(spark):
    parent = spark.createDataFrame([("w1",), ("w2",)], "id string")
    child = spark.createDataFrame([("o1", "w1"), ("o2", "w999")], "order_id string, widget_id string")
    m = QC.check_referential_integrity(child, CHILD, {"test.widgets": parent})
    assert metric(m, "fk", "widget_id") == 1


def test_referential_integrity_passes(spark):
    parent = spark.createDataFrame([("w1",), ("w2",)], "id string")
    child = spark.createDataFrame([("o1", "w1"), ("o2", "w2")], "order_id string, widget_id string")
    assert metric(QC.check_referential_integrity(child, CHILD, {"test.widgets": parent}), "fk", "widget_id") == 0


def test_null_fk_is_not_an_orphan(spark):
    parent = spark.createDataFrame([("w1",)], "id string")
    child = spark.createDataFrame([("o1", None), ("o2", "w1")], "order_id string, widget_id string")
    assert metric(QC.check_referential_integrity(child, CHILD, {"test.widgets": parent}), "fk", "widget_id") == 0


def test_missing_parent_is_minus_one(spark):
    child = spark.createDataFrame([("o1", "w1")], "order_id string, widget_id string")
    assert metric(QC.check_referential_integrity(child, CHILD, {}), "fk", "widget_id") == -1


def _report(spark, rows, contract=SIMPLE, parents=None):
    df = spark.createDataFrame(rows, "id string, name string")
    return QC.quality_report(QC.run_quality_checks(df, contract, parents)).collect()[0]


def test_report_passes_for_clean_data(spark):
    r = _report(spark, [("a", "x"), ("b", "y")])
    assert r.passed is True and r.row_count == 2


def test_report_fails_with_nulls(spark):
    r = _report(spark, [("a", "x"), (None, "y")])
    assert r.passed is False and r.null_violations["id"] == 1


def test_report_fails_when_parent_missing(spark):
    df = spark.createDataFrame([("o1", "w1")], "order_id string, widget_id string")
    r = QC.quality_report(QC.run_quality_checks(df, CHILD, {})).collect()[0]
    assert r.passed is False and r.fk_violations["widget_id->test.widgets"] == -1


def test_quality_summary(spark):
    ok = spark.createDataFrame([("a", "x")], "id string, name string")
    bad = spark.createDataFrame([(None, "x")], "id string, name string")
    other = Contract("test", "other", SIMPLE.columns, SIMPLE.primary_key, SIMPLE.not_null)
    m = QC.run_quality_checks(ok, SIMPLE).unionByName(QC.run_quality_checks(bad, other))
    s = QC.quality_summary(QC.quality_report(m)).collect()[0]
    assert (s.datasets_processed, s.datasets_with_warnings) == (2, 1)


def test_coerce_types_converts_date_int_float_bool(spark):
    c = Contract("test", "mixed", {"d": "date", "n": "int", "f": "float", "b": "bool"}, ("d",))
    df = spark.createDataFrame([("2024-01-15", "10", "1.5", "true"), ("2024-02-01", "20", "2.75", "false")],
                               "d string, n string, f string, b string")
    r = coerce_types(df, c).collect()
    assert str(r[0].d) == "2024-01-15"
    assert r[0].n == 10 and r[1].f == 2.75 and r[0].b is True and r[1].b is False


def test_coerce_bad_number_is_null(spark):
    c = Contract("test", "mixed2", {"n": "int"}, ("n",))
    r = coerce_types(spark.createDataFrame([("10",), ("not_a_number",)], "n string"), c).collect()
    assert r[0].n == 10 and r[1].n is None


def test_coerce_edge_cases(spark):
    c = Contract("t", "e", {"i": "int", "f": "float", "b": "bool", "d": "date", "s": "string"}, ("s",))
    rows = [("10.0", "1.0d", None, "2024-1-5", "007"), ("1.5", "NaN", "Yes", "2024-01-05 10:30:00", "x"),
            (" 12 ", "1e3", "0", "not a date", None)]
    r = coerce_types(spark.createDataFrame(rows, "i string, f string, b string, d string, s string"), c).collect()
    assert [x.i for x in r] == [10, None, 12]
    assert [x.f for x in r] == [None, None, 1000.0]
    assert [x.b for x in r] == [False, True, False]
    assert [str(x.d) for x in r] == ["2024-01-05", "2024-01-05", "None"]
    assert [x.s for x in r] == ["007", "x", None]


def test_overlong_text_is_counted(spark):
    df = spark.createDataFrame([("x" * 21,), ("ok",)], "region_code string")
    m = QC.varchar_violations(df, "dim_region", {"region_code": 20})
    assert metric(m, "varchar", "region_code") == 1


def test_enforce_raises_on_duplicate_primary_key(spark):
    import pytest
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    with pytest.raises(QC.ConstraintViolation):
        QC.enforce(QC.primary_key_violations(df, "t", ["k"]))


def test_report_maps_serialise(spark):
    r = _report(spark, [("a", "x")])
    assert json.loads(json.dumps(r.null_violations)) == {"id": 0, "name": 0}


def test_coercion_reads_whole_texts_exactly(spark):
    from lakeviews.functions import coerce as CO

    dates = ["2024-01-05", "2024-1-5", " 2024-01-05T10:20:30Z ", "2024-01-05 10:20", "2024-01-05 garbage", "2024-01-05Tzzz", "2024-13-01", "20240105"]
    got = [r.d is not None for r in spark.createDataFrame([(d,) for d in dates], "t string").select(CO.coerce_date(F.col("t")).alias("d")).collect()]
    assert got == [True] * 4 + [False] * 4
    ints = ["9007199254740993.0", "9007199254740993", "9223372036854775807.000", "9223372036854775808", "1e3", "1.5", "1e400"]
    got = [r.i for r in spark.createDataFrame([(d,) for d in ints], "t string").select(CO.coerce_int(F.col("t")).alias("i")).collect()]
    assert got == [9007199254740993, 9007199254740993, 9223372036854775807, None, 1000, None, None]
    floats = ["1e400", "inf", "NaN", "-2.5e-3", "1.0d"]
    got = [r.x for r in spark.createDataFrame([(d,) for d in floats], "t string").select(CO.coerce_float(F.col("t")).alias("x")).collect()]
    assert got == [None, None, None, -0.0025, None]


def test_enforce_names_every_violation(spark):
    import pytest

    from lakeviews.operators import quality as QC

    rows = [("t", "fk", f"c{i}", "p", i + 1) for i in range(9)]
    with pytest.raises(QC.ConstraintViolation) as e:
        QC.enforce(spark.createDataFrame(rows, QC.METRIC_SCHEMA))
    assert all(f"t.c{i} fk={i + 1}" in str(e.value) for i in range(9))
