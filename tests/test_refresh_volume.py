"""The full refresh moves and writes less: compressed landings, rows put in order before they become text, unique keys by one fingerprint."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from test_audit import RULES, WANT, colliding, frames, told

from lakeviews.contracts import CONTRACTS, Contract
from lakeviews.functions.coerce import coerce_types
from lakeviews.operators import audit as A
from lakeviews.operators import quality as QC
from lakeviews.operators.dedupe import SEQ, dedupe_keep_last
from lakeviews.plans import job as JOB
from lakeviews.plans.raw_zone import RawZone
from lakeviews.session import scratch_path
from lakeviews.sources import lake as L

THINGS = Contract("test", "things", {"id": "string", "note": "string"}, ("id",))


def test_keys_expected_to_be_unique_have_the_same_totals(spark):
    assert told(A.audit(frames(spark), RULES, unique=True)) == told(WANT)
    assert told(A.audit(frames(spark), RULES, colliding, unique=True)) == told(WANT)
    alone = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (None, None)], "k int, part string")
    assert A.audit({"t": alone}, [A.Unique("t", ("k", "part"))], unique=True) == [A.Total(4, 0, 3, 4)]
    contracts = {"test.things": Contract("test", "things", {"id": "string"}, ("id",), ("id",))}
    twice = {"test.things": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")}
    assert sorted(QC.dataset_metrics(twice, contracts, unique=True).collect()) == sorted(QC.dataset_metrics(twice, contracts).collect())


def test_unique_keys_send_one_fingerprint(spark):
    rows = A._united(frames(spark), RULES, A.fingerprints, unique=True)
    sent = {r.rule: r.n for r in rows.filter("two IS NOT NULL").groupBy("rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sent and not any(isinstance(RULES[k], A.Unique) for k in sent) and any(isinstance(RULES[k], A.Refer) for k in sent)


def test_compressed_landing_keeps_rows_and_their_order(spark, monkeypatch):
    monkeypatch.setattr(L, "GZIP_RECORDS", 3)
    rows = [(f"k{i // 2}", f'"{i}",\nnext' if i % 3 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, note string").coalesce(1)
    root = scratch_path(spark, "gzip-test")
    L.land_raw(df, root, "test", "things", "2024-01-01", "gzip")
    files = L.data_files(spark, f"{L.raw_path(root, 'test', 'things')}/dt=2024-01-01")
    assert len(files) == 7 and all(path.endswith(".csv.gz") for path, _ in files)
    for split_above in (None, 0):
        read = L.scan_raw_csv(spark, root, THINGS, split_above=split_above).orderBy(SEQ).select("id", "note").collect()
        assert [tuple(r) for r in read] == rows
        last = dedupe_keep_last(L.scan_raw_csv(spark, root, THINGS, split_above=split_above), ["id"], SEQ).drop(SEQ).collect()
        assert {r.id: r.note for r in last} == dict(rows)
    assert sum(r.data_rows for r in L.raw_file_inventory(spark, root).collect()) == 20


def test_the_job_lands_compressed_files(spark):
    root = scratch_path(spark, "gzip-job")
    regions = spark.createDataFrame([("A", "g", "a")], "region_code string, country_group string, sub_region string")
    JOB.land_all({"sales.regions": regions}, root, "2024-01-02", JOB.Journal(spark, f"{root}/_journal", "k"))
    files = L.data_files(spark, f"{L.raw_path(root, 'sales', 'regions')}/dt=2024-01-02")
    assert files and all(path.endswith(".csv.gz") for path, _ in files)


LINES = [(1, 1, 7, 2.0, 10.5, 0.1), (1, 1, 7, 17.0, 10.5, 0.1), (1, 1, 12, 1.0, 3.0, 0.0), (5, None, 7, 1.0, 1.0, 0.0), (None, 5, 9, 1.0, 1.0, 0.0), (2, 1, 3, None, 4.0, 0.0), (2, 1, 3, 1.0, None, 0.0)]


@pytest.mark.parametrize("turned", [False, True])
def test_lines_are_put_in_order_before_they_become_text(spark, turned):
    lines = spark.createDataFrame(LINES[::-1] if turned else LINES, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double")
    raw = RawZone(SimpleNamespace(t=SimpleNamespace(lineitem=lines)))
    name = "sales.order_lines"
    contract, df = CONTRACTS[name], raw.dataset(name)
    ordered = raw.ordered(name)
    assert ordered.columns == df.columns and sorted(map(str, ordered.collect())) == sorted(map(str, df.collect()))
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" in plan[:plan.index("Sort [")] and "concat_ws" not in plan[plan.index("Sort ["):]
    # of rows with one key, the last is the greatest by the coerced columns
    last = {r.order_line_id: r for r in ordered.collect()}
    rest = [c for c in contract.columns if c != "order_line_id"]
    typed = coerce_types(df, contract)
    want = typed.groupBy("order_line_id").agg(F.max(F.struct(*rest)).alias("r")).collect()
    kept = {r.order_line_id: r for r in coerce_types(spark.createDataFrame(list(last.values()), df.schema), contract).collect()}
    assert len(want) == 3 and all(tuple(kept[w.order_line_id][c] for c in rest) == tuple(w.r) for w in want)


def test_large_datasets_are_made_of_their_tables(spark, small_dir):
    from lakeviews.plans.binding import StarBinding

    raw = RawZone(StarBinding(spark, small_dir))
    for name in ("sales.orders", "sales.order_lines", "finance.gl_transactions", "inventory.warehouse_movements"):
        df, ordered = raw.dataset(name), raw.ordered(name)
        assert name in raw.made_of and ordered.schema.names == df.schema.names
        assert ordered.exceptAll(df).isEmpty() and df.exceptAll(ordered).isEmpty()
