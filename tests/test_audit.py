"""Keys, references and counts of many tables through one exchange."""

import re

from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS, Contract
from lakeviews.operators import audit as A
from lakeviews.operators import quality as QC
from lakeviews.plans.registry import registry_quality as RQ


def colliding(keys):
    """All keys share the first fingerprint."""
    return F.lit(7).cast("long"), A.fingerprints(keys)[1]


def frames(spark):
    child = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (2, None, "y"), (None, "a", "z"), (None, "a", None), (3, "b", "x"), (3, "b", "w")],
                                  "k int, part string, ref string")
    parent = spark.createDataFrame([("x",), ("y",), (None,), ("q",), ("x",)], "code string")
    return {"child": child, "parent": parent, "empty": parent.limit(0)}


RULES = [A.Unique("child", ("k", "part")), A.Refer("child", "ref", "parent", "code"), A.Count("child", lambda d: F.col("ref").isNull()),
         A.Unique("parent", ("code",)), A.Refer("child", "ref", "empty", "code"), A.Unique("empty", ("code",)), A.Count("empty", lambda d: F.lit(True))]
WANT = [A.Total(7, 3, 3, 7), A.Total(6, 0, 0, 2), A.Total(1), A.Total(5, 1, 1), A.Total(6, 0, 0, 6), A.Total(), A.Total()]


def told(totals):
    """The figures that a rule of its kind means."""
    return [(t.rows, t.repeated, t.void) if isinstance(r, A.Unique) else t.orphans if isinstance(r, A.Refer) else t.rows for r, t in zip(RULES, totals)]


def test_rules(spark):
    assert told(A.audit(frames(spark), RULES)) == told(WANT)


def test_forced_collisions_are_counted_in_full(spark):
    assert told(A.audit(frames(spark), RULES, colliding)) == told(WANT)


def test_nulls_and_neighbouring_values_are_told_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", "a"), ("a", ""), (None, None), (None, None)], "x string, y string")
    assert A.audit({"t": df}, [A.Unique("t", ("x", "y"))])[0].repeated == 1


def test_one_exchange_by_key_and_one_scan_a_table(spark, small_dir):
    cur = RQ.all_coerced(RQ._raw(spark, small_dir))
    rules = [A.Unique(n, tuple(CONTRACTS[n].primary_key)) for n in cur] + [A.Refer(n, c, p, pc) for n in cur for c, p, pc in CONTRACTS[n].fk_checks]
    plan = A.grouped(cur, rules)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(rule#\d+, one#", plan)) == 1
    assert plan.count("Generate inline") <= len(cur)


def test_hot_key_costs_a_row_a_task(spark):
    n = 60_000
    df = spark.range(n).repartition(8).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"))
    groups = A.grouped({"t": df}, [A.Unique("t", ("k",))])
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert A.audit({"t": df}, [A.Unique("t", ("k",))])[0].repeated == n // 3 - 1


def test_dataset_metrics_equal_the_checks_of_one_dataset(spark, small_dir):
    cur = RQ.all_coerced(RQ._raw(spark, small_dir))
    names = ["sales.regions", "sales.customers", "sales.orders", "sales.order_lines", "marketing.leads_by_campaign", "marketing.campaigns"]
    some = {n: cur[n] for n in names}
    got = {tuple(r) for r in QC.dataset_metrics(some, CONTRACTS).collect()}
    want = set()
    for n in names:
        want |= {tuple(r) for r in QC.run_quality_checks(some[n], CONTRACTS[n], some).collect()}
    assert got == want


def test_missing_parents_columns_and_keys(spark):
    c = Contract("t", "child", {"id": "string", "ref": "string"}, ("id",), ("id", "gone"), (("ref", "t.parent", "code"), ("gone", "t.parent", "code")))
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "id string, ref string")
    parent = spark.createDataFrame([("x",)], "code string")
    contracts = {"t.child": c}

    def metrics(frames, **more):
        return {(r.check, r.column): r.value for r in QC.dataset_metrics(frames, contracts, **more).collect()}

    assert metrics({"t.child": df}, parents={"t.parent": parent}) == {("row_count", None): 2, ("duplicate", None): 1, ("null", "id"): 0, ("fk", "ref"): 1, ("fk", "gone"): -1}
    assert metrics({"t.child": df}, parents={})[("fk", "ref")] == -1
    assert metrics({"t.child": df.select("ref")}, parents={})[("duplicate", None)] == 0
