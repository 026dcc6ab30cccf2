"""The full refresh on the sf0.001 input tables, end to end."""

import os

from pyspark.sql import functions as F

from lakeviews.contracts import TRANSFORM_ORDER
from lakeviews.plans import job as JOB
from lakeviews.plans.binding import StarBinding
from lakeviews.plans.raw_zone import RawZone
from lakeviews.session import scratch_path


def test_full_refresh(spark, small_dir):
    raw = RawZone(StarBinding(spark, small_dir))
    root = scratch_path(spark, "job-test")
    exports = f"{root}/exports"
    result = JOB.job_full_refresh(spark, {n: raw.dataset(n) for n in TRANSFORM_ORDER}, root,
                                  "2024-01-02", export_root=exports)

    reports = {r.dataset: r for r in result.reports.collect()}
    assert set(reports) == set(TRANSFORM_ORDER)
    # De-duplication ran before the checks: no key repeats survive.
    assert all(r.duplicate_key_count == 0 for r in reports.values())
    # Customers of one nation point at an unknown region; pending orders have no customer.
    assert reports["sales.customers"].fk_violations["region_code->sales.regions"] > 0
    assert reports["sales.orders"].null_violations["customer_id"] > 0
    assert reports["sales.regions"].passed

    before = {r.dataset: r.value for r in result.metrics.where(F.col("check") == "rows_before_dedupe").collect()}
    assert before["finance.gl_transactions"] > reports["finance.gl_transactions"].row_count

    cat = {(r.domain, r.dataset_name): r.row_count for r in result.catalog.collect()}
    assert len(cat) == 16
    assert cat[("finance", "gl_transactions")] == raw.dataset("finance.gl_transactions") \
        .select("txn_id").distinct().count()

    # HR rows are unique per key, so the view keeps the binding's grain.
    assert result.views["vw_revenue_vs_hr_cost_by_region"].count() == 1011
    assert result.views["vw_marketing_spend_vs_sales"].count() == 393
    assert result.views["vw_department_pnl"].where(F.col("revenue") < 0).count() == 0

    local = exports.replace("file:", "")
    for name, _, _ in JOB.EXPORTS:
        assert [f for f in os.listdir(f"{local}/{name}") if f.endswith(".csv")], name


def test_rerun_same_day_is_idempotent(spark, small_dir):
    """A second run for the same day re-lands that day, writes a new star version and gives the same views."""
    from lakeviews.sources import lake as L

    raw = RawZone(StarBinding(spark, small_dir).materialize_joins())
    inputs = {n: raw.dataset(n) for n in TRANSFORM_ORDER}
    root = scratch_path(spark, "job-test")

    def pnl(result):
        return sorted(tuple(r) for r in result.views["vw_department_pnl"].collect())

    first = JOB.job_full_refresh(spark, inputs, root, "2024-01-02")
    pnl1, star1 = pnl(first), first.star_path
    second = JOB.job_full_refresh(spark, inputs, root, "2024-01-02")
    assert second.star_path != star1 and L.current_star(spark, root) == second.star_path
    assert pnl(second) == pnl1
    assert second.catalog.count() == 16
    days = spark.read.option("header", True).csv(L.raw_path(root, "sales", "orders")).select("dt").distinct()
    assert [str(r.dt) for r in days.collect()] == ["2024-01-02"]


def test_violations_stop_the_load(spark, small_dir):
    """A violated constraint raises before the load, and the live version stays."""
    import pytest

    from lakeviews.operators.quality import ConstraintViolation
    from lakeviews.sources import lake as L

    raw = RawZone(StarBinding(spark, small_dir).materialize_joins())
    inputs = {n: raw.dataset(n) for n in TRANSFORM_ORDER}
    root = scratch_path(spark, "job-test")
    star = JOB.job_full_refresh(spark, inputs, root, "2024-01-02").star_path
    nowhere = inputs["sales.orders"].withColumn("region_code", F.lit("NOWHERE"))
    with pytest.raises(ConstraintViolation, match="fk"):
        JOB.job_full_refresh(spark, {**inputs, "sales.orders": nowhere}, root, "2024-01-03")
    assert L.current_star(spark, root) == star


def test_null_keys_and_long_texts_are_violations(spark):
    import pytest

    from lakeviews.operators import quality as QC
    from lakeviews.plans import star as S

    leads = spark.sql("SELECT CAST(NULL AS STRING) AS lead_id, repeat('x', 21) AS campaign_id, 'r' AS region_code, "
                      "DATE'2024-01-01' AS month_start, true AS converted")
    for kind in ("pk_null=1", "varchar=1"):
        with pytest.raises(QC.ConstraintViolation, match=kind):
            QC.enforce(S.violations({"fact_marketing_leads": leads}))


def test_not_null_and_duplicates_are_violations(spark):
    import datetime as dt

    import pytest

    from lakeviews.operators import quality as QC
    from lakeviews.plans import star as S

    day = dt.date(2024, 1, 1)
    dates = spark.createDataFrame([(day, 2024, 1, day, 1, None), (day, 2024, 1, day, 1, "January")],
                                  "date_key date, year int, month int, month_start date, quarter int, month_name string")
    with pytest.raises(QC.ConstraintViolation, match="not_null=1"):
        QC.enforce(S.violations({"dim_date": dates}))
    with pytest.raises(QC.ConstraintViolation, match="pk_duplicate=1"):
        QC.enforce(S.violations({"dim_date": dates}))
