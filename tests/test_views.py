"""View invariants on the sf0.001 input tables (bounds, identities, coverage)."""

import math

from pyspark.sql import functions as F

from lakeviews.plans import queries as Q
from lakeviews.plans import views as V
from lakeviews.plans.binding import StarBinding


def _views(spark, small_dir):
    return V.Views(StarBinding(spark, small_dir))


def test_view_row_counts(spark, small_dir):
    v = _views(spark, small_dir)
    assert v.by_region().count() == 1011
    assert v.marketing().count() == 393
    assert v.inventory().count() == 5027
    assert v.pnl().count() == 414


def test_margin_identity_and_positive_hr_cost(spark, small_dir):
    rows = V.to_output(_views(spark, small_dir).revenue_vs_hr()).collect()
    assert rows and all(r.hr_cost > 0 for r in rows)
    assert all(math.isclose(r.gross_margin, r.gl_revenue - r.cogs, abs_tol=1e-6) for r in rows)


def test_pnl_agrees_with_revenue_view(spark, small_dir):
    """Same HR cost; P&L revenue covers GL-only region-months that the left join drops, so it is >=."""
    v = _views(spark, small_dir)
    pnl = v.pnl().select("department", "month_start", "revenue", F.col("hr_cost").alias("pnl_hr"))
    rev = v.revenue_vs_hr().select("department", "month_start", "gl_revenue", "hr_cost")
    joined = rev.join(pnl, ["department", "month_start"])
    assert joined.count() > 0
    assert joined.where(F.col("pnl_hr") != F.col("hr_cost")).count() == 0
    assert joined.where(F.col("revenue") < F.col("gl_revenue")).count() == 0


def test_marketing_covers_all_regions(spark, small_dir):
    assert _views(spark, small_dir).marketing().select("region_code").distinct().count() == 5


def test_inventory_ratio_null_only_without_stock(spark, small_dir):
    inv = _views(spark, small_dir).inventory()
    assert inv.where(F.col("turnover_ratio").isNull() & (F.col("quantity_on_hand") > 0)).count() == 0
    assert inv.where(F.col("turnover_ratio").isNotNull()).count() > 0


def test_filtered_query_pushes_predicate(spark, small_dir):
    _views(spark, small_dir).register()
    df = Q.q_revenue_vs_hr_filtered(spark, "MACHINERY", "EUROPE")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MACHINERY" in plan
    assert df.where(F.col("department") != "MACHINERY").count() == 0


def test_empty_parameter_means_no_filter(spark, small_dir):
    _views(spark, small_dir).register()
    all_rows = Q.q_revenue_vs_hr_filtered(spark, None, None).count()
    assert Q.q_revenue_vs_hr_filtered(spark, "", "").count() == all_rows


def test_region_filter_reaches_parquet_scan(spark, small_dir):
    """A filter on a view's grouping key is pushed through the aggregate to the scans."""
    v = _views(spark, small_dir)
    df = Q.q_marketing_vs_sales_filtered(spark, "EUROPE", v)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Both sides of the full outer join (spend and sales) scan region with the predicate.
    assert plan.count("EqualTo(r_name,EUROPE)") >= 2
    assert df.where(F.col("region_code") != "EUROPE").count() == 0
    assert df.count() == v.marketing().where(F.col("region_code") == "EUROPE").count()


def test_department_filter_reaches_both_join_sides(spark, small_dir):
    _views(spark, small_dir).register()
    df = Q.q_revenue_vs_hr_filtered(spark, "MACHINERY", "EUROPE")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(c_mktsegment,MACHINERY)") >= 2


def test_scans_read_only_needed_columns(spark, small_dir):
    v = _views(spark, small_dir)
    plan = v.by_region()._jdf.queryExecution().executedPlan().toString()
    lineitem_schema = [line for line in plan.splitlines() if "l_orderkey" in line and "ReadSchema" in line]
    assert lineitem_schema and all("l_comment" not in s and "l_tax" not in s for s in lineitem_schema)


def test_materialized_joins_give_the_same_views(spark, small_dir):
    """Views over the written binding joins equal the in-plan ones and no longer join line items to orders."""
    shared = V.Views(StarBinding(spark, small_dir).materialize_joins())
    plain = _views(spark, small_dir)
    for name in ("by_region", "pnl", "inventory", "marketing"):
        a = V.to_output(getattr(shared, name)())
        b = V.to_output(getattr(plain, name)())
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()
    plan = V.to_output(shared.pnl())._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan
    assert "binding-joins" in plan


def test_no_side_is_broadcast_by_a_hint(spark, small_dir):
    for name in ("by_region", "pnl", "inventory", "marketing"):
        plan = getattr(_views(spark, small_dir), name)()._jdf.queryExecution().analyzed().toString().lower()
        assert "broadcast" not in plan


def test_totals_beyond_the_warehouse_type_only_fail_in_the_load(spark):
    """Sums above 10^12 pass the views; narrowing them to decimal(14,2) raises."""
    import datetime as dt

    import pytest

    from lakeviews.plans import star as S

    day, big = dt.date(2024, 1, 1), "9999999999999.99"
    hr = spark.sql(f"SELECT 'd' AS department, 'r' AS region_code, DATE'2024-01-01' AS month_start, 1 AS headcount, "
                   f"CAST({big} AS decimal(28,2)) AS salary_cost, CAST(0 AS decimal(28,2)) AS benefits_cost, CAST({big} AS decimal(28,2)) AS total_cost")
    gl = spark.sql("SELECT 'd' AS department, 'r' AS region_code, DATE'2024-01-01' AS month_start, '4000' AS account_code, "
                   "CAST(1 AS decimal(14,2)) AS amount")
    row = V.to_output(V.vw_revenue_vs_hr_cost(hr.union(hr), gl)).first()
    assert row.month_start == day and row.hr_cost == 2 * float(big)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        S.narrow_to_star(hr, "fact_hr_cost").collect()


def test_results_come_in_their_order(spark, small_dir):
    from lakeviews.plans.registry import QUERIES

    orders = {
        "q_hr_summary": lambda r: (-r.total_hr_cost, r.department), "q_marketing_summary": lambda r: (-r.total_spend, r.region_code),
        "q_inventory_summary": lambda r: (r.avg_turnover_ratio is None, -(r.avg_turnover_ratio or 0), r.sku),
        "q_pnl_summary": lambda r: (-r.total_revenue, r.department), "q_sales_monthly": lambda r: (r.month_start, r.region_code),
        "q_hr_monthly": lambda r: (r.month_start, r.department), "q_finance_monthly": lambda r: (r.month_start, r.department),
        "q_inventory_monthly": lambda r: (r.month_start, r.sku, r.region_code), "q_marketing_monthly": lambda r: (r.month_start, r.region_code),
        "q_story_series": lambda r: r.month_start,
    }
    for key, order in orders.items():
        rows = QUERIES[key](spark, small_dir).collect()
        assert len(rows) > 1 and rows == sorted(rows, key=order), key
