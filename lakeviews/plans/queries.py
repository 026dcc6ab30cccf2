"""Named queries over the views: filtered API reads, summaries, dashboard series.

Filtered reads go through ``spark.sql`` with named parameter markers over
the registered temp views (``scan_view_sql``); Catalyst pushes the
predicates through the view's aggregates down to the scans.  The summaries
group a view by one key; the derived ratio columns follow the report rules
(0 when the divisor is 0, NULL variance when the budget is missing).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.functions.numeric import avg_thousandths_round3, safe_mean
from lakeviews.plans.views import filter_not_cancelled


def scan_view_sql(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """Run a SELECT over registered views with named ``:param`` markers."""
    return spark.sql(sql, args=params or {})


def filter_optional_params(base_sql: str, filters: list[tuple[str, str, str | None]],
                           order_by: str | None = None) -> tuple[str, dict]:
    """Append ``col = :param`` for every filter whose value is given and non-empty."""
    clauses, params = [], {}
    for column, name, value in filters:
        if value:  # None and "" both mean "no filter"
            clauses.append(f"{column} = :{name}")
            params[name] = value
    sql = base_sql + (" WHERE " + " AND ".join(clauses) if clauses else "")
    if order_by:
        sql += f" ORDER BY {order_by}"
    return sql, params


def q_revenue_vs_hr_filtered(spark, department: str | None = None, region: str | None = None):
    if region:
        base = ("SELECT department, region_code, month_start, hr_cost, gl_revenue, cogs, gross_margin "
                "FROM vw_revenue_vs_hr_cost_by_region")
        sql, params = filter_optional_params(
            base, [("region_code", "region", region), ("department", "dept", department)], "month_start")
    else:
        base = ("SELECT department, month_start, hr_cost, gl_revenue, cogs, gross_margin "
                "FROM vw_revenue_vs_hr_cost")
        sql, params = filter_optional_params(base, [("department", "dept", department)], "month_start")
    return scan_view_sql(spark, sql, params)


def q_marketing_vs_sales_filtered(spark, region: str | None = None, views=None):
    """Optional region filter.  With ``views`` the filter goes into both sides of
    the full outer join (see ``vw_marketing_spend_vs_sales``); otherwise it is a
    parameterised read of the registered view."""
    if views is not None:
        return (views.marketing(region or None)
                .select("region_code", "month_start", "marketing_spend", "sales_revenue", "order_count")
                .orderBy("month_start"))
    base = ("SELECT region_code, month_start, marketing_spend, sales_revenue, order_count "
            "FROM vw_marketing_spend_vs_sales")
    sql, params = filter_optional_params(base, [("region_code", "region", region)], "month_start")
    return scan_view_sql(spark, sql, params)


def q_inventory_turns_filtered(spark, sku=None, region: str | None = None):
    base = ("SELECT sku, region_code, month_start, quantity_on_hand, outbound_qty, turnover_ratio "
            "FROM vw_inventory_turns_vs_sales")
    sql, params = filter_optional_params(
        base, [("sku", "sku", sku), ("region_code", "region", region)], "month_start")
    return scan_view_sql(spark, sql, params)


def q_department_pnl_filtered(spark, department: str | None = None):
    base = ("SELECT department, month_start, revenue, total_opex, budget_amount, hr_cost "
            "FROM vw_department_pnl")
    sql, params = filter_optional_params(base, [("department", "dept", department)], "month_start")
    return scan_view_sql(spark, sql, params)


# --- summaries (the report queries) ---
def q_hr_summary(revenue_vs_hr: DataFrame) -> DataFrame:
    s = (revenue_vs_hr.groupBy("department")
         .agg(F.round(F.sum("hr_cost"), 2).cast("double").alias("total_hr_cost"),
              F.round(F.sum("gl_revenue"), 2).cast("double").alias("total_revenue"),
              F.round(F.sum("gross_margin"), 2).cast("double").alias("total_gross_margin")))
    rev = F.col("total_revenue")
    pct = F.when(rev.isNotNull() & (rev != 0), F.col("total_hr_cost") / rev * 100).otherwise(F.lit(0.0))
    return s.withColumn("hr_cost_pct_of_revenue", pct).orderBy(F.col("total_hr_cost").desc(), "department")


def q_marketing_summary(marketing: DataFrame) -> DataFrame:
    s = (marketing.groupBy("region_code")
         .agg(F.round(F.sum("marketing_spend"), 2).cast("double").alias("total_spend"),
              F.round(F.sum("sales_revenue"), 2).cast("double").alias("total_revenue")))
    spend = F.col("total_spend")
    ratio = F.when(spend.isNotNull() & (spend != 0), F.col("total_revenue") / spend).otherwise(F.lit(0.0))
    return s.withColumn("revenue_to_spend", ratio).orderBy(F.col("total_spend").desc(), "region_code")


def q_inventory_summary(inventory: DataFrame) -> DataFrame:
    """avg_turnover_ratio = ROUND(AVG(turnover_ratio), 3), computed on integer thousandths."""
    t = F.round(F.col("turnover_ratio") * 1000).cast("long")
    return (inventory.groupBy("sku")
            .agg(avg_thousandths_round3(t).alias("avg_turnover_ratio"),
                 F.sum("outbound_qty").cast("long").alias("total_outbound_qty"))
            .orderBy(F.col("avg_turnover_ratio").desc_nulls_last(), "sku"))


def q_pnl_summary(pnl: DataFrame) -> DataFrame:
    s = (pnl.groupBy("department")
         .agg(F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue"),
              F.round(F.sum("total_opex"), 2).cast("double").alias("total_opex"),
              F.round(F.sum("budget_amount"), 2).cast("double").alias("total_budget"),
              F.round(F.sum("hr_cost"), 2).cast("double").alias("total_hr_cost")))
    # Subtraction propagates NULL: no budget -> no variance.
    return (s.withColumn("opex_budget_variance", F.col("total_opex") - F.col("total_budget"))
            .orderBy(F.col("total_revenue").desc(), "department"))


# --- dashboard series ---
def q_sales_monthly(fact_sales: DataFrame) -> DataFrame:
    return (filter_not_cancelled(fact_sales).groupBy("region_code", "month_start")
            .agg(F.sum("order_total").cast("double").alias("revenue"),
                 F.count(F.lit(1)).alias("orders"))
            .orderBy("month_start", "region_code"))


def agg_headcount(fact_hr_cost: DataFrame) -> DataFrame:
    return (fact_hr_cost.groupBy("department", "month_start")
            .agg(F.sum("headcount").cast("long").alias("headcount"),
                 F.sum("total_cost").alias("total_cost")))


def q_hr_monthly(fact_hr_cost: DataFrame) -> DataFrame:
    return (agg_headcount(fact_hr_cost).withColumn("total_cost", F.col("total_cost").cast("double"))
            .orderBy("month_start", "department"))


def q_finance_monthly(pnl: DataFrame) -> DataFrame:
    return pnl.select("department", "month_start", "revenue", "total_opex", "budget_amount").orderBy("month_start", "department")


def q_inventory_monthly(inventory: DataFrame) -> DataFrame:
    return inventory.select("sku", "region_code", "month_start", "quantity_on_hand", "turnover_ratio").orderBy("month_start", "sku", "region_code")


def q_marketing_monthly(marketing: DataFrame) -> DataFrame:
    return marketing.select("region_code", "month_start", "marketing_spend", "sales_revenue").orderBy("month_start", "region_code")


def q_story_series(by_region: DataFrame, department: str, region: str) -> DataFrame:
    return (by_region.where((F.col("department") == department) & (F.col("region_code") == region))
            .select("month_start", "hr_cost", "gross_margin").orderBy("month_start"))


def filter_date_range(df: DataFrame, start: dt.date, end: dt.date, column: str = "month_start") -> DataFrame:
    """Half-open range [start, end) on a DATE column."""
    c = F.col(column)
    return df.where((c >= F.lit(start)) & (c < F.lit(end)))


def _in_range(start: dt.date, end: dt.date, column: str = "month_start"):
    c = F.col(column)
    return (c >= F.lit(start)) & (c < F.lit(end))


def agg_window_mean(value: str, start: dt.date, end: dt.date):
    """Mean of ``value`` over rows whose month_start is in [start, end)."""
    return safe_mean(F.when(_in_range(start, end), F.col(value)))


def q_cost_leads_margin(by_region: DataFrame, early: tuple, late: tuple,
                        margin_before: tuple, margin_after: tuple, factor: float = 1.5) -> DataFrame:
    """Per department and region: did mean HR cost jump by ``factor`` while mean margin fell?

    One grouped pass computes all four windowed means (partial aggregation,
    one shuffle on (department, region_code)).
    """
    s = (by_region.groupBy("department", "region_code")
         .agg(agg_window_mean("hr_cost", *early).alias("early_hr_cost"),
              agg_window_mean("hr_cost", *late).alias("late_hr_cost"),
              agg_window_mean("gross_margin", *margin_before).alias("margin_before"),
              agg_window_mean("gross_margin", *margin_after).alias("margin_after")))
    cost_jump = F.col("late_hr_cost") > F.col("early_hr_cost") * F.lit(factor)
    margin_fell = F.col("margin_after") < F.col("margin_before")
    return (s.withColumn("cost_jump", F.coalesce(cost_jump, F.lit(False)))
            .withColumn("margin_fell", F.coalesce(margin_fell, F.lit(False)))
            .withColumn("cost_leads_margin", F.col("cost_jump") & F.col("margin_fell")))


def q_margin_by_department(pnl: DataFrame) -> DataFrame:
    """Mean (revenue - total_opex) per department plus a grand-total row (department NULL).

    ``rollup`` yields both levels from one partial aggregation.
    """
    margin = F.col("revenue") - F.col("total_opex")
    return (pnl.rollup("department")
            .agg(safe_mean(margin).alias("avg_margin"),
                 F.sum("revenue").cast("double").alias("total_revenue"),
                 F.sum("total_opex").cast("double").alias("total_opex")))
