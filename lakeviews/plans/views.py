"""The five cross-domain views over the star schema.

Every view aggregates both join sides to the join grain first, so each join
is one-to-one and cannot fan out; Spark runs each aggregate as a partial
(map-side) aggregate, then a shuffle on the grouping keys, then the final
aggregate.  The outputs of the aggregates are small (one row per key of the
grain), so AQE turns the joins between them into broadcasts when measured
sizes allow it.  Money stays ``decimal`` (exact) until ``to_output``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakeviews.functions.numeric import ratio_thousandths, thousandths_to_double

REGION_GRAIN = ["department", "region_code", "month_start"]
DEPT_GRAIN = ["department", "month_start"]
MARKET_GRAIN = ["region_code", "month_start"]
SKU_GRAIN = ["sku", "region_code", "month_start"]


def to_output(df: DataFrame) -> DataFrame:
    """Cast exact decimal columns to DOUBLE for reports and comparisons."""
    cols = [F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


# --- aggregates used by the views (each is its own operator) ---
def agg_hr_cost(fact_hr_cost: DataFrame) -> DataFrame:
    return fact_hr_cost.groupBy(*REGION_GRAIN).agg(F.sum("total_cost").alias("hr_cost"))


def agg_gl_filtered(fact_finance_gl: DataFrame) -> DataFrame:
    acct, amount = F.col("account_code"), F.col("amount")
    return (fact_finance_gl.groupBy(*REGION_GRAIN)
            .agg(F.sum(F.when(acct == "4000", amount)).alias("gl_revenue"),
                 (-F.sum(F.when(acct == "5000", amount))).alias("cogs")))


def agg_spend(fact_marketing_spend: DataFrame) -> DataFrame:
    return fact_marketing_spend.groupBy(*MARKET_GRAIN).agg(F.sum("spend_amount").alias("spend"))


def filter_not_cancelled(fact_sales: DataFrame) -> DataFrame:
    # NULL status is dropped too, as with SQL ``status <> 'cancelled'``.
    return fact_sales.where(F.col("status") != "cancelled")


def agg_sales(fact_sales: DataFrame) -> DataFrame:
    return (filter_not_cancelled(fact_sales).groupBy(*MARKET_GRAIN)
            .agg(F.sum("order_total").alias("sales_revenue"),
                 F.count(F.lit(1)).alias("order_count")))


def filter_outbound(fact_inventory_movement: DataFrame) -> DataFrame:
    return fact_inventory_movement.where(F.col("movement_type") == "outbound")


def agg_outbound(fact_inventory_movement: DataFrame) -> DataFrame:
    return (filter_outbound(fact_inventory_movement).groupBy(*SKU_GRAIN)
            .agg(F.sum("quantity").alias("outbound_qty")))


def agg_hr_by_dept(fact_hr_cost: DataFrame) -> DataFrame:
    return fact_hr_cost.groupBy(*DEPT_GRAIN).agg(F.sum("total_cost").alias("total_cost"))


def agg_pnl(fact_finance_gl: DataFrame) -> DataFrame:
    """GL pre-aggregated to (department, month): revenue = 4000, opex = every other account.

    A NULL account code is in neither sum, as with SQL FILTER clauses.
    """
    acct, amount = F.col("account_code"), F.col("amount")
    return (fact_finance_gl.groupBy(*DEPT_GRAIN)
            .agg(F.coalesce(F.sum(F.when(acct == "4000", amount)), F.lit(0)).alias("revenue"),
                 F.coalesce(-F.sum(F.when(acct != "4000", amount)), F.lit(0)).alias("total_opex")))


# --- the five views ---
def vw_revenue_vs_hr_cost_by_region(fact_hr_cost: DataFrame, fact_finance_gl: DataFrame) -> DataFrame:
    return hr_and_gl(agg_hr_cost(fact_hr_cost), agg_gl_filtered(fact_finance_gl))


def hr_and_gl(hr: DataFrame, gl: DataFrame) -> DataFrame:
    """The by-region view of its two aggregates."""
    rev = F.coalesce(F.col("gl_revenue"), F.lit(0))
    cogs = F.coalesce(F.col("cogs"), F.lit(0))
    return (hr.join(gl, REGION_GRAIN, "left")
            .select(*REGION_GRAIN, "hr_cost", rev.alias("gl_revenue"), cogs.alias("cogs"),
                    (rev - cogs).alias("gross_margin")))


def agg_rollup_regions(by_region: DataFrame) -> DataFrame:
    return (by_region.groupBy(*DEPT_GRAIN)
            .agg(*[F.sum(c).alias(c) for c in ("hr_cost", "gl_revenue", "cogs", "gross_margin")]))


def vw_revenue_vs_hr_cost(fact_hr_cost: DataFrame, fact_finance_gl: DataFrame) -> DataFrame:
    return agg_rollup_regions(vw_revenue_vs_hr_cost_by_region(fact_hr_cost, fact_finance_gl))


def vw_marketing_spend_vs_sales(fact_marketing_spend: DataFrame, fact_sales: DataFrame,
                                region: str | None = None) -> DataFrame:
    """Spend and sales per region and month, full outer join, all measures defaulting to 0.

    A region filter is applied to *both* inputs: the output key is
    COALESCE(m.region, s.region), which Catalyst cannot push through a full
    outer join, but since the join is on region equality, filtering each side
    by region gives the same rows and lets the predicate reach both scans.
    """
    if region:
        fact_marketing_spend = fact_marketing_spend.where(F.col("region_code") == region)
        fact_sales = fact_sales.where(F.col("region_code") == region)
    return spend_and_sales(agg_spend(fact_marketing_spend), agg_sales(fact_sales))


def spend_and_sales(m: DataFrame, s: DataFrame) -> DataFrame:
    """The marketing view of its two aggregates."""
    # Joining on column names makes the full-outer keys COALESCE(m.key, s.key).
    return (m.join(s, MARKET_GRAIN, "full_outer")
            .select(*MARKET_GRAIN,
                    F.coalesce(F.col("spend"), F.lit(0)).alias("marketing_spend"),
                    F.coalesce(F.col("sales_revenue"), F.lit(0)).alias("sales_revenue"),
                    F.coalesce(F.col("order_count"), F.lit(0)).cast("long").alias("order_count")))


def vw_inventory_turns_vs_sales(fact_inventory_stock: DataFrame,
                                fact_inventory_movement: DataFrame) -> DataFrame:
    return stock_and_outbound(fact_inventory_stock, agg_outbound(fact_inventory_movement))


def stock_and_outbound(fact_inventory_stock: DataFrame, out: DataFrame) -> DataFrame:
    """The inventory view of stock levels and the outbound aggregate."""
    qty = F.coalesce(F.col("outbound_qty"), F.lit(0)).cast("long")
    return (fact_inventory_stock.join(out, SKU_GRAIN, "left")
            .select(*SKU_GRAIN, "quantity_on_hand", qty.alias("outbound_qty"),
                    thousandths_to_double(ratio_thousandths(qty, F.col("quantity_on_hand")))
                    .alias("turnover_ratio")))


def vw_department_pnl(fact_finance_gl: DataFrame, fact_finance_budget: DataFrame,
                      fact_hr_cost: DataFrame) -> DataFrame:
    """GL aggregated to (department, month) first, then the two lookups joined.

    Budget and HR cost are unique per (department, month), so grouping after
    the joins (as a single SQL statement would) gives the same rows; grouping
    first shuffles one row per key instead of every GL posting.
    """
    gl = agg_pnl(fact_finance_gl)
    budget = fact_finance_budget.select(*DEPT_GRAIN, "budget_amount")
    hr = agg_hr_by_dept(fact_hr_cost).withColumnRenamed("total_cost", "hr_cost")
    return (gl.join(budget, DEPT_GRAIN, "left").join(hr, DEPT_GRAIN, "left")
            .select(*DEPT_GRAIN, "revenue", "total_opex", "budget_amount", "hr_cost"))


class Views:
    """The five views over one star binding (facts are built once and shared)."""

    def __init__(self, star):
        self.star = star

    def by_region(self) -> DataFrame:
        return vw_revenue_vs_hr_cost_by_region(self.star.fact_hr_cost, self.star.fact_finance_gl)

    def revenue_vs_hr(self) -> DataFrame:
        return agg_rollup_regions(self.by_region())

    def marketing(self, region: str | None = None) -> DataFrame:
        return vw_marketing_spend_vs_sales(self.star.fact_marketing_spend, self.star.fact_sales, region)

    def inventory(self) -> DataFrame:
        return vw_inventory_turns_vs_sales(self.star.fact_inventory_stock,
                                           self.star.fact_inventory_movement)

    def pnl(self) -> DataFrame:
        return vw_department_pnl(self.star.fact_finance_gl, self.star.fact_finance_budget,
                                 self.star.fact_hr_cost)

    def register(self) -> None:
        """Register the views as temp views under their warehouse names."""
        self.by_region().createOrReplaceTempView("vw_revenue_vs_hr_cost_by_region")
        self.revenue_vs_hr().createOrReplaceTempView("vw_revenue_vs_hr_cost")
        self.marketing().createOrReplaceTempView("vw_marketing_spend_vs_sales")
        self.inventory().createOrReplaceTempView("vw_inventory_turns_vs_sales")
        self.pnl().createOrReplaceTempView("vw_department_pnl")
