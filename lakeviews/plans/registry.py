"""Keyed query callables ``(spark, sf_dir) -> DataFrame`` over the input tables.

Keys are the operator IDs of the blueprint.  Each callable builds the star
binding of ``sf_dir`` and runs one operator (or the view / query that
exercises it) over the whole tables.  Parameters of the parameterised
queries are fixed here so every key is reproducible.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.plans import queries as Q
from lakeviews.plans import views as V
from lakeviews.plans.binding import StarBinding
from lakeviews.session import tune_session
from lakeviews.sources.lake import folders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the parameterised queries.
STORY_DEPARTMENT = "AUTOMOBILE"
STORY_REGION = "AMERICA"
FILTER_DEPARTMENT = "MACHINERY"
FILTER_REGION = "EUROPE"
FILTER_SKU = 7
EARLY = (dt.date(1995, 1, 1), dt.date(1995, 4, 1))
LATE = (dt.date(1995, 9, 1), dt.date(1995, 12, 1))
MARGIN_BEFORE = (dt.date(1995, 1, 1), dt.date(1995, 4, 1))
MARGIN_AFTER = (dt.date(1995, 10, 1), dt.date(1996, 1, 1))


def register(key: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune_session(spark)
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return fn
    return deco


# The star of each session and folder, with the version of its input files: its
# frames are built (table handles, schemas, plans) once, and hold no rows.
_STARS: dict[tuple, tuple[tuple, StarBinding]] = {}


def star(spark, sf_dir) -> StarBinding:
    """The star over the input tables; its joins are written once and read by every query."""
    fresh = StarBinding(spark, sf_dir)
    key, version = (spark.sparkContext.applicationId, id(spark), fresh.t.sf_dir), fresh.version()
    held = _STARS.get(key)
    if held is None or held[0] != version or folders(spark, held[1].joins) is None:
        _STARS[key] = held = (version, fresh.materialize_joins())
    return held[1]


def _views(spark, sf_dir) -> V.Views:
    return V.Views(star(spark, sf_dir))


# ---------------- views (§2.9) and the joins / aggregates they are made of ----------------
@register("vw_revenue_vs_hr_cost_by_region")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).by_region())


@register("vw_revenue_vs_hr_cost")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).revenue_vs_hr())


@register("vw_marketing_spend_vs_sales")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).marketing())


@register("vw_inventory_turns_vs_sales")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).inventory())


@register("vw_department_pnl")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).pnl())


@register("join_left_hr_gl")
def _(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.to_output(V.agg_hr_cost(s.fact_hr_cost)
                       .join(V.agg_gl_filtered(s.fact_finance_gl), V.REGION_GRAIN, "left"))


@register("join_full_spend_sales")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).marketing())


@register("join_left_stock_outbound")
def _(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.to_output(s.fact_inventory_stock.select(*V.SKU_GRAIN, "quantity_on_hand")
                       .join(V.agg_outbound(s.fact_inventory_movement), V.SKU_GRAIN, "left"))


@register("join_left_gl_budget")
def _(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.to_output(V.agg_pnl(s.fact_finance_gl)
                       .join(s.fact_finance_budget, V.DEPT_GRAIN, "left"))


@register("join_left_gl_hr")
def _(spark, sf_dir):
    s = star(spark, sf_dir)
    return V.to_output(V.agg_pnl(s.fact_finance_gl)
                       .join(V.agg_hr_by_dept(s.fact_hr_cost), V.DEPT_GRAIN, "left"))


@register("agg_hr_cost")
def _(spark, sf_dir):
    return V.to_output(V.agg_hr_cost(star(spark, sf_dir).fact_hr_cost))


@register("agg_gl_filtered")
def _(spark, sf_dir):
    return V.to_output(V.agg_gl_filtered(star(spark, sf_dir).fact_finance_gl))


@register("agg_rollup_regions")
def _(spark, sf_dir):
    return V.to_output(_views(spark, sf_dir).revenue_vs_hr())


@register("agg_spend")
def _(spark, sf_dir):
    return V.to_output(V.agg_spend(star(spark, sf_dir).fact_marketing_spend))


@register("agg_sales")
def _(spark, sf_dir):
    return V.to_output(V.agg_sales(star(spark, sf_dir).fact_sales))


@register("agg_outbound")
def _(spark, sf_dir):
    return V.to_output(V.agg_outbound(star(spark, sf_dir).fact_inventory_movement))


@register("agg_hr_by_dept")
def _(spark, sf_dir):
    return V.to_output(V.agg_hr_by_dept(star(spark, sf_dir).fact_hr_cost))


@register("agg_pnl")
def _(spark, sf_dir):
    return V.to_output(V.agg_pnl(star(spark, sf_dir).fact_finance_gl))


@register("agg_headcount")
def _(spark, sf_dir):
    return Q.q_hr_monthly(star(spark, sf_dir).fact_hr_cost)


@register("filter_not_cancelled")
def _(spark, sf_dir):
    fs = star(spark, sf_dir).fact_sales
    return V.to_output(V.filter_not_cancelled(fs))


@register("filter_outbound")
def _(spark, sf_dir):
    return V.filter_outbound(star(spark, sf_dir).fact_inventory_movement)


@register("filter_not_null")
def _(spark, sf_dir):
    inv = _views(spark, sf_dir).inventory()
    return inv.where(F.col("turnover_ratio").isNotNull()).select("sku", "region_code", "month_start",
                                                                 "turnover_ratio")


@register("filter_date_range")
def _(spark, sf_dir):
    by_region = _views(spark, sf_dir).by_region()
    return V.to_output(Q.filter_date_range(by_region, *EARLY))


# ---------------- named queries (§2.10) ----------------
def _registered(spark, sf_dir) -> V.Views:
    v = _views(spark, sf_dir)
    v.register()
    return v


@register("q_revenue_vs_hr_filtered")
def _(spark, sf_dir):
    _registered(spark, sf_dir)
    return V.to_output(Q.q_revenue_vs_hr_filtered(spark, FILTER_DEPARTMENT, FILTER_REGION))


@register("filter_optional_params")
def _(spark, sf_dir):
    _registered(spark, sf_dir)
    # department given, region empty -> department view, one filter.
    return V.to_output(Q.q_revenue_vs_hr_filtered(spark, FILTER_DEPARTMENT, ""))


@register("scan_view_sql")
def _(spark, sf_dir):
    _registered(spark, sf_dir)
    return V.to_output(Q.scan_view_sql(
        spark, "SELECT * FROM vw_revenue_vs_hr_cost_by_region WHERE region_code = :region",
        {"region": FILTER_REGION}))


@register("q_marketing_vs_sales_filtered")
def _(spark, sf_dir):
    return V.to_output(Q.q_marketing_vs_sales_filtered(spark, FILTER_REGION, _views(spark, sf_dir)))


@register("q_inventory_turns_filtered")
def _(spark, sf_dir):
    _registered(spark, sf_dir)
    return V.to_output(Q.q_inventory_turns_filtered(spark, FILTER_SKU, FILTER_REGION))


@register("q_department_pnl_filtered")
def _(spark, sf_dir):
    _registered(spark, sf_dir)
    return V.to_output(Q.q_department_pnl_filtered(spark, FILTER_DEPARTMENT))


@register("q_hr_summary")
def _(spark, sf_dir):
    return Q.q_hr_summary(_views(spark, sf_dir).revenue_vs_hr())


@register("q_marketing_summary")
def _(spark, sf_dir):
    return Q.q_marketing_summary(_views(spark, sf_dir).marketing())


@register("q_inventory_summary")
def _(spark, sf_dir):
    return Q.q_inventory_summary(_views(spark, sf_dir).inventory())


@register("agg_avg_ignoring_null")
def _(spark, sf_dir):
    return Q.q_inventory_summary(_views(spark, sf_dir).inventory()).select("sku", "avg_turnover_ratio")


@register("q_pnl_summary")
def _(spark, sf_dir):
    return Q.q_pnl_summary(_views(spark, sf_dir).pnl())


@register("fn_variance_or_null")
def _(spark, sf_dir):
    return Q.q_pnl_summary(_views(spark, sf_dir).pnl()).select("department", "opex_budget_variance")


@register("q_sales_monthly")
def _(spark, sf_dir):
    return Q.q_sales_monthly(star(spark, sf_dir).fact_sales)


@register("q_hr_monthly")
def _(spark, sf_dir):
    return Q.q_hr_monthly(star(spark, sf_dir).fact_hr_cost)


@register("q_finance_monthly")
def _(spark, sf_dir):
    return V.to_output(Q.q_finance_monthly(_views(spark, sf_dir).pnl()))


@register("q_inventory_monthly")
def _(spark, sf_dir):
    return Q.q_inventory_monthly(_views(spark, sf_dir).inventory())


@register("q_marketing_monthly")
def _(spark, sf_dir):
    return V.to_output(Q.q_marketing_monthly(_views(spark, sf_dir).marketing()))


@register("q_story_series")
def _(spark, sf_dir):
    return V.to_output(Q.q_story_series(_views(spark, sf_dir).by_region(), STORY_DEPARTMENT, STORY_REGION))


@register("q_cost_leads_margin")
def _(spark, sf_dir):
    return Q.q_cost_leads_margin(_views(spark, sf_dir).by_region(), EARLY, LATE, MARGIN_BEFORE, MARGIN_AFTER)


@register("agg_window_mean")
def _(spark, sf_dir):
    by_region = _views(spark, sf_dir).by_region()
    return (by_region.groupBy("department", "region_code")
            .agg(Q.agg_window_mean("hr_cost", *EARLY).alias("mean_hr_cost")))


@register("q_margin_by_department")
def _(spark, sf_dir):
    return Q.q_margin_by_department(_views(spark, sf_dir).pnl())


@register("agg_group_mean")
def _(spark, sf_dir):
    pnl = _views(spark, sf_dir).pnl()
    from lakeviews.functions.numeric import safe_mean
    return pnl.groupBy("department").agg(
        safe_mean(F.col("revenue") - F.col("total_opex")).alias("avg_margin"))


@register("agg_grand_total")
def _(spark, sf_dir):
    pnl = _views(spark, sf_dir).pnl()
    return pnl.agg(F.sum("total_opex").cast("double").alias("total_opex"),
                   F.sum("revenue").cast("double").alias("total_revenue"),
                   (F.sum("total_opex") < F.sum("revenue") * 3).alias("opex_below_3x_revenue"))


@register("agg_bounds")
def _(spark, sf_dir):
    v = _views(spark, sf_dir).revenue_vs_hr()
    return v.agg(F.max("hr_cost").cast("double").alias("max_hr_cost"),
                 F.bool_and(F.col("hr_cost") > 0).alias("all_hr_cost_positive"),
                 F.count(F.lit(1)).alias("n_rows"))


@register("agg_distinct")
def _(spark, sf_dir):
    return _views(spark, sf_dir).marketing().select("region_code").distinct()


# Further keys register themselves on import.
from lakeviews.plans import registry_io, registry_quality, registry_text  # noqa: E402,F401
