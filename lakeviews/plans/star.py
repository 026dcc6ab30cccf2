"""Star schema from curated datasets: projections, dimensions, type narrowing.

Facts are column projections of curated datasets (``month`` renamed to
``month_start``; sales derive it from the order date).  Types are narrowed
to the warehouse layout: money to ``decimal(14,2)`` / ``decimal(10,2)``
(HALF_UP; overflow raises under ANSI), ints to INT.  ``dim_date`` holds
every date that occurs in the eight dated sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.contracts import DEPARTMENTS, STAR_TABLES
from lakeviews.operators import quality as QC


def fn_month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def narrow_to_star(df: DataFrame, table: str) -> DataFrame:
    """Select the star table's columns in order, cast to its declared types."""
    spec = STAR_TABLES[table]
    return df.select(*[F.col(name).cast(sql_type).alias(name) for name, sql_type, _ in spec.columns])


def _renamed(df: DataFrame, table: str) -> DataFrame:
    return narrow_to_star(df.withColumnRenamed("month", "month_start"), table)


def project_fact_sales(orders: DataFrame) -> DataFrame:
    return narrow_to_star(orders.withColumn("month_start", fn_month_start(F.col("order_date"))), "fact_sales")


def project_fact_hr_cost(headcount_costs: DataFrame) -> DataFrame:
    return _renamed(headcount_costs, "fact_hr_cost")


def project_fact_finance_gl(gl_transactions: DataFrame) -> DataFrame:
    return _renamed(gl_transactions, "fact_finance_gl")


def project_fact_finance_budget(budgets: DataFrame) -> DataFrame:
    return _renamed(budgets, "fact_finance_budget")


def project_fact_inventory_stock(stock_levels: DataFrame) -> DataFrame:
    return _renamed(stock_levels, "fact_inventory_stock")


def project_fact_inventory_movement(movements: DataFrame) -> DataFrame:
    return _renamed(movements, "fact_inventory_movement")


def project_fact_marketing_spend(spend: DataFrame) -> DataFrame:
    # Spend rows already carry channel and region; no campaign join is made.
    return _renamed(spend, "fact_marketing_spend")


def project_fact_marketing_leads(leads: DataFrame) -> DataFrame:
    return _renamed(leads, "fact_marketing_leads")


def dim_region(regions: DataFrame) -> DataFrame:
    return narrow_to_star(regions, "dim_region")


def dim_department_fixed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in DEPARTMENTS], "department string")


def dim_department_from(df: DataFrame, column: str = "department") -> DataFrame:
    return df.select(F.col(column).alias("department")).where(F.col("department").isNotNull()).distinct()


def union_distinct_dates(dated: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-null dates over (DataFrame, date column) pairs; partial distinct per input."""
    parts = [df.select(F.col(c).cast("date").alias("date_key")) for df, c in dated]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where(F.col("date_key").isNotNull()).distinct()


def fn_date_parts(d: Column) -> list[Column]:
    return [F.year(d).alias("year"), F.month(d).alias("month"),
            fn_month_start(d).alias("month_start"), F.quarter(d).alias("quarter"),
            F.date_format(d, "MMMM").alias("month_name")]


def dim_date(dated: list[tuple[DataFrame, str]]) -> DataFrame:
    dates = union_distinct_dates(dated)
    return narrow_to_star(dates.select("date_key", *fn_date_parts(F.col("date_key"))), "dim_date")


STAR_SOURCES = {
    # star table -> (curated dataset, projection)
    "fact_sales": ("sales.orders", project_fact_sales),
    "fact_hr_cost": ("hr.headcount_costs", project_fact_hr_cost),
    "fact_finance_gl": ("finance.gl_transactions", project_fact_finance_gl),
    "fact_finance_budget": ("finance.budgets_by_department", project_fact_finance_budget),
    "fact_inventory_stock": ("inventory.stock_levels", project_fact_inventory_stock),
    "fact_inventory_movement": ("inventory.warehouse_movements", project_fact_inventory_movement),
    "fact_marketing_spend": ("marketing.spend_by_channel", project_fact_marketing_spend),
    "fact_marketing_leads": ("marketing.leads_by_campaign", project_fact_marketing_leads),
}

DATE_SOURCES = [
    ("sales.orders", "order_date"), ("hr.headcount_costs", "month"),
    ("finance.gl_transactions", "month"), ("finance.budgets_by_department", "month"),
    ("inventory.stock_levels", "month"), ("inventory.warehouse_movements", "month"),
    ("marketing.spend_by_channel", "month"), ("marketing.leads_by_campaign", "month"),
]


def build_star(spark: SparkSession, curated: dict[str, DataFrame],
               departments: DataFrame | None = None) -> dict[str, DataFrame]:
    """All eleven star tables from curated datasets (missing sources are skipped)."""
    star: dict[str, DataFrame] = {}
    dated = [(curated[n], c) for n, c in DATE_SOURCES if n in curated]
    if dated:
        star["dim_date"] = dim_date(dated)
    star["dim_department"] = departments if departments is not None else dim_department_fixed(spark)
    if "sales.regions" in curated:
        star["dim_region"] = dim_region(curated["sales.regions"])
    for table, (source, project) in STAR_SOURCES.items():
        if source in curated:
            star[table] = project(curated[source])
    return star


# --- constraints of the star: one metrics row per constraint ---
def stacked_rows(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """All rows of all parts under the columns of all, null where a part lacks one; ``label`` holds the part's name."""
    out = None
    for name, df in parts.items():
        named = df.select(F.lit(name).alias(label), *[F.col(c) for c in df.columns])
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def stacked(parts: list[DataFrame]) -> DataFrame:
    """Union of the parts; an empty metrics table if there are none."""
    if not parts:
        return SparkSession.active().createDataFrame([], QC.METRIC_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def violations(star: dict[str, DataFrame], checks: tuple[str, ...] = ("pk", "fk", "not_null", "varchar"), unique: bool = False) -> DataFrame:
    return QC.constraint_metrics(star, STAR_TABLES, checks, unique)
