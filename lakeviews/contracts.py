"""Dataset contracts (raw zone) and the star-schema layout, held as data.

A contract names the declared logical type of each column, the primary key,
the columns that must not be null and the foreign keys to parent datasets.
The contract drives coercion (functions.coerce), de-duplication
(operators.dedupe) and the quality checks (operators.quality).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    domain: str
    name: str
    columns: dict  # column -> logical type: string | date | int | float | bool
    primary_key: tuple
    not_null: tuple = ()
    fk_checks: tuple = ()  # (column, parent "domain.name", parent column)

    @property
    def full_name(self) -> str:
        return f"{self.domain}.{self.name}"

    def raw_schema(self) -> T.StructType:
        """All-string schema used to scan the raw CSV; types come from coercion."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


def _c(domain, name, columns, pk, not_null=(), fks=()):
    return Contract(domain, name, dict(columns), tuple(pk), tuple(not_null), tuple(fks))


# --- Fixed values: the sixteen raw dataset contracts (names, types, keys) ---
CONTRACTS = {
    c.full_name: c
    for c in [
        _c("sales", "regions",
           [("region_code", "string"), ("country_group", "string"), ("sub_region", "string")],
           ["region_code"], ["region_code"]),
        _c("sales", "customers",
           [("customer_id", "string"), ("region_code", "string"), ("segment", "string"),
            ("signup_date", "date")],
           ["customer_id"], ["customer_id", "region_code"],
           [("region_code", "sales.regions", "region_code")]),
        _c("sales", "orders",
           [("order_id", "string"), ("customer_id", "string"), ("region_code", "string"),
            ("order_date", "date"), ("order_total", "float"), ("order_cost", "float"),
            ("status", "string")],
           ["order_id"], ["order_id", "customer_id", "order_date"],
           [("customer_id", "sales.customers", "customer_id")]),
        _c("sales", "order_lines",
           [("order_line_id", "string"), ("order_id", "string"), ("sku", "string"),
            ("product_name", "string"), ("quantity", "int"), ("unit_price", "float"),
            ("unit_cost", "float"), ("discount_rate", "float"), ("line_net_amount", "float")],
           ["order_line_id"], ["order_line_id", "order_id", "sku"],
           [("order_id", "sales.orders", "order_id")]),
        _c("hr", "employees",
           [("employee_id", "string"), ("department", "string"), ("region_code", "string"),
            ("hire_date", "date"), ("job_level", "string")],
           ["employee_id"], ["employee_id", "department", "region_code"]),
        _c("hr", "headcount_costs",
           [("department", "string"), ("region_code", "string"), ("month", "date"),
            ("headcount", "int"), ("salary_cost", "float"), ("benefits_cost", "float"),
            ("total_cost", "float")],
           ["department", "region_code", "month"], ["department", "region_code", "month"]),
        _c("hr", "attrition_events",
           [("event_id", "string"), ("employee_id", "string"), ("department", "string"),
            ("region_code", "string"), ("termination_date", "date"), ("reason", "string")],
           ["event_id"], ["event_id", "employee_id"],
           [("employee_id", "hr.employees", "employee_id")]),
        _c("finance", "budgets_by_department",
           [("department", "string"), ("month", "date"), ("budget_amount", "float")],
           ["department", "month"], ["department", "month"]),
        _c("finance", "revenue_by_month",
           [("region_code", "string"), ("month", "date"), ("revenue", "float")],
           ["region_code", "month"], ["region_code", "month"]),
        _c("finance", "gl_transactions",
           [("txn_id", "string"), ("department", "string"), ("region_code", "string"),
            ("month", "date"), ("account_code", "string"), ("account_name", "string"),
            ("amount", "float")],
           ["txn_id"], ["txn_id", "department", "month", "account_code"]),
        _c("inventory", "sku_master",
           [("sku", "string"), ("product_name", "string"), ("category", "string"),
            ("unit_cost", "float"), ("reorder_point", "int")],
           ["sku"], ["sku"]),
        _c("inventory", "stock_levels",
           [("sku", "string"), ("region_code", "string"), ("month", "date"),
            ("quantity_on_hand", "int"), ("unit_cost", "float")],
           ["sku", "region_code", "month"], ["sku", "region_code", "month"],
           [("sku", "inventory.sku_master", "sku")]),
        _c("inventory", "warehouse_movements",
           [("movement_id", "string"), ("sku", "string"), ("region_code", "string"),
            ("month", "date"), ("movement_type", "string"), ("quantity", "int")],
           ["movement_id"], ["movement_id", "sku"],
           [("sku", "inventory.sku_master", "sku")]),
        _c("marketing", "campaigns",
           [("campaign_id", "string"), ("name", "string"), ("channel", "string"),
            ("region_code", "string"), ("start_date", "date"), ("end_date", "date")],
           ["campaign_id"], ["campaign_id", "channel"]),
        _c("marketing", "spend_by_channel",
           [("campaign_id", "string"), ("channel", "string"), ("region_code", "string"),
            ("month", "date"), ("spend_amount", "float")],
           ["campaign_id"], ["campaign_id", "channel", "month"],
           [("campaign_id", "marketing.campaigns", "campaign_id")]),
        _c("marketing", "leads_by_campaign",
           [("lead_id", "string"), ("campaign_id", "string"), ("region_code", "string"),
            ("month", "date"), ("converted", "bool")],
           ["lead_id"], ["lead_id", "campaign_id"],
           [("campaign_id", "marketing.campaigns", "campaign_id")]),
    ]
}

# --- Fixed values: processing order, parents before children ---
TRANSFORM_ORDER = [
    "sales.regions", "sales.customers", "sales.orders", "sales.order_lines",
    "hr.employees", "hr.headcount_costs", "hr.attrition_events",
    "finance.budgets_by_department", "finance.revenue_by_month", "finance.gl_transactions",
    "inventory.sku_master", "inventory.stock_levels", "inventory.warehouse_movements",
    "marketing.campaigns", "marketing.spend_by_channel", "marketing.leads_by_campaign",
]

# --- Fixed values: the five business domains ---
DOMAINS = ["sales", "hr", "finance", "inventory", "marketing"]

# --- Fixed values: the six departments of dim_department ---
DEPARTMENTS = ["Sales", "Engineering", "Marketing", "Customer Support", "Operations", "Finance"]


@dataclass(frozen=True)
class StarTable:
    name: str
    columns: tuple  # (column, Spark SQL type, max varchar length or None)
    primary_key: tuple
    foreign_keys: tuple = ()  # (column, dimension table, dimension column)
    not_null: tuple = ()


def _money(name):
    return (name, "decimal(14,2)", None)


def _vc(name, n):
    return (name, "string", n)


# --- Fixed values: star schema tables, column types, varchar limits, keys ---
STAR_TABLES = {
    t.name: t
    for t in [
        StarTable("dim_date",
                  (("date_key", "date", None), ("year", "int", None), ("month", "int", None),
                   ("month_start", "date", None), ("quarter", "int", None), _vc("month_name", 20)),
                  ("date_key",),
                  not_null=("date_key", "year", "month", "month_start", "quarter", "month_name")),
        StarTable("dim_department", (_vc("department", 50),), ("department",)),
        StarTable("dim_region",
                  (_vc("region_code", 20), _vc("country_group", 50), _vc("sub_region", 50)),
                  ("region_code",)),
        StarTable("fact_sales",
                  (_vc("order_id", 20), _vc("customer_id", 20), _vc("region_code", 20),
                   ("order_date", "date", None), ("month_start", "date", None),
                   _money("order_total"), _money("order_cost"), _vc("status", 20)),
                  ("order_id",), (("region_code", "dim_region", "region_code"),)),
        StarTable("fact_hr_cost",
                  (_vc("department", 50), _vc("region_code", 20), ("month_start", "date", None),
                   ("headcount", "int", None), _money("salary_cost"), _money("benefits_cost"),
                   _money("total_cost")),
                  ("department", "region_code", "month_start"),
                  (("department", "dim_department", "department"),
                   ("region_code", "dim_region", "region_code"))),
        StarTable("fact_finance_gl",
                  (_vc("txn_id", 20), _vc("department", 50), _vc("region_code", 20),
                   ("month_start", "date", None), _vc("account_code", 10), _vc("account_name", 50),
                   _money("amount")),
                  ("txn_id",),
                  (("department", "dim_department", "department"),
                   ("region_code", "dim_region", "region_code"))),
        StarTable("fact_inventory_movement",
                  (_vc("movement_id", 20), _vc("sku", 20), _vc("region_code", 20),
                   ("month_start", "date", None), _vc("movement_type", 20), ("quantity", "int", None)),
                  ("movement_id",), (("region_code", "dim_region", "region_code"),)),
        StarTable("fact_inventory_stock",
                  (_vc("sku", 20), _vc("region_code", 20), ("month_start", "date", None),
                   ("quantity_on_hand", "int", None), ("unit_cost", "decimal(10,2)", None)),
                  ("sku", "region_code", "month_start"),
                  (("region_code", "dim_region", "region_code"),)),
        StarTable("fact_marketing_spend",
                  (_vc("campaign_id", 20), _vc("channel", 30), _vc("region_code", 20),
                   ("month_start", "date", None), _money("spend_amount")),
                  ("campaign_id",), (("region_code", "dim_region", "region_code"),)),
        StarTable("fact_marketing_leads",
                  (_vc("lead_id", 20), _vc("campaign_id", 20), _vc("region_code", 20),
                   ("month_start", "date", None), ("converted", "boolean", None)),
                  ("lead_id",), (("region_code", "dim_region", "region_code"),)),
        StarTable("fact_finance_budget",
                  (_vc("department", 50), ("month_start", "date", None), _money("budget_amount")),
                  ("department", "month_start"),
                  (("department", "dim_department", "department"),)),
    ]
}

# Dimensions load before facts.
STAR_LOAD_ORDER = [
    "dim_date", "dim_department", "dim_region", "fact_sales", "fact_hr_cost",
    "fact_finance_gl", "fact_finance_budget", "fact_inventory_stock",
    "fact_inventory_movement", "fact_marketing_spend", "fact_marketing_leads",
]

# --- Fixed values: the registry of cross-domain views and their routing keywords ---
VIEW_REGISTRY = [
    ("vw_revenue_vs_hr_cost",
     ["hr cost", "headcount cost", "revenue", "margin", "department", "salary", "benefits"]),
    ("vw_revenue_vs_hr_cost_by_region", ["hr cost", "region", "revenue", "margin", "department"]),
    ("vw_marketing_spend_vs_sales", ["marketing", "spend", "campaign", "sales lift", "region", "channel"]),
    ("vw_inventory_turns_vs_sales", ["inventory", "turns", "turnover", "stock", "warehouse", "sku", "velocity"]),
    ("vw_department_pnl", ["pnl", "p&l", "budget", "opex", "department", "profit", "loss"]),
]

DEFAULT_VIEW = "vw_revenue_vs_hr_cost"

# --- Fixed values: read-only SQL audit rules ---
FORBIDDEN_KEYWORDS = [
    "insert", "update", "delete", "drop", "alter", "truncate", "grant",
    "revoke", "create", "replace", "merge", "call", "execute", "copy",
    "vacuum", "reindex", "comment", "security", "attach", "detach",
    "pg_sleep", "dblink", "into",
]
FORBIDDEN_SCHEMAS = ["information_schema", "pg_catalog", "pg_"]

# --- Fixed values: text read as missing by the raw CSV scan (pandas defaults) ---
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
