"""The sixteen raw datasets, as text, derived from the input tables.

This is what the landing zone holds before cleaning: every column is a
string (as read from CSV).  The derivation keeps the dirt that cleaning
must handle, all of it decided by the data itself:

  * duplicate keys: order lines, GL postings and movements are keyed by
    (orderkey, linenumber), which repeats in the line items;
  * orphans: customers of nation 24 point at an unknown region; leads
    point at users that are not campaigns;
  * NULLs: an order's customer is blank when the order is pending (status P);
    a lead's region is blank when its user has no campaign;
  * integer columns written with a decimal point ("17.0");
  * booleans as yes / False / 0.
"""

from __future__ import annotations

from functools import cached_property
from itertools import takewhile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS
from lakeviews.functions.coerce import coerce_column
from lakeviews.plans.binding import MONEY, StarBinding


def s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class RawZone:
    def __init__(self, star: StarBinding):
        self.star = star
        self.t = star.t
        self.made_of: dict[str, tuple[DataFrame, list[Column], dict[str, Column]]] = {}

    def dataset(self, full_name: str) -> DataFrame:
        return getattr(self, full_name.replace(".", "__"))

    def _text(self, full_name: str, rows: DataFrame, key: list[Column], columns: dict[str, Column]) -> DataFrame:
        """``columns`` of ``rows``; rows have one ``key`` if and only if their primary keys are equal as text."""
        self.made_of[full_name] = (rows, key, columns)
        return rows.select(*[c.alias(n) for n, c in columns.items()])

    def ordered(self, full_name: str) -> DataFrame:
        """The dataset in order of its key and then of its other columns, so that of rows with one key the greatest is the last.

        Large datasets are put in order as rows of the tables they are made of
        and written out as text afterwards, which moves half the bytes.  Ranges
        are dealt by the key and the columns after it that are plain text, which
        cost little; what has to be coerced first only decides between the rows
        of one range, where rows are equal so far.
        """
        df, contract = self.dataset(full_name), CONTRACTS[full_name]
        rest = [x for x in contract.columns if x not in contract.primary_key]
        rows, key, columns = self.made_of.get(full_name) or (df, [F.col(k) for k in contract.primary_key], {c: F.col(c) for c in df.columns})
        order = [*key, *[coerce_column(columns[x], contract.columns[x]) for x in rest]]
        plain = len(key) + len(list(takewhile(lambda x: contract.columns[x] == "string", rest)))
        return (rows.repartitionByRange(*order[:plain]).sortWithinPartitions(*order)
                .select(*[c.alias(n) for n, c in columns.items()]))

    @cached_property
    def sales__regions(self) -> DataFrame:
        return self.star.dim_region.select(*[s(c).alias(c) for c in ("region_code", "country_group", "sub_region")])

    @cached_property
    def sales__customers(self) -> DataFrame:
        c = self.t.customer
        geo = self.star.geo
        region = F.when(F.col("c_nationkey") == 24, F.lit("ATLANTIS")).otherwise(F.col("region_code"))
        signup = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") * 97 % 3000).cast("int"))
        return (c.join(geo, c.c_nationkey == geo.n_nationkey)
                .select(s("c_custkey").alias("customer_id"), region.alias("region_code"),
                        F.col("c_mktsegment").alias("segment"), s(signup).alias("signup_date")))

    @cached_property
    def sales__orders(self) -> DataFrame:
        o = self.star.ord
        blank = (F.col("o_orderstatus") == "P")
        status = (F.when(F.col("o_orderstatus") == "F", "completed")
                  .when(F.col("o_orderstatus") == "O", "refunded").otherwise("cancelled"))
        return self._text("sales.orders", o, [F.col("o_orderkey")], {
            "order_id": s("o_orderkey"),
            "customer_id": F.when(blank, F.lit(None).cast("string")).otherwise(s("o_custkey")),
            "region_code": F.col("region_code"), "order_date": s("order_date"),
            "order_total": s("total"),
            "order_cost": s((F.col("total") * F.lit(0.6).cast("decimal(1,1)")).cast(MONEY)),
            "status": status})

    @cached_property
    def sales__order_lines(self) -> DataFrame:
        li = self.t.lineitem
        price = F.col("l_extendedprice").cast(MONEY)
        disc = F.col("l_discount").cast("decimal(4,2)")
        # Of an order and a line number, either may be missing: the text is then the other one.
        order = F.col("l_orderkey")
        key = [F.coalesce(order, F.col("l_linenumber").cast("long")), F.when(order.isNotNull(), F.col("l_linenumber"))]
        return self._text("sales.order_lines", li, key, {
            "order_line_id": F.concat_ws("-", s("l_orderkey"), s("l_linenumber")),
            "order_id": s("l_orderkey"), "sku": s(F.col("l_partkey") % 40),
            "product_name": F.concat(F.lit("part-"), s("l_partkey")),
            "quantity": s("l_quantity"),
            "unit_price": s(price),
            "unit_cost": s((price * F.lit(0.6).cast("decimal(1,1)")).cast(MONEY)),
            "discount_rate": s(disc),
            "line_net_amount": s((price * (F.lit(1) - disc)).cast(MONEY))})

    @cached_property
    def hr__employees(self) -> DataFrame:
        c = self.star.cust
        level = F.element_at(F.array(F.lit("junior"), F.lit("mid"), F.lit("senior")),
                             (F.col("c_custkey") % 3 + 1).cast("int"))
        hire = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") * 37 % 2000).cast("int"))
        return c.select(F.concat(F.lit("E"), s("c_custkey")).alias("employee_id"), "department",
                        "region_code", s(hire).alias("hire_date"), level.alias("job_level"))

    @cached_property
    def hr__headcount_costs(self) -> DataFrame:
        h = self.star.fact_hr_cost
        return h.select("department", "region_code", s("month_start").alias("month"),
                        *[s(c).alias(c) for c in ("headcount", "salary_cost", "benefits_cost", "total_cost")])

    @cached_property
    def hr__attrition_events(self) -> DataFrame:
        o = self.t.orders
        leavers = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
        c = self.star.cust
        return (leavers.join(c, leavers.o_custkey == c.c_custkey)
                .select(F.concat(F.lit("T"), s("o_orderkey")).alias("event_id"),
                        F.concat(F.lit("E"), s("o_custkey")).alias("employee_id"),
                        "department", "region_code",
                        s(F.to_date("o_orderdate")).alias("termination_date"),
                        F.col("o_orderpriority").alias("reason")))

    @cached_property
    def finance__budgets_by_department(self) -> DataFrame:
        b = self.star.fact_finance_budget
        return b.select("department", s("month_start").alias("month"), s("budget_amount").alias("budget_amount"))

    @cached_property
    def finance__revenue_by_month(self) -> DataFrame:
        o = self.star.ord
        return (o.groupBy("region_code", "month_start").agg(F.sum("total").alias("revenue"))
                .select("region_code", s("month_start").alias("month"), s("revenue").alias("revenue")))

    @cached_property
    def finance__gl_transactions(self) -> DataFrame:
        g = self.star.gl_columns
        return self._text("finance.gl_transactions", self.star.li, self._line_key(), {
            "txn_id": g["txn_id"], "department": g["department"], "region_code": g["region_code"], "month": s(g["month_start"]),
            "account_code": g["account_code"], "account_name": g["account_name"], "amount": s(g["amount"])})

    @cached_property
    def inventory__sku_master(self) -> DataFrame:
        p = self.t.part
        return (p.groupBy((F.col("p_partkey") % 40).alias("sku"))
                .agg(F.min("p_name").alias("product_name"), F.min("p_type").alias("category"),
                     F.min(F.col("p_retailprice").cast(MONEY)).alias("unit_cost"),
                     F.count(F.lit(1)).alias("reorder_point"))
                .select(*[s(c).alias(c) for c in ("sku", "product_name", "category", "unit_cost",
                                                  "reorder_point")]))

    @cached_property
    def inventory__stock_levels(self) -> DataFrame:
        st = self.star.fact_inventory_stock
        return st.select(s("sku").alias("sku"), "region_code", s("month_start").alias("month"),
                         s("quantity_on_hand").alias("quantity_on_hand"), s("unit_cost").alias("unit_cost"))

    @cached_property
    def inventory__warehouse_movements(self) -> DataFrame:
        m = self.star.movement_columns
        return self._text("inventory.warehouse_movements", self.star.li, self._line_key(), {
            "movement_id": m["movement_id"], "sku": s(m["sku"]), "region_code": m["region_code"], "month": s(m["month_start"]),
            "movement_type": m["movement_type"], "quantity": s(m["quantity"])})

    @staticmethod
    def _line_key() -> list[Column]:
        """Of joined line items, whose order is never missing."""
        return [F.col("l_orderkey"), F.col("l_linenumber")]

    @cached_property
    def marketing__campaigns(self) -> DataFrame:
        sp = self.star.fact_marketing_spend
        camp = self.star.camp
        return (sp.join(camp.select("campaign_id", "start_date"), "campaign_id")
                .select(s("campaign_id").alias("campaign_id"),
                        F.concat(F.lit("Campaign "), s("campaign_id")).alias("name"), "channel", "region_code",
                        s("start_date").alias("start_date"),
                        s(F.date_add("start_date", 30)).alias("end_date")))

    @cached_property
    def marketing__spend_by_channel(self) -> DataFrame:
        sp = self.star.fact_marketing_spend
        return sp.select(s("campaign_id").alias("campaign_id"), "channel", "region_code",
                         s("month_start").alias("month"), s("spend_amount").alias("spend_amount"))

    @cached_property
    def marketing__leads_by_campaign(self) -> DataFrame:
        e = self.t.events
        camp = self.star.camp.select("campaign_id", "region_code")
        converted = (F.when(F.col("event_type") == "purchase", F.lit("yes"))
                     .when(F.col("event_type") == "click", F.lit("False")).otherwise(F.lit("0")))
        return (e.join(camp, e.user_id == camp.campaign_id, "left")
                .select(s("event_id").alias("lead_id"), s("user_id").alias("campaign_id"), "region_code",
                        s(F.trunc(F.to_date("ts"), "MM")).alias("month"), converted.alias("converted")))
