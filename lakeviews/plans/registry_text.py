"""Keyed queries for text jobs, scalar functions and ordering operators (see registry.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS, STAR_TABLES, TRANSFORM_ORDER
from lakeviews.functions import numeric as N
from lakeviews.functions import text as TX
from lakeviews.plans import queries as Q
from lakeviews.plans import text_jobs as J
from lakeviews.plans import views as V
from lakeviews.plans.binding import StarBinding
from lakeviews.plans.registry import register, star

# --- Fixed values: questions of the routing tests, keyed by event type ---
QUESTION_OF_EVENT = {
    "view": "Compare HR costs with revenue for user ",
    "click": "How does marketing spend compare to sales in each region?",
    "purchase": "What is our inventory turnover vs sales velocity?",
    "signup": "department pnl and budget variance",
}
GIBBERISH = "asdkjhaskjdh random gibberish query "


def event_questions(events: DataFrame) -> DataFrame:
    """One question per event, worded by its event type (the user or event id keeps texts distinct)."""
    t = F.col("event_type")
    q = (F.when(t == "view", F.concat(F.lit(QUESTION_OF_EVENT["view"]), F.col("user_id").cast("string")))
         .when(t == "click", F.lit(QUESTION_OF_EVENT["click"]))
         .when(t == "purchase", F.lit(QUESTION_OF_EVENT["purchase"]))
         .when(t == "signup", F.lit(QUESTION_OF_EVENT["signup"]))
         .otherwise(F.concat(F.lit(GIBBERISH), F.col("event_id").cast("string"))))
    return events.select("event_id", q.alias("question"))


def all_questions(t) -> DataFrame:
    """(question_id, question): every turn of every conversation and one question per event."""
    turns = t.conversations.select(F.concat_ws("-", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
                                   .alias("question_id"), F.col("text").alias("question"))
    events = event_questions(t.events).select(F.concat_ws("-", F.lit("event"), F.col("event_id").cast("string")).alias("question_id"), "question")
    return turns.unionByName(events)


def event_sql_log(events: DataFrame) -> DataFrame:
    """One SQL text per event, from twelve statement shapes chosen by event id."""
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id").cast("string")
    shapes = [
        F.concat(F.lit("SELECT department, hr_cost FROM vw_revenue_vs_hr_cost WHERE user_id = "), uid),
        F.concat(F.lit("  SELECT "), uid, F.lit(";  ")),
        F.concat(F.lit("WITH x AS (SELECT "), uid, F.lit(" AS a) SELECT a FROM x")),
        F.concat(F.lit("SELECT "), uid, F.lit("; DROP TABLE fact_sales")),
        F.concat(F.lit("EXPLAIN SELECT "), uid),
        F.concat(F.lit("SELECT * INTO t_"), eid, F.lit(" FROM fact_sales")),
        F.concat(F.lit("SELECT * FROM information_schema.tables WHERE id = "), eid),
        F.concat(F.lit("SELECT "), uid, F.lit(" -- "), F.col("event_type")),
        F.concat(F.lit("SELECT pg_sleep("), uid, F.lit(")")),
        F.lit(" \t\n "),
        F.concat(F.lit("select jpg_url from pages where page_id = "), eid),
        F.concat(F.lit("SELECT createdat FROM events WHERE user_id = "), uid),
    ]
    sql = F.element_at(F.array(*shapes), (F.col("event_id") % len(shapes) + 1).cast("int"))
    return events.select("event_id", sql.alias("sql_text"))


def _hr_summary(spark, sf_dir):
    return Q.q_hr_summary(V.Views(star(spark, sf_dir)).revenue_vs_hr())


def _summaries(spark, sf_dir):
    """The four report summaries; their views share the binding joins, computed once."""
    v = V.Views(star(spark, sf_dir))
    return (Q.q_hr_summary(v.revenue_vs_hr()), Q.q_marketing_summary(v.marketing()),
            Q.q_inventory_summary(v.inventory()), Q.q_pnl_summary(v.pnl()))


# ---------------- routing and audit (§2.12, §2.3, §2.5) ----------------
@register("route_questions")
def _(spark, sf_dir):
    conv = StarBinding(spark, sf_dir).t.conversations
    return J.route_questions(conv, "text", ["conv_id", "turn"]).select(
        "conv_id", "turn", F.col("views")[0].alias("view"))


@register("cross_join_registry")
def _(spark, sf_dir):
    return J.cross_join_registry(all_questions(StarBinding(spark, sf_dir).t), "question", ["question_id"])


@register("top_n_per_question")
def _(spark, sf_dir):
    return J.top_n_per_question(all_questions(StarBinding(spark, sf_dir).t), "question", ["question_id"], 2)


@register("audit_sql_log")
def _(spark, sf_dir):
    """Statements of twelve shapes made of events, and the texts of all conversations and documents as they are."""
    t = StarBinding(spark, sf_dir).t
    turn = F.concat_ws("-", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    log = (event_sql_log(t.events).select(F.concat_ws("-", F.lit("event"), F.col("event_id").cast("string")).alias("statement_id"), "sql_text")
           .unionByName(t.conversations.select(turn.alias("statement_id"), F.col("text").alias("sql_text")))
           .unionByName(t.documents.select(F.concat_ws("-", F.lit("document"), F.col("doc_id").cast("string")).alias("statement_id"), F.col("text").alias("sql_text"))))
    return J.audit_sql_log(log, "sql_text", ["statement_id"])


@register("report_lines")
def _(spark, sf_dir):
    return J.report_lines(*_summaries(spark, sf_dir))


@register("fn_join_lines")
def _(spark, sf_dir):
    return J.report_answers(J.report_lines(*_summaries(spark, sf_dir))).select("report", "answer")


@register("answer_questions")
def _(spark, sf_dir):
    """Every question with its view and report, and each report's answer once, with its figures and a preview."""
    return J.answer_questions(all_questions(star(spark, sf_dir).t), "question", ["question_id"], *_summaries(spark, sf_dir))


# ---------------- ordering operators (§2.5) ----------------
@register("sort_view")
def _(spark, sf_dir):
    """All five views in their order: the key of each row and its position."""
    v = V.Views(star(spark, sf_dir))
    views = [("vw_revenue_vs_hr_cost", v.revenue_vs_hr(), V.DEPT_GRAIN),
             ("vw_revenue_vs_hr_cost_by_region", v.by_region(), V.REGION_GRAIN),
             ("vw_marketing_spend_vs_sales", v.marketing(), V.MARKET_GRAIN),
             ("vw_inventory_turns_vs_sales", v.inventory(), V.SKU_GRAIN), ("vw_department_pnl", v.pnl(), V.DEPT_GRAIN)]
    rows = [df.select(F.lit(name).alias("view"), F.struct(*[F.when(F.lit(c != "sku"), F.col(c).cast("string")).otherwise(F.lpad(F.col(c).cast("string"), 20, "0")).alias(f"k{i}")
                                                            for i, c in enumerate([*grain, *grain[:3 - len(grain)]])]).alias("k"),
                      F.concat_ws("|", *[F.col(c).cast("string") for c in grain]).alias("sort_key")) for name, df, grain in views]
    stacked = rows[0]
    for r in rows[1:]:
        stacked = stacked.unionByName(r)
    return J.positions(stacked, ["view"], ["k"], "pos").select("view", "sort_key", "pos")


@register("sort_desc_nulls_last")
def _(spark, sf_dir):
    s = Q.q_inventory_summary(V.Views(star(spark, sf_dir)).inventory())
    return s.orderBy(F.col("avg_turnover_ratio").desc_nulls_last(), F.col("sku").asc())


@register("top_1_department")
def _(spark, sf_dir):
    hr = Q.q_hr_summary(V.Views(star(spark, sf_dir)).revenue_vs_hr())
    return hr.orderBy(F.col("total_hr_cost").desc(), F.col("department").asc()).limit(1) \
        .select("department", "total_hr_cost")


@register("limit_preview")
def _(spark, sf_dir):
    s = Q.q_inventory_summary(V.Views(star(spark, sf_dir)).inventory())
    return s.orderBy(F.col("avg_turnover_ratio").desc_nulls_last(), F.col("sku").asc()).limit(20)


# ---------------- scalar functions (§2.7) ----------------
@register("fn_coalesce")
def _(spark, sf_dir):
    pnl = V.Views(star(spark, sf_dir)).pnl()
    return pnl.select("department", "month_start",
                      F.coalesce("budget_amount", F.lit(0)).cast("double").alias("budget_or_zero"),
                      F.coalesce("hr_cost", "budget_amount").cast("double").alias("hr_cost_or_budget"))


@register("fn_case_guard")
def _(spark, sf_dir):
    s = star(spark, sf_dir)
    out = V.agg_outbound(s.fact_inventory_movement)
    j = s.fact_inventory_stock.join(out, V.SKU_GRAIN, "left")
    q = F.coalesce(F.col("outbound_qty"), F.lit(0))
    return j.select(*V.SKU_GRAIN, N.round_ratio3(q, F.col("quantity_on_hand")).alias("turnover_ratio"))


@register("fn_numeric_div_round3")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    q = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("long")
    return li.select("l_orderkey", "l_linenumber", N.round_ratio3(q, F.col("l_linenumber")).alias("ratio"))


@register("fn_round2")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    disc = F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_discount").cast("decimal(4,2)")
    return (li.groupBy("l_returnflag", "l_linestatus")
            .agg(F.round(F.sum(disc * F.lit(0.5).cast("decimal(1,1)")), 2).cast("double").alias("half_discount")))


@register("fn_round_avg3")
def _(spark, sf_dir):
    inv = V.Views(star(spark, sf_dir)).inventory()
    t = F.round(F.col("turnover_ratio") * 1000).cast("long")
    return inv.groupBy("region_code").agg(N.avg_thousandths_round3(t).alias("avg_turnover_ratio"))


@register("fn_negate")
def _(spark, sf_dir):
    gl = star(spark, sf_dir).fact_finance_gl
    return gl.groupBy("account_code").agg((-F.sum("amount")).cast("double").alias("negated_total"))


@register("fn_nan_to_null")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    x = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax") / F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", TX.fn_nan_to_null(x).alias("tax_per_discount"))


@register("fn_ratio_pct")
def _(spark, sf_dir):
    return _hr_summary(spark, sf_dir).select("department", "hr_cost_pct_of_revenue")


@register("fn_ratio_x")
def _(spark, sf_dir):
    return Q.q_marketing_summary(V.Views(star(spark, sf_dir)).marketing()).select("region_code", "revenue_to_spend")


LICENSE_WORDS = ("license", "copyright", "password", "secret")


@register("fn_lower_contains")
def _(spark, sf_dir):
    d = StarBinding(spark, sf_dir).t.documents
    return d.select("doc_id", *[TX.fn_lower_contains(F.col("text"), w).alias(f"has_{w}") for w in LICENSE_WORDS])


@register("fn_strip")
def _(spark, sf_dir):
    c = StarBinding(spark, sf_dir).t.conversations
    s = TX.fn_strip(F.concat(F.lit(" \t"), F.col("text"), F.lit("\n ")))
    return c.select("conv_id", "turn", s.alias("stripped"), F.length(s).alias("n_chars"))


@register("fn_tokens")
def _(spark, sf_dir):
    d = StarBinding(spark, sf_dir).t.documents
    toks = TX.fn_tokens(F.col("text"))
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                    F.array_join(F.sort_array(toks), " ").alias("tokens"))


@register("fn_prefix")
def _(spark, sf_dir):
    p = StarBinding(spark, sf_dir).t.pages
    return p.select("page_id", TX.fn_prefix(F.col("html"), "<!doctype", "<html").alias("is_html_start"))


@register("fn_money_text")
def _(spark, sf_dir):
    hr = _hr_summary(spark, sf_dir)
    return hr.select("department", TX.fn_money_text(F.col("total_hr_cost")).alias("hr_cost_text"),
                     TX.fn_money_text(F.col("total_gross_margin")).alias("margin_text"))


@register("fn_ratio_text")
def _(spark, sf_dir):
    hr = _hr_summary(spark, sf_dir)
    return hr.select("department", TX.fn_ratio_text(F.col("hr_cost_pct_of_revenue")).alias("pct_text"))


@register("fn_schema_json")
def _(spark, sf_dir):
    """Profile of every curated dataset: column -> type map as JSON text, plus its row count."""
    from lakeviews.plans.registry_quality import _raw, all_coerced
    cur = all_coerced(_raw(spark, sf_dir))
    parts = []
    for name in TRANSFORM_ORDER:
        df = cur[name]
        schema = F.to_json(F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)]))
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("dataset"), schema.alias("schema_json"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("agg_row_count")
def _(spark, sf_dir):
    from lakeviews.plans.registry_quality import _star_from_raw
    star = _star_from_raw(spark, sf_dir)
    parts = [star[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in STAR_TABLES if t in star]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
