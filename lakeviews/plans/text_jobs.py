"""Table-scale text jobs: question routing, read-only SQL audit, report text, answers.

Routing scores every question against the (fixed, five-entry) view registry
inside one projection: the registry is a literal array of keyword lists, so
there is no join and no shuffle; ranking is an ``array_sort`` of
``(-score, registry position, view)`` structs, i.e. score descending with
ties in registry order.  The SQL audit is one projection of nested
conditions.  Report text is built per summary row; the answer text joins a
summary's rows, whose number is the size of a dimension (departments,
regions, SKUs), never the number of facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeviews.contracts import DEFAULT_VIEW, FORBIDDEN_KEYWORDS, FORBIDDEN_SCHEMAS, VIEW_REGISTRY
from lakeviews.functions import text as TX
from lakeviews.session import scratch_path

# --- Fixed values: how a question was taken ---
MODE_FALLBACK, MODE_REJECTED = "fallback", "rejected"

# --- Fixed values: audit verdict messages, in rule order ---
MSG_EMPTY = "empty SQL"
MSG_MULTI = "multiple statements are not allowed"
MSG_NOT_SELECT = "only SELECT/CTE read queries are allowed"
MSG_KEYWORD = "forbidden keyword detected: "
MSG_SCHEMA = "access to '{}' is not allowed"
MSG_COMMENT = "SQL comments are not allowed"


# ---------------- routing ----------------
def view_scores(question: Column) -> list[Column]:
    """Score per registered view: number of its keywords contained in the lower-cased ``question``.

    One filter over the keyword array each: spelt out as sums of tests, the scores of all views
    outgrow the size of a generated method.
    """
    return [F.size(F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(question, k))) for _, keywords in VIEW_REGISTRY]


def pick_views(scores: list[Column], top_n: int = 1) -> Column:
    """First ``top_n`` views with score > 0 (score descending, ties in registry order);
    the default view when nothing matches.  ``scores`` are per-view score columns.

    ``sort_array`` of (-score, position, view) structs puts the best first and the
    zero scores last; slicing to the number of positive scores drops those.  All
    built-ins with generated code (no lambda functions).
    """
    entries = [F.struct((-s).alias("neg_score"), F.lit(i).alias("pos"), F.lit(v[0]).alias("view"))
               for i, (s, v) in enumerate(zip(scores, VIEW_REGISTRY))]
    matched = sum(((s > 0).cast("int") for s in scores[1:]), (scores[0] > 0).cast("int"))
    top = F.slice(F.sort_array(F.array(*entries)), F.lit(1), F.least(matched, F.lit(top_n)))
    return F.when(matched > 0, top.getField("view")).otherwise(F.array(F.lit(DEFAULT_VIEW)))


def route_questions(questions: DataFrame, text_col: str, id_cols: list[str], top_n: int = 1) -> DataFrame:
    """Three projections: the lower-cased text, the keyword scores, the ranking over those
    columns (one fused expression would repeat each of them)."""
    names = [f"__score_{i}" for i in range(len(VIEW_REGISTRY))]
    lowered = questions.select(*id_cols, F.lower(text_col).alias("__question"))
    scored = lowered.select(*id_cols, *[s.alias(n) for s, n in zip(view_scores(F.col("__question")), names)])
    return scored.select(*id_cols, pick_views([F.col(n) for n in names], top_n).alias("views"))


def cross_join_registry(questions: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """Every question scored against every registered view (one column per view)."""
    questions = questions.select(*id_cols, F.lower(text_col).alias("__question"))
    scores = view_scores(F.col("__question"))
    return questions.select(*id_cols, *[s.cast("long").alias(f"score_{v[0]}")
                                        for s, v in zip(scores, VIEW_REGISTRY)])


def top_n_per_question(questions: DataFrame, text_col: str, id_cols: list[str], n: int) -> DataFrame:
    """One row per (question, rank) for the first n views with score > 0 (or the default)."""
    routed = route_questions(questions, text_col, id_cols, n)
    return routed.select(*id_cols, F.posexplode("views").alias("rank0", "view")) \
        .select(*id_cols, (F.col("rank0") + 1).alias("rank"), "view")


# ---------------- read-only SQL audit ----------------
def audit_sql_log(df: DataFrame, sql_col: str, id_cols: list[str]) -> DataFrame:
    """Trimmed statement, verdict and first failing rule per SQL text.

    The trimmed text is computed in a first projection and the rules in a
    second, so each regular expression runs once per row.
    """
    stripped0 = TX.fn_strip(F.col(sql_col))
    df = df.select(*id_cols, F.col(sql_col).alias("__sql"), stripped0.alias("__stripped"))
    stripped = F.col("__stripped")
    df = df.select(*id_cols, "__sql", "__stripped",
                   F.when(stripped.endswith(";"), TX.fn_strip(F.regexp_replace(stripped, ";$", "")))
                   .otherwise(stripped).alias("__cleaned"))
    sql, cleaned = F.col("__sql"), F.col("__cleaned")
    lowered = F.lower(cleaned)
    tokens = F.regexp_extract_all(lowered, F.lit(TX.TOKEN_PATTERN), 0)
    # First forbidden keyword in list order (array_intersect keeps the first array's
    # order); ``get`` gives NULL when nothing matches.
    keyword = F.get(F.array_intersect(F.array(*[F.lit(k) for k in FORBIDDEN_KEYWORDS]), tokens), 0)
    schema = F.coalesce(*[F.when(F.contains(lowered, F.lit(s)), F.lit(s)) for s in FORBIDDEN_SCHEMAS])
    rule = (F.when(sql.isNull() | (stripped == ""), F.lit(MSG_EMPTY))
            .when(F.contains(cleaned, F.lit(";")), F.lit(MSG_MULTI))
            .when(~TX.fn_prefix(cleaned, "select", "with"), F.lit(MSG_NOT_SELECT))
            .when(keyword.isNotNull(), F.concat(F.lit(MSG_KEYWORD), keyword))
            .when(schema.isNotNull(), F.concat(*[F.lit(p) if i == 0 else F.concat(schema, F.lit(p))
                                                 for i, p in enumerate(MSG_SCHEMA.split("{}"))]))
            .when(F.contains(cleaned, F.lit("--")) | F.contains(cleaned, F.lit("/*")), F.lit(MSG_COMMENT)))
    return df.select(*id_cols, F.when(rule.isNull(), cleaned).alias("statement"),
                     rule.isNull().alias("accepted"), rule.alias("rule"))


# ---------------- report text ----------------
# --- Fixed values: report headers and the closing note of the HR report ---
HEAD_HR = "Revenue vs HR cost by department (full history):"
HEAD_MKT = "Marketing spend vs sales revenue by region (full history):"
HEAD_INV = "Inventory turnover vs sales velocity by SKU (full history):"
HEAD_PNL = "Department P&L summary (full history):"
HR_NOTE = ("\n{} carries the highest HR cost of any department in the warehouse. "
           "If HR cost is rising while gross margin for the same department is falling in a "
           "given quarter, that's the clearest sign cost growth is outpacing revenue -- check "
           "the region-level breakdown (vw_revenue_vs_hr_cost_by_region) to localize it.")
NO_RATIO = "no data (no stock on hand in this period)"

# --- Fixed values: the summary SQL each report answers with ---
SQL_HR = ("SELECT department, ROUND(SUM(hr_cost), 2) AS total_hr_cost, ROUND(SUM(gl_revenue), 2) AS total_revenue, "
          "ROUND(SUM(gross_margin), 2) AS total_gross_margin FROM vw_revenue_vs_hr_cost "
          "GROUP BY department ORDER BY total_hr_cost DESC")
SQL_MKT = ("SELECT region_code, ROUND(SUM(marketing_spend), 2) AS total_spend, "
           "ROUND(SUM(sales_revenue), 2) AS total_revenue FROM vw_marketing_spend_vs_sales "
           "GROUP BY region_code ORDER BY total_spend DESC")
SQL_INV = ("SELECT sku, ROUND(AVG(turnover_ratio), 3) AS avg_turnover_ratio, SUM(outbound_qty) AS total_outbound_qty "
           "FROM vw_inventory_turns_vs_sales GROUP BY sku ORDER BY avg_turnover_ratio DESC NULLS LAST")
SQL_PNL = ("SELECT department, ROUND(SUM(revenue), 2) AS total_revenue, ROUND(SUM(total_opex), 2) AS total_opex, "
           "ROUND(SUM(budget_amount), 2) AS total_budget, ROUND(SUM(hr_cost), 2) AS total_hr_cost "
           "FROM vw_department_pnl GROUP BY department ORDER BY total_revenue DESC")


# --- Fixed values: columns of each report's query, with the decimals they are rounded to, and rows that a preview shows ---
PREVIEW_COLUMNS = {
    "hr": {"department": None, "total_hr_cost": 2, "total_revenue": 2, "total_gross_margin": 2},
    "marketing": {"region_code": None, "total_spend": 2, "total_revenue": 2},
    "inventory": {"sku": None, "avg_turnover_ratio": 3, "total_outbound_qty": None},
    "pnl": {"department": None, "total_revenue": 2, "total_opex": 2, "total_budget": 2, "total_hr_cost": 2},
}
PREVIEW_ROWS = 20


def _record(report: str) -> Column:
    """A summary row as a JSON object; NaN and NULL are null, and numbers keep their decimals."""
    def value(c: str, digits: int | None) -> Column:
        exact = F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) if digits else F.col(c)
        return (exact.cast(f"decimal(28,{digits})") if digits else exact).alias(c)

    return F.to_json(F.struct(*[value(c, d) for c, d in PREVIEW_COLUMNS[report].items()]), {"ignoreNullFields": "false"}).alias("record")


def _money(c: str) -> Column:
    return F.coalesce(TX.fn_money_text(F.col(c)), F.lit("n/a"))


def hr_lines(summary: DataFrame) -> DataFrame:
    """(report, sort key, line) rows of the HR report; sort key = (-total_hr_cost, department)."""
    line = F.concat(F.lit("  - "), F.col("department"), F.lit(": HR cost "), _money("total_hr_cost"),
                    F.lit(" vs revenue "), _money("total_revenue"), F.lit(" (HR cost is "),
                    TX.fn_ratio_text(F.col("hr_cost_pct_of_revenue")), F.lit("% of revenue), gross margin "),
                    _money("total_gross_margin"), F.lit("."))
    return summary.select(F.lit("hr").alias("report"), F.col("department").cast("string").alias("label"),
                          F.struct((-F.col("total_hr_cost")).alias("k1"), F.col("department").cast("string")
                                   .alias("k2")).alias("sort_key"), line.alias("line"), _record("hr"))


def mkt_lines(summary: DataFrame) -> DataFrame:
    line = F.concat(F.lit("  - "), F.col("region_code"), F.lit(": spend "), _money("total_spend"),
                    F.lit(" -> revenue "), _money("total_revenue"), F.lit(" (revenue-to-spend ratio "),
                    TX.fn_ratio_text(F.col("revenue_to_spend")), F.lit("x)."))
    return summary.select(F.lit("marketing").alias("report"), F.col("region_code").cast("string").alias("label"),
                          F.struct((-F.col("total_spend")).alias("k1"), F.col("region_code").cast("string")
                                   .alias("k2")).alias("sort_key"), line.alias("line"), _record("marketing"))


def inv_lines(summary: DataFrame) -> DataFrame:
    t = F.round(F.col("avg_turnover_ratio") * 1000).cast("long")
    ratio = F.when(t.isNull(), F.lit(NO_RATIO)).otherwise(TX.fn_thousandths_text(t))
    line = F.concat(F.lit("  - "), F.col("sku").cast("string"), F.lit(": average monthly turnover ratio "),
                    ratio, F.lit(", total outbound units "), TX.fn_count_text(F.col("total_outbound_qty")),
                    F.lit("."))
    # DESC NULLS LAST: a NULL ratio sorts after every value.
    k1 = F.coalesce(-F.col("avg_turnover_ratio"), F.lit(float("inf")))
    return summary.select(F.lit("inventory").alias("report"), F.col("sku").cast("string").alias("label"),
                          F.struct(k1.alias("k1"), F.col("sku").cast("string").alias("k2")).alias("sort_key"),
                          line.alias("line"), _record("inventory"))


def pnl_lines(summary: DataFrame) -> DataFrame:
    variance = F.when(F.col("total_budget").isNotNull(),
                      F.concat(F.lit(", opex vs budget variance "), _money("opex_budget_variance"))) \
        .otherwise(F.lit(""))
    line = F.concat(F.lit("  - "), F.col("department"), F.lit(": revenue "), _money("total_revenue"),
                    F.lit(", opex "), _money("total_opex"), variance, F.lit(", HR cost "),
                    _money("total_hr_cost"), F.lit("."))
    return summary.select(F.lit("pnl").alias("report"), F.col("department").cast("string").alias("label"),
                          F.struct((-F.col("total_revenue")).alias("k1"), F.col("department").cast("string")
                                   .alias("k2")).alias("sort_key"), line.alias("line"), _record("pnl"))


_HEADERS = {"hr": HEAD_HR, "marketing": HEAD_MKT, "inventory": HEAD_INV, "pnl": HEAD_PNL}
_SQL = {"hr": SQL_HR, "marketing": SQL_MKT, "inventory": SQL_INV, "pnl": SQL_PNL}
# Views answered by each report (the by-region view shares the department report).
REPORT_OF_VIEW = {
    "vw_revenue_vs_hr_cost": "hr", "vw_revenue_vs_hr_cost_by_region": "hr",
    "vw_marketing_spend_vs_sales": "marketing", "vw_inventory_turns_vs_sales": "inventory",
    "vw_department_pnl": "pnl",
}


def positions(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Position from 1 of each row in ``order`` within ``group``, without one task per group.

    Rows are dealt to tasks by ranges of (group, order) and written; a row's position is that in
    its piece plus the sizes of the group's pieces before it (one row per group and piece).
    """
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    pieces = df.repartitionByRange(*group, *order).withColumn("__piece", F.spark_partition_id())
    pieces.write.parquet(path)
    dealt = spark.read.schema(pieces.schema).parquet(path)
    sizes = dealt.groupBy(*group, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*group, "__piece", F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy(*group, "__piece").orderBy(*order))
    return (dealt.withColumn("__own", own).join(starts, [*group, "__piece"])
            .select(*df.columns, (F.col("__own") + F.col("__before")).cast("int").alias(name)))


def _placed(hr: DataFrame, mkt: DataFrame, inv: DataFrame, pnl: DataFrame) -> DataFrame:
    """The rows of the four reports with their position from 1."""
    body = hr_lines(hr).unionByName(mkt_lines(mkt)).unionByName(inv_lines(inv)).unionByName(pnl_lines(pnl))
    return positions(body, ["report"], ["sort_key"], "pos")


def _with_heads(placed: DataFrame) -> DataFrame:
    spark = placed.sparkSession
    heads = spark.createDataFrame([(k, 0, v) for k, v in _HEADERS.items()], "report string, pos int, line string")
    # Only of reports that have lines.
    heads = heads.join(placed.select("report").distinct(), "report", "left_semi")
    note = (placed.where(F.col("report") == "hr").agg(F.max("pos").alias("last"), F.min_by("label", "pos").alias("top"))
            .where("last IS NOT NULL")
            .select(F.lit("hr").alias("report"), (F.col("last") + 1).alias("pos"),
                    F.format_string(HR_NOTE.replace("{}", "%s"), "top").alias("line")))
    return placed.select("report", "pos", "line").unionByName(heads.select("report", "pos", "line")).unionByName(note)


def report_lines(hr: DataFrame, mkt: DataFrame, inv: DataFrame, pnl: DataFrame) -> DataFrame:
    """(report, pos, line): header at 0, then one line per summary row in report order.

    The HR report ends with a note naming the department with the highest HR cost.
    """
    return _with_heads(_placed(hr, mkt, inv, pnl))


def _by(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def report_answers(lines: DataFrame) -> DataFrame:
    """One row per report: the newline-joined answer text and the SQL it answers with."""
    return (lines.groupBy("report")
            .agg(TX.fn_join_lines(F.sort_array(F.collect_list(F.struct("pos", "line")))).alias("answer"))
            .select("report", F.element_at(_by(_SQL), F.col("report")).alias("sql"), "answer"))


def answers(hr: DataFrame, mkt: DataFrame, inv: DataFrame, pnl: DataFrame) -> DataFrame:
    """One row per report: SQL, answer text and a preview of its first rows as a JSON array."""
    placed = _placed(hr, mkt, inv, pnl)
    shown = F.sort_array(F.collect_list(F.struct("pos", "record")))["record"]
    preview = (placed.where(F.col("pos") <= PREVIEW_ROWS).groupBy("report")
               .agg(F.concat(F.lit("["), F.array_join(shown, ","), F.lit("]")).alias("data_preview")))
    return report_answers(_with_heads(placed)).join(preview, "report", "left").select(
        "report", "sql", "answer", F.coalesce("data_preview", F.lit("[]")).alias("data_preview"))


def route_to_reports(questions: DataFrame, text_col: str, id_cols: list[str]) -> DataFrame:
    """Each question with its mode, the view it is routed to and the report that answers it.

    A blank question is rejected: it has neither view nor report.
    """
    kept = questions.select(*id_cols, F.col(text_col).alias("question"))
    routed = route_questions(kept, "question", [*id_cols, "question"])
    blank = F.coalesce(TX.fn_strip(F.col("question")) == "", F.lit(True))
    view = F.when(~F.col("__blank"), F.col("views")[0])
    return (routed.withColumn("__blank", blank)
            .select(*id_cols, "question", F.when(F.col("__blank"), MODE_REJECTED).otherwise(MODE_FALLBACK).alias("mode"), view.alias("view"))
            .withColumn("report", F.when(F.col("view").isNotNull(), F.coalesce(F.element_at(_by(REPORT_OF_VIEW), F.col("view")), F.lit("hr")))))


def answer_questions(questions: DataFrame, text_col: str, id_cols: list[str], hr: DataFrame, mkt: DataFrame, inv: DataFrame,
                     pnl: DataFrame) -> DataFrame:
    """One tagged table that holds every answer once.

    Rows of kind ``question`` name the view a question is routed to and the
    report that answers it; the row of kind ``answer`` of that report holds the
    SQL, the answer's text with its figures, and the preview.
    """
    asked = route_to_reports(questions, text_col, id_cols).select(F.lit("question").alias("kind"), "*")
    given = answers(hr, mkt, inv, pnl).select(F.lit("answer").alias("kind"), "*")
    return asked.unionByName(given, allowMissingColumns=True)


def answered(tagged: DataFrame, id_cols: list[str]) -> DataFrame:
    """The full result of each question that isn't rejected, its answer looked up by report."""
    given = tagged.where("kind = 'answer'").select("report", "sql", "answer", "data_preview")
    return tagged.where("kind = 'question' AND report IS NOT NULL").select(*id_cols, "question", "mode", "view", "report").join(given, "report", "left")
