"""Question routing and the read-only SQL audit on literal tables (the reference's cases)."""

import pytest

from lakeviews.plans import text_jobs as J


def route(spark, questions, n=1):
    df = spark.createDataFrame([(i, q) for i, q in enumerate(questions)], "id int, q string")
    return [r.views for r in J.route_questions(df, "q", ["id"], n).orderBy("id").collect()]


def test_routing_cases(spark):
    views = route(spark, [
        "Compare HR costs with revenue",
        "How does marketing spend compare to sales in each region?",
        "What is our inventory turnover vs sales velocity?",
        "asdkjhaskjdh random gibberish query",
        "department pnl and budget variance",
    ])
    assert "vw_revenue_vs_hr_cost" in views[0]
    assert views[1][0] == "vw_marketing_spend_vs_sales"
    assert views[2][0] == "vw_inventory_turns_vs_sales"
    assert views[3] == ["vw_revenue_vs_hr_cost"]
    assert views[4][0] == "vw_department_pnl"


def test_routing_ties_keep_registry_order(spark):
    # "hr cost" + "revenue" score 2 for both revenue views; the first registered wins.
    assert route(spark, ["hr cost and revenue"], 2)[0] == ["vw_revenue_vs_hr_cost", "vw_revenue_vs_hr_cost_by_region"]


ACCEPTED = [
    ("SELECT department, hr_cost FROM vw_revenue_vs_hr_cost", "SELECT department, hr_cost FROM vw_revenue_vs_hr_cost"),
    ("SELECT 1;", "SELECT 1"),
    ("WITH x AS (SELECT 1 AS a) SELECT a FROM x", "WITH x AS (SELECT 1 AS a) SELECT a FROM x"),
]
REJECTED = [
    "INSERT INTO foo VALUES (1)", "DROP TABLE fact_sales", "DELETE FROM fact_sales WHERE 1=1",
    "UPDATE fact_sales SET order_total = 0", "SELECT 1; DROP TABLE fact_sales", "EXPLAIN SELECT 1", "",
    "SELECT * FROM information_schema.tables", "SELECT * FROM pg_catalog.pg_tables",
    "SELECT 1 -- ; DROP TABLE fact_sales", "SELECT * INTO new_table FROM fact_sales", "SELECT pg_sleep(100)",
]


def audit(spark, sqls):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sqls)], "id int, sql string")
    return J.audit_sql_log(df, "sql", ["id"]).orderBy("id").collect()


def test_audit_accepts_read_queries(spark):
    rows = audit(spark, [s for s, _ in ACCEPTED])
    assert [r.statement for r in rows] == [t for _, t in ACCEPTED]
    assert all(r.accepted for r in rows)


def test_audit_rejects(spark):
    rows = audit(spark, REJECTED)
    assert not any(r.accepted for r in rows)
    assert all(r.statement is None and r.rule for r in rows)


@pytest.mark.parametrize("sql,rule", [
    ("   ", "empty SQL"),
    ("SELECT 1; SELECT 2", "multiple statements are not allowed"),
    ("EXPLAIN SELECT 1", "only SELECT/CTE read queries are allowed"),
    ("SELECT * INTO t FROM x", "forbidden keyword detected: into"),
    ("SELECT jpg_url FROM pages", "access to 'pg_' is not allowed"),
    ("SELECT 1 /* x */", "SQL comments are not allowed"),
    ("SELECT createdat FROM events", None),
])
def test_audit_rule_order(spark, sql, rule):
    assert audit(spark, [sql])[0].rule == rule


# --- questions and answers: the reference's cases over the views of the given tables ---
ASKED = ["Compare HR costs with revenue", "Compare marketing spend vs sales by region", "What is our inventory turnover?",
         "department pnl and budget variance", "asdkjhaskjdh random gibberish query", "  \n", None]


@pytest.fixture(scope="module")
def answers(spark, small_dir):
    from lakeviews.plans.registry import registry_text as RT

    questions = spark.createDataFrame(list(enumerate(ASKED)), "id int, q string")
    tagged = J.answer_questions(questions, "q", ["id"], *RT._summaries(spark, small_dir))
    return tagged.persist(), {r.id: r for r in J.answered(tagged, ["id"]).collect()}


def test_an_answer_cites_figures_and_names_of_its_preview(answers):
    import json

    hr = answers[1][0]
    assert hr.mode == "fallback" and hr.view.startswith("vw_revenue_vs_hr_cost")
    preview = json.loads(hr.data_preview)
    assert preview and "$" in hr.answer and all(row["department"] in hr.answer for row in preview)
    assert [row["total_hr_cost"] for row in preview] == sorted((row["total_hr_cost"] for row in preview), reverse=True)
    assert f"{preview[0]['department']} carries the highest HR cost" in hr.answer
    assert answers[1][4].answer == hr.answer  # the default


def test_every_answers_query_passes_the_audit(spark, answers):
    assert all(r.accepted for r in audit(spark, [r.sql for r in answers[1].values()]))
    assert answers[1][1].sql.lower().startswith("select")


def test_a_preview_is_plain_json_of_twenty_rows_at_most(answers):
    import json

    def no_constant(name):
        raise AssertionError(name)

    inventory = answers[1][2]
    assert inventory.view == "vw_inventory_turns_vs_sales"
    rows = json.loads(inventory.data_preview, parse_constant=no_constant)
    assert len(rows) == 20 and set(rows[0]) == {"sku", "avg_turnover_ratio", "total_outbound_qty"}
    assert inventory.answer.count("\n") == 40  # all SKUs have a line


def test_null_ratios_are_null_in_the_preview(spark):
    import json

    inv = spark.createDataFrame([(1, None, 5), (2, 0.5, 7), (3, float("nan"), 1)], "sku long, avg_turnover_ratio double, total_outbound_qty long")
    record = {r.sku: json.loads(r.record) for r in inv.select("sku", J._record("inventory")).collect()}
    assert record[1]["avg_turnover_ratio"] is None and record[3]["avg_turnover_ratio"] is None and record[2]["avg_turnover_ratio"] == 0.5


def test_answers_are_held_once_and_blank_questions_rejected(answers):
    tagged, _ = answers
    kinds = {r.kind: r["count"] for r in tagged.groupBy("kind").count().collect()}
    assert kinds == {"question": len(ASKED), "answer": 4}
    rejected = tagged.where("mode = 'rejected'").collect()
    assert {r.id for r in rejected} == {5, 6} and all(r.view is None and r.report is None for r in rejected)
