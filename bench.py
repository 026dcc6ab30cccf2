"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no driver collect).  The
binding joins, which all views read, are written first, as a line of their own
(``materialize_joins``); then one warm-up run of the flagship view.  Prints ONE
JSON line: {"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "vw_revenue_vs_hr_cost_by_region",
    "vw_revenue_vs_hr_cost",
    "vw_marketing_spend_vs_sales",
    "vw_inventory_turns_vs_sales",
    "vw_department_pnl",
    "q_hr_summary",
    "q_inventory_summary",
    "q_pnl_summary",
    "q_cost_leads_margin",
    "q_revenue_vs_hr_filtered",
    "dedupe_keep_last",
    "check_referential_integrity",
    "quality_report",
    "enforce_primary_keys",
    "audit_sql_log",
    "report_lines",
    "answer_questions",
    "fn_tokens",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from lakeviews.plans.registry import QUERIES
    from lakeviews.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="lakeviews-bench", shuffle_partitions=int(cpus) * 2,
                          extra_conf={"spark.driver.memory": "16g"})
    only = [a for a in sys.argv[1:] if a in QUERIES]
    keys = only or HEADLINE

    def run(key: str) -> float:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    from lakeviews.plans.registry import star

    spark.range(1_000_000).selectExpr("sum(id)").collect()  # warm-up: JVM
    t0 = time.perf_counter()
    star(spark, sf_dir)
    timings = {"materialize_joins": round(time.perf_counter() - t0, 3)}
    run("vw_revenue_vs_hr_cost_by_region")  # warm-up: code paths, file listing
    timings |= {k: round(run(k), 3) for k in keys}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
