"""A key holding a third of all rows: results stay whole and every grouping is partial before its shuffle."""

import re

from pyspark.sql import functions as F

from lakeviews.operators import quality as QC
from lakeviews.operators.dedupe import dedupe_keep_last
from lakeviews.plans.registry import QUERIES

N = 60000


def _hot(spark):
    """Rows spread over 8 partitions; key 'HOT' holds every third row."""
    return spark.range(N).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 7 % 1000).alias("v"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_below_exchange(plan: str, fn: str) -> bool:
    """``partial_<fn>`` is planned under a hash Exchange (map-side combine)."""
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    part = [i for i, line in enumerate(lines) if re.search(rf"partial_{fn}\b", line)]
    return any(p > e for e in ex for p in part)


def test_keep_last_with_hot_key(spark):
    out = dedupe_keep_last(_hot(spark), ["k"], F.col("seq"))
    assert _partial_below_exchange(_plan(out), "max_by")
    rows = {r.k: (r.seq, r.v) for r in out.collect()}
    last_hot = max(i for i in range(N) if i % 3 == 0)
    assert rows["HOT"] == (last_hot, last_hot * 7 % 1000)
    assert len(rows) == 1 + N - N // 3


def test_duplicates_with_hot_key(spark):
    out = QC.duplicate_count(_hot(spark), ["k"])
    assert _partial_below_exchange(_plan(out), "count")
    assert out.collect()[0].dups == N // 3 - 1


def test_orphans_with_hot_key_counted_before_the_anti_join(spark):
    df = _hot(spark)
    out = QC.orphan_count(df, "k", df.where(F.col("k") != "HOT"), "k")
    assert _partial_below_exchange(_plan(out), "count")
    assert out.collect()[0].orphans == N // 3


def test_views_aggregate_map_side(spark, small_dir):
    plan = _plan(QUERIES["vw_revenue_vs_hr_cost_by_region"](spark, small_dir))
    assert _partial_below_exchange(plan, "sum")


def test_skew_join_splitting_is_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
