"""What RECALL promises holds for pairs that are split at every depth."""

from pyspark.sql import functions as F

from lakeviews.llm import jaccard_join as J


def test_runs_reach_recall_after_all_splits():
    met = 1.0
    for _ in range(J.DEPTH - 1):
        met = 1 - (1 - 0.8 * met) ** J.BRANCH
    assert 1 - (1 - 0.8 * met) ** J.runs() >= J.RECALL


def test_a_node_is_split_on_different_coordinates(spark):
    nodes = spark.range(5000).select(F.xxhash64("id").alias("node"))
    rows = nodes.select(F.array(*J._coordinates()).alias("at")).collect()
    assert all(len(set(r.at)) == J.BRANCH and J.runs() <= min(r.at) and max(r.at) < J.SIGNATURE for r in rows)
