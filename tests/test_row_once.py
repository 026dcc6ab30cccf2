"""Keep-last carries its sequence column once; independent datasets are written together."""

import threading

from pyspark.sql import functions as F

from lakeviews.operators.dedupe import dedupe_keep_last, total_order
from lakeviews.plans import registry_io as IO
from lakeviews.plans.registry import QUERIES

ROWS = [("a", 1, None, "x"), ("a", 1, 2.0, "x"), ("a", None, 9.0, "z"), (None, 3, 1.0, None), (None, 3, 1.0, "y"), ("b", 5, 5.0, "q"), ("b", 5, 5.0, "q")]


def _frame(spark):
    return spark.createDataFrame(ROWS, "k string, n int, v double, s string")


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_total_order_keeps_the_greatest_row(spark):
    df = _frame(spark)
    out = dedupe_keep_last(df, ["k"], total_order(df, exclude=("k",)))
    assert out.columns == df.columns
    assert set(map(tuple, out.collect())) == {("a", 1, 2.0, "x"), (None, 3, 1.0, "y"), ("b", 5, 5.0, "q")}


def test_order_of_some_columns_still_decides(spark):
    df = _frame(spark)
    out = dedupe_keep_last(df, ["k"], total_order(df.select("v", "s"))).collect()
    assert {r.k: r.v for r in out} == {"a": 9.0, None: 1.0, "b": 5.0}


def test_sequence_column_is_not_part_of_the_row(spark):
    df = _frame(spark).withColumn("seq", F.struct(F.lit("file").alias("file"), (10 - F.coalesce("v", F.lit(0.0))).alias("pos")))
    kept = dedupe_keep_last(df, ["k"], "seq")
    assert kept.columns == df.columns and {r.k: r.seq.pos for r in kept.collect()} == {"a": 10.0, None: 9.0, "b": 5.0}
    plan = _optimized(kept.drop("seq"))
    assert "max(seq" not in plan and "struct(n, n#" in plan and "seq, seq#" not in plan


def _most_at_once(monkeypatch, name):
    lock, meet, now, most, plain = threading.Lock(), threading.Event(), [0], [0], getattr(IO.L, name)

    def counted(*args, **kw):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            if now[0] > 1:
                meet.set()
        meet.wait(5)
        try:
            return plain(*args, **kw)
        finally:
            with lock:
                now[0] -= 1
    monkeypatch.setattr(IO.L, name, counted)
    return most


def test_curated_datasets_are_written_together(spark, small_dir, monkeypatch):
    most = _most_at_once(monkeypatch, "write_curated")
    assert QUERIES["write_curated"](spark, small_dir).count() == QUERIES["coerce_types"](spark, small_dir).count()
    assert most[0] > 1


def test_star_tables_are_written_together(spark, small_dir, monkeypatch):
    given, plain = [], IO.L.load_star_tables
    monkeypatch.setattr(IO.L, "load_star_tables", lambda spark, star, root, order, jobs=1: given.append(jobs) or plain(spark, star, root, order, jobs))
    QUERIES["load_star_table"](spark, small_dir)
    assert given == [IO.JOB.CONCURRENT_JOBS] and given[0] > 1
