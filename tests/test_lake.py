"""Raw zone round trips: landing, newest partition, null tokens, keep-last by file order."""

from pyspark.sql import functions as F

from lakeviews.contracts import Contract
from lakeviews.functions.coerce import coerce_types
from lakeviews.operators.dedupe import SEQ, dedupe_keep_last
from lakeviews.session import scratch_path
from lakeviews.sources import lake as L

C = Contract("test", "things", {"id": "string", "qty": "int", "note": "string"}, ("id",), ("id",))


def test_land_scan_latest_and_null_tokens(spark):
    root = scratch_path(spark, "lake-test")
    day1 = spark.createDataFrame([("a", "1", "old")], "id string, qty string, note string")
    day2 = spark.createDataFrame([("a", "2", "NA"), ("b", "3.0", "null"), ("c", "x", "ok")],
                                 "id string, qty string, note string")
    L.land_raw(day1, root, "test", "things", "2024-01-01")
    L.land_raw(day2, root, "test", "things", "2024-01-02")
    assert L.latest_partition(spark, root, "test", "things", C) == "2024-01-02"
    rows = coerce_types(L.scan_raw_csv(spark, root, C, keep_input_order=False), C).orderBy("id").collect()
    assert [(r.id, r.qty, r.note) for r in rows] == [("a", 2, None), ("b", 3, None), ("c", None, "ok")]


def test_relanding_overwrites_only_that_day(spark):
    root = scratch_path(spark, "lake-test")
    df = spark.createDataFrame([("a", "1", "n")], "id string, qty string, note string")
    L.land_raw(df, root, "test", "things", "2024-01-01")
    L.land_raw(df, root, "test", "things", "2024-01-02")
    L.land_raw(df, root, "test", "things", "2024-01-02")
    got = spark.read.option("header", True).csv(L.raw_path(root, "test", "things")).groupBy("dt").count()
    assert sorted((str(r.dt), r["count"]) for r in got.collect()) == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_absent_dataset_is_skipped(spark):
    root = scratch_path(spark, "lake-test")
    assert L.scan_raw_csv(spark, root, C) is None


def test_keep_last_follows_file_order(spark):
    root = scratch_path(spark, "lake-test")
    rows = [("a", "1", "first"), ("b", "1", "only"), ("a", "2", "last")]
    df = spark.createDataFrame(rows, "id string, qty string, note string").coalesce(1)
    L.land_raw(df, root, "test", "things", "2024-01-01")
    typed = coerce_types(L.scan_raw_csv(spark, root, C), C)
    out = dedupe_keep_last(typed, C.primary_key, F.col(SEQ)).drop(SEQ).orderBy("id").collect()
    assert [(r.id, r.note) for r in out] == [("a", "last"), ("b", "only")]


def test_json_records_keep_nulls_and_drop_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None)], "k int, x double, s string")
    assert L.json_safe_records(df).collect()[0].record == '{"k":1,"x":null,"s":null}'


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_scan_prunes_to_newest_partition(spark):
    root = scratch_path(spark, "lake-test")
    df = spark.createDataFrame([("a", "1", "n")], "id string, qty string, note string")
    L.land_raw(df, root, "test", "things", "2024-01-01")
    L.land_raw(df, root, "test", "things", "2024-01-02")
    scan = L.scan_raw_csv(spark, root, C, keep_input_order=False)
    files = scan.inputFiles()
    assert files and all("/dt=2024-01-02/" in f for f in files)
    assert scan.count() == 1


def test_cluster_sizing():
    from lakeviews.session import cluster_conf
    tib, mib = 1024 ** 4, 1024 ** 2
    c = cluster_conf(100 * tib, 8000)
    maps = 100 * tib // int(c["spark.sql.files.maxPartitionBytes"])
    reducers = int(c["spark.sql.shuffle.partitions"])
    assert (maps, reducers) == (204800, 102400)
    # a quarter of the input over the reducers: 256 MiB each
    assert 25 * tib // reducers == 256 * mib
    assert c["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert int(cluster_conf(10 * mib, 8)["spark.sql.shuffle.partitions"]) == 16


def test_keep_last_follows_file_order_across_splits(spark):
    """A landed file larger than a split is read by several tasks, in file order."""
    n, keys = 30000, 997
    root = scratch_path(spark, "lake-test")
    ids = F.pmod(F.col("id") * 7919, F.lit(keys)).cast("string")
    notes = F.pmod(F.col("id") * 31337, F.lit(100003)).cast("string")
    df = spark.range(n).coalesce(1).select(ids.alias("id"), F.lit("1").alias("qty"), notes.alias("note"))
    L.land_raw(df, root, "test", "things", "2024-01-01")
    expected = {}
    for i in range(n):
        expected[str(i * 7919 % keys)] = str(i * 31337 % 100003)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        scan = L.scan_raw_csv(spark, root, C)
        assert scan.rdd.getNumPartitions() > 1
        out = dedupe_keep_last(coerce_types(scan, C), C.primary_key, F.col(SEQ)).drop(SEQ)
        got = {r.id: r.note for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected


def test_partitioned_fact_is_written_without_small_files(spark, small_dir):
    """Sixteen write tasks, one file per month folder: rows are clustered by month before writing."""
    import glob

    from lakeviews.plans.binding import StarBinding

    gl = StarBinding(spark, small_dir).fact_finance_gl
    root = scratch_path(spark, "lake-test")
    base = L.load_star_tables(spark, {"fact_finance_gl": gl.repartition(16)}, root, ["fact_finance_gl"])
    local = base.replace("file:", "")
    months = glob.glob(f"{local}/fact_finance_gl/month_start=*")
    files = glob.glob(f"{local}/fact_finance_gl/month_start=*/*.parquet")
    assert months and len(files) == len(months)
    assert spark.read.parquet(f"{base}/fact_finance_gl").count() == gl.count()


def test_part_numbers_above_five_digits_keep_their_order(spark):
    """Two landed files named as Spark would name them: the row of part 100000 is the last."""
    import os

    root = scratch_path(spark, "lake-test")
    day = L.raw_path(root, "test", "things").replace("file:", "") + "/dt=2024-01-01"
    os.makedirs(day)
    for part, note in (("99999", "first"), ("100000", "last")):
        with open(f"{day}/part-{part}-x-c000.csv", "w") as f:
            f.write(f"id,qty,note\na,1,{note}\n")
    out = dedupe_keep_last(coerce_types(L.scan_raw_csv(spark, root, C), C), C.primary_key, F.col(SEQ)).collect()
    assert [(r.id, r.note) for r in out] == [("a", "last")]


def test_quoted_line_breaks_and_quotes_survive(spark):
    root = scratch_path(spark, "lake-test")
    rows = [("a", "1", "one\ntwo"), ("b", "2", 'say "hi", he said'), ("c", "3", "back\\slash")]
    L.land_raw(spark.createDataFrame(rows, "id string, qty string, note string"), root, "test", "things", "2024-01-01")
    got = L.scan_raw_csv(spark, root, C, keep_input_order=False).orderBy("id").collect()
    assert [tuple(r) for r in got] == rows
    assert L.raw_file_inventory(spark, root).agg(F.sum("data_rows")).first()[0] == 3


def test_only_a_missing_folder_counts_as_absent(spark):
    import pytest

    assert L.folders(spark, scratch_path(spark, "absent")) is None
    with pytest.raises(Exception):
        L.latest_partition(spark, "no-such-scheme://host/lake", "test", "things", C)
