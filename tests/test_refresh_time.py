"""The full refresh spends less on order: ranges dealt by what costs little, files by number, fast compression."""

import pytest
from pyspark.sql import functions as F
from test_refresh_volume import THINGS

from lakeviews.operators.dedupe import SEQ, dedupe_keep_last
from lakeviews.plans import job as JOB
from lakeviews.plans.binding import StarBinding
from lakeviews.plans.raw_zone import RawZone
from lakeviews.session import scratch_path
from lakeviews.sources import csv_split
from lakeviews.sources import lake as L


def test_ranges_are_dealt_by_what_needs_no_coercion(spark, small_dir):
    raw = RawZone(StarBinding(spark, small_dir))
    for name in ("sales.orders", "sales.order_lines", "finance.gl_transactions", "inventory.warehouse_movements"):
        plan = raw.ordered(name)._jdf.queryExecution().optimizedPlan().toString()
        dealt = next(line for line in plan.splitlines() if "RepartitionByExpression" in line)
        assert "RLIKE" not in dealt and "Sort [" in plan and "RLIKE" in plan[plan.index("Sort ["):plan.index("RepartitionBy")], name


def test_files_are_numbered_in_the_order_of_positions(spark, monkeypatch):
    rows = [(f"k{i % 7}", str(i)) for i in range(40)]
    for split_above in (None, 0):
        root = scratch_path(spark, "numbers of files, 100% ü")
        path = f"{L.raw_path(root, 'test', 'things')}/dt=2024-01-01"
        df = spark.createDataFrame(rows, "id string, note string").repartitionByRange(3, F.col("note").cast("int")).sortWithinPartitions(F.col("note").cast("int"))
        df.write.options(**L.CSV, maxRecordsPerFile=4).csv(path)
        read = L.scan_raw_csv(spark, root, THINGS, split_above=split_above)
        assert "string" not in dict(read.dtypes)[SEQ]
        assert [tuple(r) for r in read.orderBy(SEQ).select("id", "note").collect()] == rows
        positions = L.read_csv(spark, path, THINGS.raw_schema(), split_above).orderBy("position").select("id", "note").collect()
        assert [tuple(r) for r in positions] == rows and len(L.data_files(spark, path)) > 9
        assert {r.id: r.note for r in dedupe_keep_last(read, ["id"], SEQ).collect()} == dict(rows)


def test_file_order_is_that_of_positions(spark):
    paths = [f"file:/d/{n}" for n in ("part-00010-b.csv", "part-99999-a.csv", "part-100000-a.csv", "part-00010-a.c001.csv", "part-00010-a.c000.csv", "other.csv", "part-x.csv",
                                      "part-99999999999999999999.csv", "ä.csv", "part-9223372036854775807.csv")]
    df = spark.createDataFrame([(p,) for p in paths], "file string")
    at = df.select("file", F.struct(csv_split.part_number(F.element_at(F.split("file", "/"), -1)).alias("part"), "file").alias("position"))
    assert [r.file for r in at.orderBy("position").collect()] == sorted(paths, key=csv_split.file_order)


def test_compressed_landings_are_written_fast(spark):
    sizes = {}
    df = spark.range(0, 50000, 1, 1).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("note "), F.col("id") * 37 % 1009).alias("note"))
    for name, level in (("fast", None), ("best", "BEST_COMPRESSION")):
        root = scratch_path(spark, "gzip-level")
        if level:
            df.write.options(**L.CSV, compression="gzip").option("zlib.compress.level", level).csv(f"{L.raw_path(root, 'test', 'things')}/dt=2024-01-01")
        else:
            L.land_raw(df, root, "test", "things", "2024-01-01", "gzip")
        sizes[name] = sum(size for _, size in L.data_files(spark, f"{L.raw_path(root, 'test', 'things')}/dt=2024-01-01"))
        assert L.scan_raw_csv(spark, root, THINGS, keep_input_order=False).exceptAll(df).isEmpty()
    assert sizes["fast"] > 1.1 * sizes["best"]


class Cut(Exception):
    pass


def _regions(spark, *codes):
    return spark.createDataFrame([(c, "g", None) for c in codes], "region_code string, country_group string, sub_region string")


def _customers(spark):
    return spark.createDataFrame([("1", "A", None, "2024-01-01")], "customer_id string, region_code string, segment string, signup_date string")


def test_the_digest_is_taken_while_rows_are_landed(spark, monkeypatch):
    root = scratch_path(spark, "job")
    inputs = {"sales.regions": _regions(spark, "A", "B", None), "sales.customers": _customers(spark)}
    digest, passes, plain = JOB.input_digest(inputs), [], JOB.digest_lines
    monkeypatch.setattr(JOB, "digest_lines", lambda given: passes.append(1) or plain(given))
    journal = JOB.land_inputs(spark, inputs, inputs, root, "2024-01-02")
    assert not passes and not journal.resumed and not journal.skipped and journal.path == f"{root}/_journal/2024-01-02-{digest[:32]}/1"
    assert all(journal.done(f"land-{n}") for n in inputs)
    # the run was cut off now: the inputs are digested to see that it goes on
    again = JOB.land_inputs(spark, inputs, inputs, root, "2024-01-02")
    assert passes and again.resumed and again.path == journal.path and set(again.skipped) == {"land-sales.regions", "land-sales.customers"}
    again.finish()
    del passes[:]
    new = JOB.land_inputs(spark, inputs, inputs, root, "2024-01-02")
    assert not passes and not new.resumed and not new.skipped and new.path.endswith("/2")


@pytest.mark.parametrize("others", [False, True])
def test_a_run_cut_off_while_landing_goes_on(spark, monkeypatch, others):
    root = scratch_path(spark, "job")
    inputs = {"sales.regions": _regions(spark, "A", "B"), "sales.customers": _customers(spark)}
    plain, landed = L.land_raw, []

    def cut(df, root, domain, name, *rest):
        if name == "customers":
            raise Cut
        landed.append(name)
        return plain(df, root, domain, name, *rest)

    monkeypatch.setattr(L, "land_raw", cut)
    for _ in range(2):  # the second attempt is cut off too
        with pytest.raises(Cut):
            JOB.land_inputs(spark, inputs, inputs, root, "2024-01-02")
    assert landed == ["regions"]
    monkeypatch.setattr(L, "land_raw", lambda *given: landed.append(given[3]) or plain(*given))
    other = {**inputs, "sales.regions": _regions(spark, "A", "C")}
    del landed[:]
    if others:  # land the day anew meanwhile
        assert JOB.land_inputs(spark, other, other, root, "2024-01-02").skipped == [] and sorted(landed) == ["customers", "regions"]
        del landed[:]
    journal = JOB.land_inputs(spark, inputs, inputs, root, "2024-01-02")
    assert journal.resumed and sorted(landed) == ["customers", "regions"][:1 + others] and journal.skipped == ["land-sales.regions"][others:]
    rows = spark.read.options(**L.CSV).csv(f"{root}/raw/sales/regions/dt=2024-01-02")
    assert sorted(r.region_code for r in rows.collect()) == ["A", "B"]
