"""Numbered versions, concurrent catalogue writers, readers of old versions, runs that go on where they were cut off."""

import threading

import pytest
from pyspark.sql import functions as F

from lakeviews.contracts import TRANSFORM_ORDER
from lakeviews.plans import catalog as CAT
from lakeviews.plans import job as JOB
from lakeviews.plans.binding import StarBinding
from lakeviews.plans.raw_zone import RawZone
from lakeviews.session import scratch_path
from lakeviews.sources import lake as L
from lakeviews.sources import versions as VS


def test_a_number_is_given_once(spark):
    root = scratch_path(spark, "versions")
    assert VS.head(spark, root) is None
    VS.commit(spark, root, "a", 1)
    with pytest.raises(VS.Conflict):
        VS.commit(spark, root, "b", 1)
    assert VS.head(spark, root) == (1, "a")
    assert VS.point_to(spark, root, "c") == 2 and VS.pointed_to(spark, root) == "c"


def test_of_many_writers_one_gets_the_number(spark):
    root = scratch_path(spark, "versions")
    won, gate = [], threading.Barrier(8)

    def write(k):
        gate.wait()
        try:
            VS.commit(spark, root, f"path {k}", 1)
            won.append(k)
        except VS.Conflict:
            pass

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and VS.pointed_to(spark, root) == f"path {won[0]}"


def test_an_entry_never_filled_is_passed_over(spark, monkeypatch):
    monkeypatch.setattr(VS, "PATIENCE", 0.2)
    root = scratch_path(spark, "versions")
    VS.commit(spark, root, "whole", 1)
    VS.commit(spark, root, "", 2)
    assert VS.head(spark, root) == (1, "whole")
    assert VS.point_to(spark, root, "next") == 3 and VS.pointed_to(spark, root) == "next"


def profile(spark, name, rows):
    return spark.createDataFrame([("d", name, "{}", "[]", rows, None)], CAT.CATALOG_SCHEMA).withColumn("last_updated", F.lit("2024-01-01").cast("timestamp"))


def test_concurrent_catalogue_writers_all_survive(spark):
    root = scratch_path(spark, "catalog")
    errors, gate = [], threading.Barrier(4)

    def save(k):
        try:
            gate.wait()
            CAT.update_catalog(spark, root, profile(spark, f"set {k}", k))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=save, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    assert {r.dataset_name: r.row_count for r in CAT.load_catalog(spark, root).collect()} == {f"set {k}": k for k in range(4)}


def test_an_overtaken_writer_starts_again(spark, monkeypatch):
    """Another writer commits between this one's read and its commit; neither update is lost."""
    root = scratch_path(spark, "catalog")
    CAT.update_catalog(spark, root, profile(spark, "first", 1))
    plain, overtaken = VS.commit, []

    def late(spark_, base, path, number):
        if not overtaken:
            overtaken.append(number)
            monkeypatch.setattr(VS, "commit", plain)
            CAT.update_catalog(spark, root, profile(spark, "other", 2))
        return plain(spark_, base, path, number)

    monkeypatch.setattr(VS, "commit", late)
    CAT.update_catalog(spark, root, profile(spark, "mine", 3))
    assert overtaken == [2]
    assert {r.dataset_name for r in CAT.load_catalog(spark, root).collect()} == {"first", "other", "mine"}
    assert [n for n, _ in VS.log(spark, f"{root}/catalog")] == [1, 2, 3]


def test_readers_of_an_older_version_end_unharmed(spark):
    root = scratch_path(spark, "curated")
    first = L.write_curated(spark.range(1_000).withColumn("v", F.lit("one")), root, "d", "s", keep=2)
    reader = L.scan_curated_parquet(spark, root, "d", "s")
    L.write_curated(spark.range(10).withColumn("v", F.lit("two")), root, "d", "s", keep=2)
    assert reader.filter("v = 'one'").count() == 1_000  # opened before, read after
    assert L.scan_curated_parquet(spark, root, "d", "s").count() == 10
    L.write_curated(spark.range(5).withColumn("v", F.lit("three")), root, "d", "s", keep=2)
    assert L.folders(spark, first) is None and L.scan_curated_parquet(spark, root, "d", "s").count() == 5
    with pytest.raises(ValueError):
        L.scan_curated_parquet(spark, root, "d", "never")


class Cut(Exception):
    pass


@pytest.fixture
def inputs(spark, small_dir):
    raw = RawZone(StarBinding(spark, small_dir).materialize_joins())
    return {n: raw.dataset(n) for n in TRANSFORM_ORDER}


def test_a_run_cut_off_after_curating_goes_on(spark, inputs, monkeypatch):
    root = scratch_path(spark, "job")
    plain = L.load_star_tables

    def cut(*_, **__):
        raise Cut

    monkeypatch.setattr(L, "load_star_tables", cut)
    with pytest.raises(Cut):
        JOB.job_full_refresh(spark, inputs, root, "2024-01-02", export_root=f"{root}/exports")
    monkeypatch.setattr(L, "load_star_tables", plain)
    curated = VS.pointed_to(spark, L.curated_path(root, "sales", "orders"))
    # another writer's version of a curated dataset, which this run must not take
    L.write_curated(spark.read.parquet(curated).limit(0), root, "sales", "orders")

    result = JOB.job_full_refresh(spark, inputs, root, "2024-01-02", export_root=f"{root}/exports")
    assert result.journal.resumed
    assert {f"land-{n}" for n in TRANSFORM_ORDER} | {f"curate-{n}" for n in TRANSFORM_ORDER} | {"check", "register"} == set(result.journal.skipped)
    assert result.star["fact_sales"].count() == spark.read.parquet(curated).count() > 0
    told = {(r.part, r.name): r for r in JOB.summary(result).collect()}
    assert len(told) == 16 + 11 + 8 and told["report", "sales.orders"].row_count == told["star", "fact_sales"].row_count

    whole = JOB.summary(JOB.job_full_refresh(spark, inputs, scratch_path(spark, "job"), "2024-01-02", export_root=scratch_path(spark, "exports")))
    same = {(r.part, r.name): (r.row_count, r.passed) for r in whole.collect()}
    assert same == {k: (r.row_count, r.passed) for k, r in told.items()}

    again = JOB.job_full_refresh(spark, inputs, root, "2024-01-02")  # the last run was finished
    assert not again.journal.resumed and not again.journal.skipped and again.journal.run != result.journal.run


def test_changed_inputs_or_a_changed_landing_are_not_skipped(spark, inputs, monkeypatch):
    root = scratch_path(spark, "job")

    def cut(*_, **__):
        raise Cut

    few = {n: inputs[n] for n in ("sales.regions", "sales.customers")}
    monkeypatch.setattr(QC := JOB.QC, "dataset_metrics", cut)
    with pytest.raises(Cut):
        JOB.job_full_refresh(spark, few, root, "2024-01-02")
    first = VS.Journal(spark, f"{root}/_journal", f"2024-01-02-{JOB.input_digest(few)[:32]}")
    assert first.resumed and first.done("land-sales.regions")
    other = {**few, "sales.regions": few["sales.regions"].limit(3)}
    assert JOB.input_digest(other) != JOB.input_digest(few) == JOB.input_digest({n: df.repartition(3) for n, df in few.items()})
    assert not VS.Journal(spark, f"{root}/_journal", f"2024-01-02-{JOB.input_digest(other)[:32]}").resumed
    # somebody lands the day anew: the resumed run lands its own rows again
    L.land_raw(other["sales.regions"].coalesce(1), root, "sales", "regions", "2024-01-02")
    with pytest.raises(Cut):
        JOB.job_full_refresh(spark, few, root, "2024-01-02")
    again = VS.Journal(spark, f"{root}/_journal", f"2024-01-02-{JOB.input_digest(few)[:32]}")
    assert spark.read.options(**L.CSV).csv(f"{root}/raw/sales/regions/dt=2024-01-02").count() == few["sales.regions"].count()
    assert again.resumed and QC is JOB.QC


def test_an_update_of_a_digest_notices_every_column(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, "y")], "k int, p string, q string")
    b = spark.createDataFrame([(1, None, "x"), (2, "y", None)], "k int, p string, q string")
    twice = a.unionAll(a)
    digests = {JOB.input_digest({"t": df}) for df in (a, b, twice, a.drop("q"), a.withColumnRenamed("q", "r"))}
    assert len(digests) == 5
