"""Stored sums that follow a fact month by month equal those of a full run, and read only what changed."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeviews.plans import incremental as INC
from lakeviews.plans import views as V
from lakeviews.session import scratch_path
from lakeviews.sources import versions as VS

GL = "department string, region_code string, month_start date, account_code string, amount decimal(14,2)"


def months(n):
    return [dt.date(2024, m, 1) for m in range(1, n + 1)]


def postings(r, some, n=200):
    return [(r.choice("ab"), r.choice("xy"), r.choice(some), r.choice(["4000", "5000", "6000", None]), Decimal(r.randint(-9999, 9999)) / 100) for _ in range(n)]


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


@pytest.fixture
def gl(spark):
    root = scratch_path(spark, "kept-test")
    store = INC.Store(spark, root, "agg_gl_filtered")
    return store, f"{root}/fact_finance_gl"


def full(spark, path):
    return rows(V.agg_gl_filtered(spark.read.parquet(path)))


def test_only_changed_months_are_read(spark, gl):
    store, path = gl
    r = random.Random(1)
    INC.append_to_fact(spark.createDataFrame(postings(r, months(5)), GL), path)
    assert store.refresh(path).added == tuple(str(m) for m in months(5))
    assert rows(store.read()) == full(spark, path)
    before = store._manifest()["months"]
    assert store.refresh(path) == INC.Change()

    seen = []
    plain = store._sums
    store._sums = lambda p, files: seen.append(files) or plain(p, files)
    INC.append_to_fact(spark.createDataFrame(postings(r, months(6)[5:]), GL), path)  # a new month
    INC.append_to_fact(spark.createDataFrame(postings(r, months(2)[1:], 3), GL), path)  # more rows for February
    assert store.refresh(path) == INC.Change(added=("2024-02-01", "2024-06-01"))
    read = {f.split("month_start=")[1].split("/")[0] for f in seen[0]}
    assert read == {"2024-02-01", "2024-06-01"} and not {f.rsplit("/", 1)[1] for f in seen[0]} & set(before["2024-02-01"]["files"])
    assert rows(store.read()) == full(spark, path)
    after = store._manifest()["months"]
    assert {m for m in before if after[m] != before[m]} == {"2024-02-01"}


def test_changed_and_dropped_files_make_a_month_anew(spark, gl):
    store, path = gl
    r = random.Random(2)
    for _ in range(2):
        INC.append_to_fact(spark.createDataFrame(postings(r, months(3)), GL), path)
    store.refresh(path)
    local = path.replace("file:", "")
    january, march = (f"{local}/month_start=2024-0{m}-01" for m in (1, 3))
    os.remove(f"{january}/{sorted(f for f in os.listdir(january) if f.endswith('.parquet'))[0]}")
    for f in os.listdir(march):
        os.remove(f"{march}/{f}")
    os.rmdir(march)
    assert store.refresh(path) == INC.Change(anew=("2024-01-01",), dropped=("2024-03-01",))
    assert rows(store.read()) == full(spark, path)


def test_months_without_sums_and_null_measures(spark):
    root = scratch_path(spark, "kept-test")
    store, path = INC.Store(spark, root, "agg_sales"), f"{root}/fact_sales"
    schema = "order_id long, region_code string, month_start date, order_total decimal(14,2), status string"
    jan, feb = months(2)
    INC.append_to_fact(spark.createDataFrame([(1, "x", jan, Decimal("1.50"), "cancelled"), (2, "x", feb, Decimal("2.50"), "completed")], schema), path)
    store.refresh(path)
    assert [r.order_count for r in store.read().collect()] == [1]
    INC.append_to_fact(spark.createDataFrame([(3, "x", jan, Decimal("4.00"), "completed"), (4, None, jan, None, "completed")], schema), path)
    assert store.refresh(path).added == ("2024-01-01",)
    assert rows(store.read()) == rows(V.agg_sales(spark.read.parquet(path)))
    with pytest.raises(ValueError):
        INC.Store(spark, scratch_path(spark, "kept-test"), "agg_sales").read()


def test_a_lost_refresh_changes_nothing_and_an_overtaken_one_starts_again(spark, gl, monkeypatch):
    store, path = gl
    r = random.Random(3)
    INC.append_to_fact(spark.createDataFrame(postings(r, months(2)), GL), path)
    store.refresh(path)
    INC.append_to_fact(spark.createDataFrame(postings(r, months(2)), GL), path)
    plain = VS.commit

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(VS, "commit", lost)
    held = rows(store.read())
    with pytest.raises(RuntimeError):
        store.refresh(path)
    assert rows(store.read()) == held != full(spark, path)

    def overtaken(*args):
        monkeypatch.setattr(VS, "commit", plain)
        INC.Store(spark, store.root.rsplit("/kept/", 1)[0], "agg_gl_filtered").refresh(path)
        return plain(*args)

    monkeypatch.setattr(VS, "commit", overtaken)
    assert store.refresh(path) == INC.Change()  # the other one has done it
    assert rows(store.read()) == full(spark, path)


def test_vacuum_keeps_what_is_named(spark, gl):
    store, path = gl
    r = random.Random(4)
    for k in range(5):
        INC.append_to_fact(spark.createDataFrame(postings(r, months(6)[k:k + 2], 20), GL), path)
        store.refresh(path)
    assert store.vacuum(keep=1) == []  # each version still holds a month's sums
    INC.append_to_fact(spark.createDataFrame(postings(r, months(6), 100), GL), path)
    store.refresh(path)
    gone = store.vacuum(keep=1)
    assert len(gone) == 5 and rows(store.read()) == full(spark, path) and store.vacuum(keep=1) == []
    assert spark.read.parquet(path).select(F.count_distinct("month_start")).first()[0] == 6
