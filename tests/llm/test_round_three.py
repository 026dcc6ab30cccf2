"""Long texts in bounded memory, short common items, item ids of any kind, large benchmarks."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from helpers import MEDIUM
from pyspark.sql import functions as F

from lakeviews.llm import decontamination, suffix_dedup


def prose(r, n, words):
    return " ".join(r.choice(words) for _ in range(n))


def test_anchors_of_a_long_text_take_memory_in_proportion():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(5_000)]
    text = prose(r, 800_000, words)[:5_000_000]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([len(text)]), pa.array([text])], ["rid", "size", "text"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in suffix_dedup._anchored([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 20_000
    assert peak < 100 << 20, peak  # bytes; 1,000 times the text's 5 MB before


def test_long_repeats_are_removed_across_pieces(spark, monkeypatch):
    from test_similarity import removed_by_brute_force

    monkeypatch.setattr(suffix_dedup.bw, "CHUNK", 3_000)
    monkeypatch.setattr(suffix_dedup.bw.chunks, "__defaults__", (3_000,))
    r = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    shared = prose(r, 700, words)
    texts = [prose(r, 3_000, words) + shared + prose(r, 50, words), shared[100:] + prose(r, 4_000, words), prose(r, 900, words), "x" * 9_000, shared]
    rows = [(i, t, len(t.encode()), t) for i, t in enumerate(texts)]
    got = {}
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows]), pa.array([x[2] for x in rows]), pa.array(texts)], ["rid", "size", "text"])
    for b in suffix_dedup._anchored([batch]):
        for x in b.to_pylist():
            got.setdefault(x["rid"], []).append((x["first"], x["last"]))
    for k, t in enumerate(texts):  # every string of WINDOW bytes has one context
        starts = sorted(s for first, last in got[k] for s in range(first, last + 1))
        assert starts == list(range(len(t) - suffix_dedup.WINDOW + 1))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.removed(docs).collect()}
    assert [out[i] for i in range(len(texts))] == removed_by_brute_force(texts, suffix_dedup.WINDOW)


def test_common_short_items_drop_no_document(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    bench = spark.createDataFrame([(1, "the"), (2, "Paris"), (3, "de la"), (4, "x y")], "item_id int, text string")
    assert decontamination.clean(docs, bench).count() == docs.count()
    listed = decontamination.leaks(docs, bench)
    assert dict(listed.dtypes)["item_id"] == "int"
    the = listed.filter("item_id = 1").count()
    assert the == docs.filter(F.col("text").rlike(r"(?i)(^|[\x00-\x7f&&[^a-z0-9]])the($|[\x00-\x7f&&[^a-z0-9]])")).count() > 100


def test_rare_short_items_still_drop_documents(spark):
    docs = spark.createDataFrame([(i, "some words" if i % 50 else f"so: who is it? Ada! {i}") for i in range(1_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Who is it? Ada."), (2, "some words")], "item_id long, text string")
    kept = {x.doc_id for x in decontamination.clean(docs, bench).collect()}
    assert kept == {i for i in range(1_000) if i % 50}  # 20 documents are few; the 980 others hold a common item


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string", "double", "decimal(9,0)", "date"])
def test_item_ids_of_any_kind(spark, kind):
    item = " ".join(f"token{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"before {item} after")], "doc_id int, text string")
    one = "date '2024-01-05'" if kind == "date" else "5"
    bench = spark.sql(f"SELECT CAST({one} AS {kind}) AS item_id, '{item}' AS text")
    got = decontamination.leaks(docs, bench)
    assert dict(got.dtypes)["item_id"] == kind and dict(got.dtypes)["doc_id"] == "int"
    assert [x.item_id for x in got.collect()] == [x.item_id for x in bench.collect()]


@pytest.mark.parametrize("items_a_pass, scans", [(decontamination.PASS, 1), (1_700, 3)])
def test_many_items_take_one_scan(spark, monkeypatch, items_a_pass, scans):
    monkeypatch.setattr(decontamination, "PASS", items_a_pass)
    r = random.Random(6)
    words = [f"term{i}" for i in range(3_000)]
    items = [prose(r, r.randint(12, 40), words) for _ in range(5_000)]
    rows = [(i, f"{prose(r, 40, words)} {items[i * 9]} {prose(r, 30, words)}") for i in range(60)] + [(100 + i, prose(r, 90, words)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)) + [(9_999, items[0])] * 3, "item_id long, text string")
    found = decontamination.leaks(docs, bench)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == scans
    got = {(x.doc_id, x.item_id) for x in found.collect()}
    assert got >= {(i, i * 9) for i in range(60)} | {(0, 9_999)} and not any(d >= 100 for d, _ in got)
