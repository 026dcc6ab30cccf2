import json

import corpus_pipeline
from helpers import SMALL

from lakeviews.llm import secrets


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, at = docs.columns, docs
    from lakeviews.llm.common import save

    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        at = save(stage(spark, at, SMALL), "pipeline-test")
        counts.append(at.count())
        if name == "secret scans":
            assert counts[-1] == counts[-2]
            assert all(not secrets.base_spans(r.text) for r in at.collect())
        if name != "mixing sources":
            assert at.columns == columns
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[-1] > 0
    assert at.filter("copies < 1").count() == 0


def test_rejected_documents_are_poor(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).select("doc_id").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    poor = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(poor) <= 0.7 * len(poor), json.dumps([sum(good), len(good), sum(poor), len(poor)])
