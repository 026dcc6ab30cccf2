"""Held-out recall of the toxicity classifier by language: markers that few rows hold count too."""

from helpers import documents

from lakeviews.llm import toxicity

DIR = "/root/testdata/sf0.1"


def test_rare_markers_are_learned(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    lang = {d: known for d, _, known, _ in documents(DIR)}
    rows = [r for r in toxicity.op3_toxicity(spark, DIR).collect() if r.held_out and truth.get(r.doc_id) is not None]
    caught = {"en": [], "other": []}
    for r in rows:
        if truth[r.doc_id] == 1:
            caught["en" if lang[r.doc_id] == "en" else "other"].append(r.predicted)
    clean = [r.predicted for r in rows if truth[r.doc_id] == 0]
    assert sum(caught["en"]) >= 0.85 * len(caught["en"])
    assert sum(caught["other"]) >= 0.5 * len(caught["other"]), caught["other"]
    assert sum(clean) <= 0.01 * len(clean)
