"""Nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables, for every operator."""

import pytest
from helpers import ODD, labels, odd_docs

from lakeviews.llm import (decontamination, fill_middle, jaccard_join, language, licenses, line_dedup, mixing, periodic_runs,
                           quality_model, quality_rules, secrets, suffix_dedup, toxicity)


def bench(spark, rows=((1, "one two three four five six seven eight"), (2, None), (3, "the"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def some_labels(spark):
    return labels(spark, [(4, 1, 0), (6, 0, 1), (7, 1, 1), (7, 0, 0), (9, None, None), (None, 1, 1), (12, 1, 0)])


PER_DOCUMENT = {
    "mix": lambda s, d: mixing.mix(d),
    "toxicity": lambda s, d: toxicity.classify(d, some_labels(s)),
    "toxicity without labels": lambda s, d: toxicity.classify(d, labels(s, [])),
    "language": lambda s, d: language.predict(d, language.learn(d)),
    "secrets": lambda s, d: secrets.scan(d),
    "redacted": lambda s, d: secrets.redact(d),
    "join": lambda s, d: jaccard_join.join(d),
    "quality": lambda s, d: quality_model.classify(d, some_labels(s)),
    "quality without labels": lambda s, d: quality_model.classify(d, labels(s, [])),
    "rules": lambda s, d: quality_rules.judge(d),
    "suffixes": lambda s, d: suffix_dedup.removed(d),
    "licenses": lambda s, d: licenses.scan(d),
    "fill in middle": lambda s, d: fill_middle.restore(fill_middle.fill_in_middle(d)),
    "runs": lambda s, d: periodic_runs.runs(periodic_runs.planted(d)),
    "lines": lambda s, d: line_dedup.without_shared_lines(d),
    "lines by join": lambda s, d: line_dedup.without_shared_lines(d, least_docs=2, most_keys=0),
}
OTHERS = {
    "leaks": lambda s, d: decontamination.leaks(d, bench(s)),
    "leaks of nothing": lambda s, d: decontamination.leaks(d, bench(s, [])),
    "clean": lambda s, d: decontamination.clean(d, bench(s)),
    "one of each": lambda s, d: jaccard_join.one_of_each(d),
    "accepted": lambda s, d: quality_model.accepted(d, None),
    "taken": lambda s, d: mixing.taken_documents(d),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(spark, name):
    rows = PER_DOCUMENT[name](spark, odd_docs(spark)).collect()
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)
    assert ids == sorted((r[0] is not None, r[0] or 0) for r in ODD)


@pytest.mark.parametrize("name", [*PER_DOCUMENT, *OTHERS])
def test_empty_tables(spark, name):
    assert {**PER_DOCUMENT, **OTHERS}[name](spark, odd_docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["clean", "accepted", "taken", "one of each"])
def test_filters_keep_columns(spark, name):
    docs = odd_docs(spark)
    out = OTHERS[name](spark, docs)
    assert [c for c in out.columns if c != "mix_copies"] == docs.columns
    kept = out.collect()
    assert 0 < len(kept) <= len(ODD)
    if name in ("clean", "accepted"):
        assert len(kept) == len(ODD)


def test_one_of_each_drops_only_the_repeated_row(spark):
    kept = jaccard_join.one_of_each(odd_docs(spark)).collect()
    assert len(kept) == len(ODD) - 1


def test_defined_values(spark):
    docs = odd_docs(spark)
    und = {r.doc_id: (r.lang_pred, r.score) for r in PER_DOCUMENT["language"](spark, docs).collect() if r.doc_id in (1, 2, 3, 5)}
    assert set(und.values()) == {("und", 0.0)}
    empty = [r for r in secrets.scan(docs).collect() if r.doc_id == 1][0]
    assert (empty.n_assign, empty.n_hex, empty.spans) == (0, 0, "") and empty.base_sha256.startswith("e3b0c442")
    failed = {r.doc_id: r.base_failed for r in quality_rules.judge(docs).collect()}
    assert failed[1] and failed[2]
    joined = {(r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(docs).collect()}
    assert (7, 7, 1) in joined and (7, 7, 0) in joined and (1, 1, 0) in joined and (None, None, 0) in joined
    whole = {r.doc_id: r for r in suffix_dedup.removed(docs).collect()}
    assert (whole[6].n_removed, whole[6].n_spans) == (whole[6].n_bytes, 1) and whole[8].n_removed == 3000 and whole[4].n_removed == 0
    none = licenses.scan(docs).collect()
    assert {r.digest for r in none if r.doc_id in (1, 2, 3, 5)} == {None}
