"""Held-out accuracy of the classifiers and language identification."""

import zlib

import pytest
from helpers import documents

from lakeviews.llm import language, quality_model, toxicity

DIR = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def auc(pairs):
    pairs = sorted(pairs)
    positives = sum(y for _, y in pairs)
    below = rank = 0.0
    i = 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        p = sum(y for _, y in pairs[i:j])
        rank += p * (below + (j - i - p) / 2)
        below += j - i - p
        i = j
    return rank / positives / below


@pytest.mark.parametrize("query, label, least_auc, least", [
    (toxicity.op3_toxicity, "toxic", 0.8, 0.93), (quality_model.op7_quality_model, "quality", 0.85, 0.9)])
def test_classifiers(spark, query, label, least_auc, least):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    rows = query(spark, DIR).collect()
    assert len(rows) == 10_000 and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    known = [(r.score, truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert auc([(s, y) for s, y, _ in known]) >= least_auc
    assert sum(y == p for _, y, p in known) >= least * len(known)


def test_language(spark):
    truth = {d: lang for d, _, lang, _ in documents(DIR)}
    rows = [r for r in language.op4_language(spark, DIR).collect()]
    assert len(rows) == 10_000 and all(r.held_out == held(r.doc_id) for r in rows)
    known = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in known) >= 0.97 * len(known)


def test_segmentations_are_summed():
    import numpy as np

    listed = sorted({b" a", b"b", b"ab", b" ab", b"a", b" ", *(bytes([b]) for b in range(256))})
    vocabulary = language.Vocabulary(listed)
    p = np.zeros((len(listed) + 1, 1))
    for piece, value in ((b" a", 0.1), (b"b", 0.2), (b"ab", 0.05), (b" ab", 0.3), (b"a", 0.15), (b" ", 0.01)):
        p[listed.index(piece), 0] = value
    raw = np.frombuffer(b" ab", np.uint8)
    got = np.exp(language.log_probability(vocabulary, p, raw, np.array([0]), np.array([3])))[0, 0]
    assert abs(got - (0.3 + 0.1 * 0.2 + 0.01 * 0.05 + 0.01 * 0.15 * 0.2)) < 1e-12
    counts = language.expected(vocabulary, p[:, 0], raw, np.array([0]), np.array([3]), np.array([2]))
    assert abs(counts[listed.index(b" ab")] - 2 * 0.3 / got) < 1e-9
    assert abs(counts[listed.index(b"b")] - 2 * (0.1 * 0.2 + 0.01 * 0.15 * 0.2) / got) < 1e-9


def test_attention_gradient():
    import numpy as np

    r = np.random.RandomState(0)
    x, bags, y = r.normal(size=(9, quality_model.WIDTH)), np.array([0, 3, 3, 9]), np.array([1.0, 0.0, 0.0])
    net = quality_model.Attention.start(x)

    def loss():
        p = 1 / (1 + np.exp(-net.forward(x, bags)[0]))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, g in net.gradient(x, bags, y).items():
        at = tuple(0 for _ in g.shape)
        old = net.p[name].copy()
        net.p[name] = old.copy()
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        down = loss()
        net.p[name] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6
