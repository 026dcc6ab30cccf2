"""run() against the five stages restated plainly, one on what the other kept."""

import math
import re

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import pytest
from helpers import SMALL, documents
from test_similarity import joined_by_brute_force

from lakeviews.llm import decontamination as dc
from lakeviews.llm import mixing, quality_model, secrets
from lakeviews.llm.common import table
from lakeviews.llm.training import labelled


def quality_kept(rows, net):
    """Gated attention, a passage at a time."""
    def one(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        x, _ = quality_model.vectors(raw, np.array([0, len(raw)]))
        p, parts = net.p, []
        for v in x:
            h = np.tanh(np.clip((v - p["mean"]) / p["spread"], -8, 8) @ p["W"] + p["b"])
            gate = 1 / (1 + np.exp(-(h @ p["U"])))
            parts.append((math.exp(float((np.tanh(h @ p["V"]) * gate) @ p["w"])), h))
        total = sum(e for e, _ in parts)
        z = sum((e / total * h for e, h in parts), np.zeros(len(p["c"])))
        return 1 / (1 + math.exp(-float(z @ p["c"] + p["c0"][0])))
    return [r for r in rows if one(r[1]) >= 0.3]


def one_of_each(rows):
    rows = sorted(rows)
    _, label = joined_by_brute_force([r[1] for r in rows])
    return [r for i, r in enumerate(rows) if label[i] == i]


WORDS = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORDS.findall(text or "")]


def without_items(rows, items):
    """BM25 of every passage against every item, then the overlaps; short items aren't among these."""
    tests = [words(t) for t in items if t]
    assert all(len(set(t)) >= dc.LEAST for t in tests)
    by_half = {}
    for t in tests:
        half = dc.SHORTEST
        while half < len(t):
            half *= 2
        by_half.setdefault(half, []).append(t)

    def overlap(part, of):
        return len(set(part) & set(of)) / len(set(part)) if part else 1.0

    def leaks(text):
        w = words(text)
        for half, group in by_half.items():
            mean, n = sum(map(len, group)) / len(group), len(group)
            holds = {x: sum(x in set(t) for t in group) for t in group for x in t}
            for t in group:
                impact = {}
                for x in set(t):
                    tf = t.count(x)
                    idf = math.log(1 + (n - holds[x] + 0.5) / (holds[x] + 0.5))
                    impact[x] = idf * tf * (dc.K1 + 1) / (tf + dc.K1 * (1 - dc.B + dc.B * len(t) / mean))
                own, cut = sum(impact.values()), len(t) - max(1, len(t) // 4)
                for at in range(0, len(w), half):
                    if sum(impact.get(x, 0) for x in set(w[at:at + 2 * half])) / own < dc.THRESHOLD:
                        continue
                    around = w[max(0, at - len(t)):at + 2 * half + len(t)]
                    if overlap(list(zip(t[:cut], t[1:cut])), list(zip(around, around[1:]))) >= dc.QUESTION and overlap(t[cut:], around) >= dc.ANSWER:
                        return True
        return False

    return [r for r in rows if not leaks(r[1])]


def masked(rows, model):
    out = []
    for doc_id, text, *rest in rows:
        base, learned = secrets.spans_of(text or "", model)
        spans = sorted([(s, e) for s, _, e, _ in base] + [(s, e) for s, _, e, _ in learned])
        merged = []
        for s, e in spans:
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        for s, e in reversed(merged):
            text = text[:s] + "[secret]" + text[e:]
        out.append((doc_id, text, *rest))
    return out


def mixed(rows):
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"])  # noqa: F841  read by name
    sql = mixing.OP1_SQL.replace("(d.size * (full_takes", "((full_takes").replace("::BIGINT AS taken", "::BIGINT AS copies")
    taken = dict(duckdb.sql(f"SELECT doc_id, copies FROM ({sql})").fetchall())
    return sorted((d, t, taken[d]) for d, t, *_ in rows if taken[d] > 0)


@pytest.fixture(scope="module")
def plain(spark):
    net = quality_model.fit(labelled(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"), "quality"))
    stages = [documents(SMALL)]
    stages.append(quality_kept(stages[-1], net))
    stages.append(one_of_each(stages[-1]))
    stages.append(without_items(stages[-1], [r.text for r in table(spark, SMALL, "benchmark").collect()]))
    kept = spark.createDataFrame([r[:2] for r in stages[-1]], "doc_id long, text string")
    stages.append(masked(stages[-1], secrets.infer(kept)))
    return stages, mixed(stages[-1])


def test_run_equals_the_plain_chain(spark, plain):
    stages, want = plain
    got = sorted((r.doc_id, r.text, r.copies) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want


def test_every_stage_equals_its_plain_form(spark, plain):
    stages, _ = plain
    docs = table(spark, SMALL, "documents")
    assert [len(s) for s in stages][0] > len(stages[1]) > len(stages[2]) >= len(stages[3]) == len(stages[4])
    assert len(stages[2]) > len(stages[3])
    for (name, stage), want in zip(corpus_pipeline.STAGES[:4], stages[1:]):
        docs = corpus_pipeline.save(stage(spark, docs, SMALL), "chain")
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(r[:2] for r in want), name
