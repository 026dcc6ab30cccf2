"""Passages of 51 words or more that another document holds too are counted, whether or not they have 400 bytes."""

import random
from collections import defaultdict

import pytest

from lakeviews.llm import suffix_dedup

L = suffix_dedup.PASSAGE


def prose(r, n):
    return [f"{r.choice('abcdefgh')}{r.randrange(9_999)}" for _ in range(n)]


def counted(docs):
    """By brute force, of {doc_id: text}: words in windows of ``L`` words that another document has."""
    words = {d: t.split() for d, t in docs.items()}
    held = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - L + 1):
            held[tuple(w[i:i + L])].add(d)
    return {d: len({j for i in range(len(w) - L + 1) if len(held[tuple(w[i:i + L])]) > 1 for j in range(i, i + L)}) for d, w in words.items()}


def found(spark, docs, parts=3):
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(parts)
    return {x.doc_id: x.n_passage_words for x in suffix_dedup.removed(rows).collect()}


def test_passages_below_the_removed_size(spark):
    r = random.Random(51)
    text = lambda *parts: " ".join(" ".join(p) for p in parts)
    shared, short, own = prose(r, 51), prose(r, 50), prose(r, 60)
    rows = [(1, text(prose(r, 70), shared, prose(r, 30))), (2, text(prose(r, 9), shared)),
            (3, text(prose(r, 70), short, prose(r, 30))), (4, text(short, prose(r, 80))),
            (5, text(own, prose(r, 20), own)), (6, text(prose(r, 200))),
            (7, text(own[:5])), (7, text(own[:5])), (8, None), (9, ""),
            (10, "\n".join([*prose(r, 3), *shared])), (11, text(prose(r, 100))), (12, text(prose(r, 100)))]
    rows += [(11, rows[-2][1]), (13, rows[-1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.removed(docs.repartition(4)).collect()
    assert len(" ".join(shared)) < suffix_dedup.WINDOW
    assert len(got) == len(rows) and all(x.n_removed == 0 for x in got if x.doc_id in (1, 2, 3, 4, 10))
    # 5 repeats only itself, 11 is there twice as one document, 12 and 13 are copies
    assert {x.doc_id: x.n_passage_words for x in got} == {1: 51, 2: 51, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0, 8: 0, 9: 0, 10: 51, 11: 0, 12: 100, 13: 100}


@pytest.mark.parametrize("chunk", [None, 2_000])
def test_passages_as_by_brute_force(spark, monkeypatch, chunk):
    if chunk:  # texts above 4,000 bytes are taken in pieces
        monkeypatch.setattr(suffix_dedup.bw, "CHUNK", chunk)
        monkeypatch.setattr(suffix_dedup.bw.chunks, "__defaults__", (chunk,))
    r = random.Random(7)
    pool = [prose(r, r.randrange(20, 200)) for _ in range(12)]
    docs = {}
    for d in range(60):
        parts = []
        for _ in range(r.randrange(1, 9)):
            p = r.choice(pool)
            a = r.randrange(len(p) // 2)
            parts += r.choice([p, p[a:], p[:-a or None], prose(r, r.randrange(80)), p + p])
        docs[d] = " ".join(parts)
    docs[60], docs[61], docs[62] = docs[5], " ".join(pool[0][:4] * 40), "x" * 9_000 + " " + " ".join(pool[1] + pool[2])
    if chunk:
        batch = suffix_dedup.pa.RecordBatch.from_pydict({"rid": [62], "size": [len(docs[62])], "text": [docs[62]]})
        windows = [x for b in suffix_dedup._word_anchored([batch]) for f, t in zip(*(b.column(c).to_pylist() for c in ("first", "last"))) for x in range(f, t + 1)]
        assert sorted(windows) == list(range(len(docs[62].split()) - L + 1))
    assert found(spark, docs) == counted(docs)
