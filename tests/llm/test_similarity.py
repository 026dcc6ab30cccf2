"""The Jaccard join, decontamination and suffix removal against brute force."""

import hashlib
import random
from collections import Counter

from helpers import MEDIUM, documents, shingles

from lakeviews.llm import decontamination, jaccard_join, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def joined_by_brute_force(texts):
    sets = [shingles(t) for t in texts]
    links, label = [0] * len(texts), list(range(len(texts)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                label[y] = x
    return links, [top(i) for i in range(len(texts))]


def test_join_of_documents(spark):
    docs = documents(MEDIUM)
    links, label = joined_by_brute_force([t for _, t, _, _ in docs])
    got = {r.doc_id: r for r in jaccard_join.op6_jaccard_join(spark, MEDIUM).collect()}
    assert len(got) == len(docs) and sum(links) > 50
    for (doc_id, *_), n, root in zip(docs, links, label):
        assert (got[doc_id].n_links, got[doc_id].class_id) == (n, docs[root][0])


def test_join_of_large_groups(spark, monkeypatch):
    """Groups above the leaf and block sizes: near copies of one text, and texts that share a passage."""
    for name, value in (("LEAF", 16), ("BLOCK", 10)):
        monkeypatch.setattr(jaccard_join, name, value)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    base, passage = [word() for _ in range(120)], " ".join(word() for _ in range(30))
    texts = []
    for i in range(90):
        w = list(base)
        w[r.randrange(len(w))] = word()
        if i % 3 == 0:
            w[r.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [" ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(40)) for _ in range(80)]
    texts += texts[:7] + texts[100:104]
    links, label = joined_by_brute_force(texts)
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in jaccard_join.join(docs).collect()}
    missed = sum(links) - sum(r.n_links for r in got.values())
    assert 0 <= missed <= 0.002 * sum(links)
    assert [got[i].class_id for i in range(len(texts))] == label
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(docs).collect()) == sorted(set(label))


def test_leaks(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    bench = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    texts = {d: t for d, t, _, _ in documents(MEDIUM)}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()}
    assert want and want <= got and len(got - want) <= 0.05 * len(want) + 1
    kept = {r.doc_id for r in decontamination.clean(docs, bench).collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_search_finds_what_brute_force_finds(spark):
    """All items at or above the threshold in all passages, scored one by one."""
    import numpy as np

    from lakeviews.llm import bytewords as bw

    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(1, 4))) for _ in range(400)]
    items = [" ".join(r.choice(vocabulary) for _ in range(r.randint(8, 60))) for _ in range(40)]
    texts = []
    for _ in range(30):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 300))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(w))
            w[at:at] = r.choice(items).split()
        texts.append(" ".join(w))
    raw = "".join(texts).encode()
    offs = np.cumsum([0] + [len(t.encode()) for t in texts])
    words = bw.words(np.frombuffer(raw, np.uint8), offs, bw.PUNCTUATION, lower=True)
    found = 0
    for index in decontamination.indexes(list(enumerate(items))):
        got = {(int(row), int(word), int(k)) for row, word, k, _ in zip(*index.search(words))}
        want = set()
        for row in range(len(texts)):
            lo, hi = words.first[row], words.first[row + 1]
            for p in range(lo, hi, index.half):
                terms = np.unique(words.hash[p:min(hi, p + 2 * index.half)])
                at = np.searchsorted(index.terms, terms)
                at = at[(at < len(index.terms)) & (index.terms[np.minimum(at, len(index.terms) - 1)] == terms)]
                score = index.impact[at].sum(0)
                want |= {(row, p, int(k)) for k in np.flatnonzero(score >= decontamination.THRESHOLD)}
        assert got == want
        found += len(got)
    assert found > 20


def removed_by_brute_force(texts, window):
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + window] for b in bodies for i in range(len(b) - window + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def suffix_texts():
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(2, 6)))
    passages = [" ".join(word() for _ in range(r.randint(60, 220))) for _ in range(4)]
    texts = [None, "", "short", passages[0], passages[0]]
    for _ in range(40):
        parts = [r.choice([r.choice(passages), " ".join(word() for _ in range(r.randint(0, 80)))]) for _ in range(r.randint(1, 4))]
        text = " ".join(parts)
        if r.random() < 0.3:
            at = r.randrange(len(text) + 1)
            text = text[:at] + "#" + text[at:]
        texts.append(text)
    return texts + ["z" * 1500, "ab" * 700, "line of text\n" * 60, texts[9]]


def test_suffixes(spark):
    texts = suffix_texts()
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removed(docs.repartition(5)).collect()}
    want = removed_by_brute_force(texts, suffix_dedup.WINDOW)
    assert [got[i] for i in range(len(texts))] == want and sum(x[2] for x in want) > 30


def test_suffixes_of_large_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LARGE", 3)
    texts = suffix_texts()
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removed(docs.repartition(5)).collect()}
    assert [got[i] for i in range(len(texts))] == removed_by_brute_force(texts, suffix_dedup.WINDOW)


def test_suffixes_of_documents(spark):
    docs = documents(MEDIUM)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op9_suffix_dedup(spark, MEDIUM).collect()}
    assert [got[d] for d, *_ in docs] == removed_by_brute_force([t for _, t, _, _ in docs], suffix_dedup.WINDOW)


def test_loser_tree_merges_front_coded_runs():
    r = random.Random(7)
    for _ in range(500):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 7))]
        out = list(suffix_dedup.merged([suffix_dedup.front_coded(x) if x else ([], []) for x in runs]))
        assert [s for _, s, _, _ in out] == sorted(s for x in runs for s in x)
        assert all(runs[run][place] == s for _, s, run, place in out)
        assert all(y[0] == suffix_dedup.common(x[1], y[1]) for x, y in zip(out, out[1:]))
