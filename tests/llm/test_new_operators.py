"""Fill-in-the-middle, periodic runs and shared lines against plain restatements."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, SMALL, WORD, documents, odd_docs

from lakeviews.llm import fill_middle, line_dedup, periodic_runs
from lakeviews.llm.common import slices

PAIRS = "doc_id long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# fill in the middle

def test_units_and_cuts_keep_every_character():
    r = random.Random(5)
    texts = ["".join(r.choice("aé漢\n\r <>PSM") for _ in range(r.randint(0, 40))) for _ in range(500)]
    texts += ["", "\n", "\n\n", "a", "a\n", "\na", "<P>x\ny", "end<\n<S\nS>", "x" * 100_000 + "\n" + "y" * 9]
    draws = [np.array([r.randrange(1 << 32) for _ in texts]) for _ in range(4)]
    out = fill_middle.transformed(pa.array(texts), draws)
    back = fill_middle.restored(out.column("output"), out.column("form")).to_pylist()
    assert back == texts
    for text, (h1, h2, _, h4), row in zip(texts, zip(*[d.tolist() for d in draws]), out.to_pylist()):
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
        prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        assert row["n"] == len(units)
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
            assert (row["form"], row["output"], row["prefix_chars"], row["middle_chars"]) == ("plain", text, None, None)
        else:
            want = f"<S>{suffix}<P>{prefix}<M>{middle}" if h4 % 100 < 50 else f"<P>{prefix}<S>{suffix}<M>{middle}"
            assert (row["output"], row["prefix_chars"], row["middle_chars"]) == (want, len(prefix), len(middle))


def test_rate_leaves_texts_plain(spark):
    docs = spark.createDataFrame([(i, f"one {i}\ntwo\nthree") for i in range(400)], PAIRS)
    forms = [r.form for r in fill_middle.fill_in_middle(docs, rate=50, spm=0).collect()]
    assert 130 < forms.count("plain") < 270 and forms.count("spm") == 0 and len(forms) == 400
    assert {r.form for r in fill_middle.fill_in_middle(docs, rate=0).collect()} == {"plain"}


def test_restored_odd_texts(spark):
    docs = odd_docs(spark)
    rows = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    assert sorted(r.restored for r in rows) == sorted(x[1] or "" for x in ODD)
    nothing = [r for r in rows if r.doc_id in (1, 2)]
    assert {(r.n, r.form, r.output) for r in nothing} == {(0, "plain", "")}


def test_slices_cover_all_rows_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (0, 5, 100, 3, 0, 0, 50)] + [None])], ["text"])
    assert pa.Table.from_batches(list(slices(batch, 10))).column("text").to_pylist() == batch.column("text").to_pylist()


# periodic runs

def all_runs(w):
    """Every run by comparing each word with the one q further on."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i + q - a
            smaller = any(all(w[a + k] == w[a + k + d] for k in range(size - d)) for d in range(1, q))
            if size >= max(6, 4 * q) and not smaller:
                out.append((a, size, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(a + q <= i < a + size for a, size, q in runs))


def searched(words):
    search = periodic_runs.Search()
    for at, piece in periodic_runs.stretches(words):
        search.add(0, at, piece)
    return search.runs().get(0, [])


def test_runs_by_brute_force():
    r = random.Random(1)
    for _ in range(1500):
        n, kinds = r.randint(0, 60), r.randint(1, 6)
        w = [r.choice("abcdef"[:kinds]) for _ in range(n)]
        if n and r.random() < 0.7:
            a = r.randrange(n)
            p = 1 + (n - a) // (3 + r.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert searched(w) == all_runs(w), w


def test_tree_agrees_with_words():
    r = random.Random(2)
    s = [r.randint(1, 3) for _ in range(300)]
    depths, place, order, opposite = periodic_runs.SuffixTree(s).tour()
    ended = [*s, 0]
    assert order == sorted(range(301), key=lambda k: ended[k:])
    assert opposite == sorted(range(301), key=lambda k: [-x for x in s[k:]])
    i, j = np.triu_indices(300, 1)
    got = periodic_runs.Depths(depths).least(place[i], place[j])
    for a, b, k in zip(i.tolist(), j.tolist(), got.tolist()):
        assert s[a:a + k] == s[b:b + k] and ended[a + k] != ended[b + k]


def test_long_texts_in_linear_time():
    assert searched(["x"] * 60_000) == [(0, 60_000, 1)]
    assert searched([str(i % 7_001) for i in range(40_000)]) == [(0, 40_000, 7_001)]


def query_by_hand(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = all_runs(w)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, sha("".join(f"{a},{size},{q}\n" for a, size, q in runs)), sha(collapsed(w, runs)))


def test_runs_query(spark):
    texts = {d: t for d, t, _, _ in documents(SMALL)}
    short = {d for d, t in texts.items() if len(WORD.findall(t or "")) <= 800}  # the plain search takes the square of that
    got = {tuple(r) for r in periodic_runs.op12_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(texts) and sum(r[1] > 0 for r in got) > 5
    assert {r for r in got if r[0] in short} == {query_by_hand(d, texts[d]) for d in short}


# shared lines

def without(rows, least_chars=20, least_docs=3):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate({c: c + 32 for c in range(65, 91)})

    def split(text):
        return (text or "").split("\n")

    held = {}
    for k, (_, text) in enumerate(rows):
        for x in {key(line) for line in split(text)}:
            if len(x) >= least_chars:
                held.setdefault(x, []).append(k)
    last = {x: max((rows[k][0] for k in at), key=lambda i: (i is not None, i or 0)) for x, at in held.items() if len(at) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = split(text)
        kept = [line for line in lines if key(line) not in last or last[key(line)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def odd_lines():
    r = random.Random(9)
    pool = [f"line number {i} of the pool, {'ÄÖ' * (i % 3)}" for i in range(40)] + ["short one", "", "   ", "ĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀĀ", "ābcdefghijklmnopqrst"]
    dressed = (lambda x: x, str.upper, lambda x: f" \t{x}\r", lambda x: f"\x0b{x} ")
    rows = [(i, "\n".join(r.choice(dressed)(r.choice(pool)) for _ in range(r.randint(0, 6)))) for i in range(150)]
    return rows + [(x[0], x[1]) for x in ODD] + [(500, pool[0]), (500, f"{pool[0]}\n{pool[0]}\nown"), (None, pool[1]), (501, "z" * 300_000)] + [(600 + i, "z" * 300_000) for i in range(3)]


@pytest.mark.parametrize("bits, keys", [(line_dedup.MOST_BITS, line_dedup.KEYS), (1, 10_000), (1, 0)])
def test_lines_by_brute_force(spark, bits, keys):
    """Also with filters that are full, and with confirmed keys joined instead of broadcast."""
    rows = odd_lines()
    got = line_dedup.without_shared_lines(spark.createDataFrame(rows, PAIRS).repartition(7), most_bits=bits, most_keys=keys)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == without(rows)


def test_filters_add_up_in_any_order():
    r = np.random.RandomState(3)
    bits = line_dedup.SLICE
    docs = [r.randint(0, 1 << 62, 200).astype(np.uint64) for _ in range(12)]
    shared = docs[0][:50]
    docs[7] = np.concatenate([docs[7], shared])

    def pair(parts):
        p = line_dedup.Pair(bits)
        for d in parts:
            p.add(d)
        return p

    whole, merged = pair(docs), line_dedup.Pair(bits)
    for k in (5, 0, 7, 11, 3, 1, 2, 4, 6, 8, 9, 10):
        part = pair([docs[k]])
        merged.merge(part.once, part.twice)
    assert (whole.once == merged.once).all() and (whole.twice == merged.twice).all()
    assert line_dedup.holds(whole.twice, bits, shared).all()
    assert line_dedup.holds(whole.twice, bits, docs[3]).mean() < 0.05
