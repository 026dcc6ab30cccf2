import random

from helpers import WORD

from lakeviews.llm import licenses, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def counted(text):
    w = WORD.findall(text)
    grams = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_metrics_by_brute_force(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(["a", "b", "c#", "é|", "line\nbreak", "x\n"]) for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += ["a b c d e f g h " * 9, "", "\n\n\n", "same\nsame\n same\nsame"]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    for row in quality_rules.metrics(docs).collect():
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == counted(texts[row.doc_id])


def test_thresholds_follow_the_source(spark):
    """A source whose texts are full of symbols keeps its usual texts; a plain source rejects such a text."""
    plain, marked = "some plain words go here and on " * 1, "a | b | c | d"
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(300):
        r = random.Random(i)
        body = " ".join(r.choice(words) for _ in range(40))
        rows.append((i, f"{plain} {body}", "en", "plain", 0))
        rows.append((1000 + i, " | ".join(body.split()), "en", "tables", 0))
    rows.append((5000, " | ".join(r.choice(words) for _ in range(40)) + marked, "en", "plain", 0))
    kept = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert not kept[5000] and sum(kept.values()) == 600


def test_whole_texts_and_lines(spark):
    mit = licenses.KNOWN["MIT"][-1]
    rows = [(1, mit), (2, "Copyright (c) 2020 Somebody\n" + mit.upper().replace(",", " ,")), (3, "words\nreleased under the MIT licence!\nmore"),
            (4, mit + " and more"), (5, None), (6, "released  under\tthe MIT License"), (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC-BY-NC 4.0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.license, r.line_licenses, r.n_notices) for r in licenses.scan(docs).collect()}
    assert got[1][0] == got[2][0] == got[6][0] == "MIT"
    assert got[3] == (None, "MIT", 1) and got[4][0] is None and got[5] == (None, "", 0) and got[7] == (None, "CC-BY-NC-4.0", 2)


def rewrapped(text, r, wide=60):
    """The words again, a few a line, each line with a mark in front."""
    words, lines = text.split(), []
    while words:
        n = r.randint(1, max(1, wide // 8))
        lines.append("  # " + " ".join(words[:n]))
        words = words[n:]
    return "\n".join(lines)


def test_every_known_text_is_named_however_it_is_set(spark):
    r = random.Random(5)
    rows, want = [], {}
    for name, text in licenses.known_texts():
        for body in (text, text.upper(), rewrapped(text, r), "Copyright (c) 2021 Some Body\nAll rights reserved.\n\n" + text.replace(",", " ;")):
            rows.append((len(rows), body))
            want[len(rows) - 1] = name
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {x.doc_id: (x.license, x.line_licenses.split(",")) for x in licenses.scan(docs).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert all(want[k] in v[1] for k, v in got.items())
    titled = {x for name, x in licenses.known_texts() if name == "MIT" and len(x.split()) > 60}
    assert {x.split("\n")[0] for x in titled if "\n" in x} == set(licenses.TITLES["MIT"])


def test_notices_broken_over_lines_inside_longer_texts(spark):
    r = random.Random(6)
    prose = ["some words that go on", "the license of the town", "", "permission is a word", "licensed under the bridge"]
    rows, want = [], {}
    for name, text in licenses.known_texts():
        before, after = ("\n".join(r.choice(prose) for _ in range(r.randint(1, 5))) for _ in range(2))
        rows.append((len(rows), f"{before}\n{rewrapped(text, r)}\n{after}"))
        want[len(rows) - 1] = name
    rows.append((len(rows), "\n".join(prose * 3)))
    rows.append((len(rows), "Released under\nthe MIT License. And more on this line"))
    got = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(want[k] in got[k].line_licenses.split(",") and got[k].license is None for k in want)
    assert got[len(rows) - 2].n_notices == got[len(rows) - 1].n_notices == 0


def test_long_licences_by_digest_alone(spark):
    import os

    import pytest

    folder = "/usr/share/common-licenses"  # public texts, where the system has them
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not os.path.isdir(folder):
        pytest.skip("no licence texts here")
    r = random.Random(7)
    rows = []
    for k, (name, file) in enumerate(files.items()):
        with open(f"{folder}/{file}", encoding="utf-8", errors="replace") as f:
            text = f.read()
        lines = text.split("\n")
        cut = next(i for i, x in enumerate(lines) if x.strip()) + 1
        # as it is, in capitals and without its title; and inside a longer text
        rows += [(10 * k, text, name), (10 * k + 1, text.upper().replace(",", " ,"), name), (10 * k + 2, "\n".join(lines[cut:]), name),
                 (10 * k + 3, "our own words\n" + "\n".join(x + " " * r.randint(0, 3) for x in lines) + "\nand ours again", None)]
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    got = {x.doc_id: x for x in licenses.scan(docs).collect()}
    for k, _, name in rows:
        assert got[k].license == name
        assert list(files)[k // 10] in got[k].line_licenses.split(",") or k % 10 < 3


def test_sql_of_licences_inside_texts(spark):
    """The SQL finds the same runs of lines as the joins."""
    import duckdb

    r = random.Random(8)
    texts = [rewrapped(x, r) for _, x in licenses.known_texts() if len(x.split()) < 30]
    rows = [(i, "\n".join(r.choice(texts + ["plain words", "", "the end"]) for _ in range(r.randint(0, 6)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(x) for x in licenses.scan(frame).collect())
    con = duckdb.connect()
    documents = frame.toPandas()  # noqa: F841  read by name
    want = sorted(con.sql(f"SELECT doc_id, digest, license, line_licenses, n_notices FROM ({licenses.op10_sql()})").fetchall())
    assert [repr(x) for x in got] == [repr(x) for x in want] and sum(x[4] for x in got) > 60
