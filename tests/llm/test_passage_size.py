"""Passages of over 50 words that two documents share lose their bytes from 400 bytes on, none below."""

import random

from lakeviews.llm import suffix_dedup


def passage(r, words, size):
    """``words`` words in ``size`` bytes."""
    letters = size - words + 1
    lengths = [letters // words + (i < letters % words) for i in range(words)]
    return " ".join("".join(r.choice("abcdefgh") for _ in range(n)) for n in lengths)


def test_shared_passages_by_size(spark):
    r = random.Random(9)
    sizes = [(51, 300), (59, 394), (60, 399), (60, 400), (90, 600)]
    rows = []
    for k, (words, size) in enumerate(sizes):
        shared = passage(r, words, size)
        assert len(shared.split()) == words > 50 and len(shared) == size
        # the bytes beside it differ, so that no longer string is shared
        rows += [(10 * k + i, f"{passage(r, 70, 500)} {edge}{shared}{edge} {passage(r, 80, 500)}") for i, edge in enumerate("[(")]
        rows.append((10 * k + 2, passage(r, 200, 1_400)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_removed, x.n_spans) for x in suffix_dedup.removed(docs.repartition(3)).collect()}
    for k, (_, size) in enumerate(sizes):
        lost = (size, 1) if size >= suffix_dedup.WINDOW else (0, 0)
        assert [got[10 * k + i] for i in range(3)] == [lost, lost, (0, 0)], sizes[k]
