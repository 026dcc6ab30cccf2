"""Learned spans: tokens of the labelled formats where no base pattern sees them, at few labels and at many."""

import random

import pytest
from helpers import MEDIUM

from lakeviews.llm import secrets

HEX, UPPER = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def corpus(spark, labels):
    """Documents that label so many credentials; the table is made by Spark from the number."""
    r = random.Random(labels)
    seeds = [(i, "".join(r.choice(HEX) for _ in range(18)), "".join(r.choice(UPPER) for _ in range(16))) for i in range(min(labels, 4_000))]
    base = spark.createDataFrame(seeds, "k int, hex string, key string")
    times = max(1, labels // len(seeds))
    many = base.crossJoin(spark.range(times).withColumnRenamed("id", "t"))
    # digits and letters of each copy are turned by its number, so that credentials differ
    turned = f"translate(hex, '{HEX}', concat(substring('{HEX}', int(t % 16) + 1, 16), substring('{HEX}', 1, int(t % 16))))"
    return many.selectExpr("k * 100000 + t AS doc_id", f"concat('words here password=', {turned}, ' and a key AKIA', key, ' end') AS text")


def planted(r, n):
    """Texts with one token each that no base pattern matches, and where it stands."""
    out = []
    for i in range(n):
        token = "".join(r.choice(HEX) for _ in range(r.randint(18, 23))) if i % 2 else r.choice(["ASIA", "AROA"]) + "".join(r.choice(UPPER) for _ in range(16))
        if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
            continue
        head = "some plain words and then "
        out.append((head + token + r.choice([" more", ".", ", and", ""]), (len(head), len(head) + len(token))))
    return out


def ordinary(r, n):
    words = "release notes version update house garden river mountain configuration parser index about the".split()
    shapes = [lambda: "-".join(r.choice(words) for _ in range(4)) + f"-{r.randint(1, 99)}", lambda: f"/{r.choice(words)}/{r.choice(words)}/2024/{r.choice(words)}.html",
              lambda: f"{r.choice(words)}_{r.choice(words)}_v{r.randint(1, 9)}", lambda: "".join(r.choice(words) for _ in range(3)), lambda: f"mail{r.randint(0, 9)}.{r.choice(words)}.com"]
    return [f"see {r.choice(shapes)()} and {r.choice(shapes)()}" for _ in range(n)]


@pytest.mark.parametrize("labels", [200, 200_000])
def test_planted_tokens_are_found_and_ordinary_words_left(spark, labels):
    model = secrets.infer(corpus(spark, labels))
    assert set(model) == {"assign", "access"}
    r = random.Random(11)
    texts = planted(r, 400)
    found = 0
    for text, (start, end) in texts:
        base, learned = secrets.spans_of(text, model)
        assert not base
        found += any(s == start and e == end for s, _, e, _ in learned)
    assert found >= 0.9 * len(texts), found / len(texts)
    plain = ordinary(r, 1_000)
    wrong = sum(bool(secrets.spans_of(text, model)[1]) for text in plain)
    assert wrong <= 0.01 * len(plain), wrong


def test_few_labels_are_a_parameter_and_a_column(spark):
    docs = corpus(spark, 7)
    assert {x.learned_kinds for x in secrets.scan(docs).collect()} == {"access,assign"}
    none = secrets.infer(docs, least_labelled=8)
    assert none == {} and {x.learned_kinds for x in secrets.scan(docs, none).collect()} == {""}


def test_the_query_enters_the_automata_on_the_given_tables(spark):
    rows = secrets.op5_secrets(spark, MEDIUM).collect()
    assert len({x.learned_kinds for x in rows}) == 1 and rows[0].learned_kinds
    assert sum(x.n_learned for x in rows) <= 0.01 * len(rows)
