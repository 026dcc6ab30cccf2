"""Words of any length and script are scored whole, over all their segmentations."""

import math
import random

import numpy as np
import pytest
from helpers import SMALL

from lakeviews.llm import language

TEXTS = {
    "Chinese": "自然语言处理是人工智能领域中的一个重要方向它研究能实现人与计算机之间用自然语言进行有效通信的各种理论和方法融语言学计算机科学数学于一体的科学",
    "Japanese": "吾輩は猫である名前はまだ無いどこで生れたかとんと見当がつかぬ何でも薄暗いじめじめした所でニャーニャー泣いていた事だけは記憶している",
    "Thai": "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอนหรือวรรณยุกต์เช่นเดียวกับภาษาจีนและออกเสียงแยกคำต่อคำเป็นที่ลำบากของชาวต่างชาติ",
}


@pytest.fixture(scope="module")
def vocabulary():
    listed = language.pieces()
    r = np.random.RandomState(4)
    p = r.gamma(0.3, size=(len(listed) + 1, 3)) + 1e-6
    p /= p.sum(0)
    p[-1] = 0
    return listed, language.Vocabulary(listed), p


def by_hand(listed, p, word, lang):
    """The log of the sum over all segmentations of a marked word, by bytes, in logs."""
    number = {x: i for i, x in enumerate(listed)}
    body, reach = b" " + word, max(map(len, listed))
    alpha = [0.0] + [-math.inf] * len(body)
    for j in range(1, len(body) + 1):
        terms = [alpha[i] + math.log(p[number[body[i:j]], lang]) for i in range(max(0, j - reach), j) if body[i:j] in number]
        top = max(terms)
        alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    return alpha[-1]


def scored(vocabulary, p, words):
    raw = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return language.log_probability(vocabulary, p, *language.marked(raw, end - [len(w) for w in words], end))


@pytest.mark.parametrize("name", TEXTS)
def test_words_without_spaces(vocabulary, name):
    listed, v, p = vocabulary
    word = TEXTS[name].encode()
    assert len(word) >= 180
    words = [word, word[:200], (TEXTS[name] * 12).encode(), word[:47], word[:48], b"a", (TEXTS[name] * 3).encode()]
    got = scored(v, p, words)
    for k, w in enumerate(words):
        for lang in range(3):
            assert abs(got[k, lang] - by_hand(listed, p, w, lang)) < 1e-6 * max(1, abs(got[k, lang]))


def test_stretches_of_any_length_agree(vocabulary, monkeypatch):
    listed, v, p = vocabulary
    r = random.Random(1)
    words = [bytes(r.choice(b"abcdeno\xc3\xa9") for _ in range(r.randint(40, 400))) for _ in range(20)]
    whole = scored(v, p, words)
    monkeypatch.setattr(language, "SPANS", 500)
    assert np.allclose(scored(v, p, words), whole, rtol=1e-12)
    monkeypatch.setattr(language, "PLAIN", 8)
    assert np.allclose(scored(v, p, words), whole, rtol=1e-9)


def test_no_piece_of_the_vocabulary_is_dropped(vocabulary):
    import sentencepiece

    v = sentencepiece.SentencePieceProcessor(model_file=language.MODEL)
    plain = {v.id_to_piece(i).replace("▁", " ").encode() for i in range(v.get_piece_size()) if not (v.is_control(i) or v.is_unknown(i) or v.is_byte(i))}
    assert {p for p in plain if p.rfind(b" ") <= 0} <= set(vocabulary[0])


def test_expected_counts_of_long_words_in_logs(vocabulary, monkeypatch):
    listed, v, p = vocabulary
    word = TEXTS["Thai"].encode()[:99]
    raw, start, end = language.marked(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))
    logs = language.expected(v, p[:, 0], raw, start, end, np.array([3]))
    monkeypatch.setattr(language, "PLAIN", 1_000)
    assert np.allclose(logs, language.expected(v, p[:, 0], raw, start, end, np.array([3])), atol=1e-9)
    # each byte of the word lies in one piece
    assert abs(sum(n * len(x) for n, x in zip(logs, listed)) - 3 * (len(word) + 1)) < 1e-6


def test_remembered_words_score_the_same(vocabulary):
    _, v, p = vocabulary
    r = random.Random(2)
    scores = language.Scores(v, p, 300)
    for _ in range(6):
        text = " ".join("".join(r.choice("abé") for _ in range(r.randint(1, 9))) for _ in range(200)).encode()
        raw = np.frombuffer(text, np.uint8)
        _, _, lower, h, start, end = language._words(raw, np.array([0, len(raw)]))
        half = len(h) // 2
        chunks = [(lower, h, start, end), (lower, h[:half], start[:half], end[:half])]
        want = language.log_probability(v, p, *language.marked(lower, start, end))
        whole, part = scores.of(chunks)
        assert np.array_equal(whole, want) and np.array_equal(part, want[:half])
        assert len(scores.known) <= 300 and (np.diff(scores.known.astype(float)) > 0).all()


def test_unspaced_languages_are_told_apart(spark):
    r = random.Random(3)
    rows = []
    for i in range(120):
        name = ["Chinese", "Japanese", "Thai"][i % 3]
        t = TEXTS[name]
        a = r.randrange(len(t) // 2)
        rows.append((i, t[a:] + t[:a], name))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x.lang_pred for x in language.predict(docs, language.learn(docs)).collect()}
    assert sum(got[i] == name for i, _, name in rows) >= 118


def test_all_of_a_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert language.op4_language(spark, SMALL).count() == docs.count()
