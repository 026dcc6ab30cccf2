"""Test items of few words, or without spaces, are found where they are copied."""

from lakeviews.llm import decontamination

ITEMS = [(1, "What is red? Roses."), (2, "光の速さは秒速何キロメートルですか"), (3, "中国的首都是哪里？ 北京"), (4, "..."), (5, "ABC公司"), (6, "no no no no no no no"), (7, "What is red? Roses.")]
DOCS = [(1, "so: what is RED - roses, they say"), (2, "what is red or roses"), (3, "問題：光の速さは秒速何キロメートルですか。答え"), (4, "光の速さは秒速何"), (5, "前文中国的首都是哪里？北京。后文"),
        (6, "在abc公司工作"), (7, "no no no no no no"), (8, "oh no no no no no no no no"), (9, None), (10, "哪里"), (11, "..."), (12, "what is red"), (13, "roses")]
WANT = {(1, 1), (1, 7), (3, 2), (5, 3), (6, 5), (8, 6)}


def test_short_items_are_matched_exactly(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()]
    assert sorted(got) == sorted(WANT)
    assert {r.doc_id for r in decontamination.clean(docs, bench).collect()} == {d for d, _ in DOCS} - {d for d, _ in WANT}
