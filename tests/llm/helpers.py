"""Small tables and brute-force counterparts for the tests of lakeviews.llm."""

import re

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

LONG = "word " * 40_000
ODD = [  # doc_id, text, lang, source
    (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "a"), (4, "one", "en", None), (5, "...!!!###", None, "b"),
    (None, "no id here but words all the same", "en", "b"), (None, None, None, None), (6, LONG, "en", "a"),
    (7, "the same row twice, word for word", "en", "a"), (7, "the same row twice, word for word", "en", "a"),
    (7, "the same id and another text", "fr", "c"), (8, "x" * 3000, "de", "c"), (9, "ünïcödé Ωmega 漢字 text 😀 ok", "de", "c"),
    (10, "aé́   no-break em", "fr", "a"), (11, "password = ", "en", "a"), (12, "token: abcdef0123456789", "en", "a"),
]
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, size long, score double, label string, "
           "set_id string, rid string, zones string, copies string, held_out string, taken string, bucket string, kept string")


def odd_docs(spark, rows=ODD):
    """Documents with every odd value and with columns named like the operators' own."""
    extra = (1, 2, 0.5, "x", "y", "z", "q", "c", "h", "t", "b", "k")
    return spark.createDataFrame([(*r, *extra) for r in rows], COLUMNS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


def tabled(spark, name, rows, schema):
    """A folder with one parquet table, as the queries read it."""
    from lakeviews.session import scratch_path

    root = scratch_path(spark, "llm-test")
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
