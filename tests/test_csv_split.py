"""Splittable CSV scan: every file gives the rows of the one-task reader, in its order."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeviews.contracts import Contract
from lakeviews.operators.dedupe import SEQ, dedupe_keep_last
from lakeviews.session import scratch_path
from lakeviews.sources import csv_split
from lakeviews.sources import lake as L

SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "qty", "note")])
C = Contract("test", "things", {"id": "string", "qty": "int", "note": "string"}, ("id",), ("id",))


@pytest.fixture
def splits(spark):
    """Sets the bytes of a split for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def small(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield small
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def folder(spark, texts, newline="\n"):
    path = scratch_path(spark, "csv-test").replace("file:", "")
    os.makedirs(path)
    for i, text in enumerate(texts):
        with open(f"{path}/part-{i:05d}.csv", "wb") as f:
            f.write(text.replace("\n", newline).encode() if isinstance(text, str) else text)
    return path


def both(spark, path, limit=0):
    """(rows by the split scan in order, rows by the one-task scan in order)."""
    def rows(df):
        return [tuple(r)[:3] for r in df.orderBy("position").collect()]
    return rows(L.read_csv(spark, path, SCHEMA, limit)), rows(csv_split.whole_files(spark, [path], SCHEMA))


def quoted(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') or not text else text


def odd_file(r, n, newlines=True):
    def field():
        alphabet = 'ab ,"é漢\\' + "\n" * newlines
        return "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 9, 40])))
    lines = ["id,qty,note"]
    for i in range(n):
        lines.append(",".join([str(i), *(quoted(field()) if r.random() < 0.8 else "" for _ in range(2))]))
        if r.random() < 0.1:
            lines.append("")
    return "\n".join(lines) + r.choice(["", "\n", "\n\n"])


@pytest.mark.parametrize("size", [64, 300, 5_000])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_equals_the_one_task_reader(spark, splits, size, newline):
    splits(size)
    r = random.Random(size)
    path = folder(spark, [odd_file(r, n) for n in (0, 1, 7, 60, 150)], newline)
    got, want = both(spark, path)
    assert len(want) > 200 and got == want


def test_a_record_over_many_blocks(spark, splits):
    splits(100)
    long = "\n".join(f"line {i} says ""hi""" for i in range(400))
    path = folder(spark, ["id,qty,note\n1,2," + quoted(long) + "\n2,3,end\n", 'id,"qty\nof it",note\n3,4,x\n'])
    got, want = both(spark, path)
    assert got == want and got[0][2] == long and got[-1] == ("3", "4", "x")


@pytest.mark.parametrize("text", [
    'id,qty,note\n1,2,5" pipe\n2,3,a\n3,4,7" pipe\n4,5,b\n',  # stray quotes, an even number of them
    'id,qty,note\n1,2,5" pipe\n2,3,"x\ny"\n',  # an odd number
    'id,qty,note\n1,2,"never closed\n2,3,b\n',
    'id,qty,note\n1,2, "blank before"\n2,3,"blank after" \n',
    "\n\nid,qty,note\n\n1,2,a\n",
    "id,qty,note\r\n1,2,a\n2,3,b\r\n", "id,qty,note\n1,2,a\r\n2,3,\"b\r\nc\"\n", "id,qty,note\r\n1,2,\"a\r\nb\"\r\n2,3,end", "id,qty,note\n1,a\rb,c\n",
    "id,qty,note", "", "\n", "id,qty,note\n1\n1,2,3,4,5\n,,\n",
])
def test_irregular_files_are_read_by_one_task(spark, splits, text):
    splits(16)
    regular = 'id,qty,note\n9,9,"fine\nhere"\n'
    got, want = both(spark, folder(spark, [text, regular]))
    assert got == want and ("9", "9", "fine\nhere") in got


def test_bytes_that_are_no_utf8(spark, splits):
    splits(24)
    got, want = both(spark, folder(spark, [b'id,qty,note\n1,2,"\xff\xfe\n\xc3"\n2,3,ok\n']))
    assert got == want


def test_large_files_are_dealt_to_many_tasks(spark, splits):
    splits(64 << 10)
    r = random.Random(3)
    path = folder(spark, [odd_file(r, 20_000), "id,qty,note\nsmall,1,file\n"])
    df = L.read_csv(spark, path, SCHEMA)
    blocks = {(x.file, x.block) for x in df.select("position.file", "position.block").distinct().collect()}
    assert len(blocks) >= 8
    got, want = both(spark, path, None)
    assert got == want


def test_keep_last_across_blocks(spark, splits):
    splits(4_000)
    rows = [(str(i % 50), str(i), f"note\n{i}") for i in range(3_000)]
    root = scratch_path(spark, "csv-test")
    L.land_raw(spark.createDataFrame(rows, "id string, qty string, note string").coalesce(1), root, "test", "things", "2024-01-01")
    scan = L.scan_raw_csv(spark, root, C)
    assert scan.select(F.col(SEQ)["block"]).distinct().count() > 5
    got = sorted((x.id, x.qty) for x in dedupe_keep_last(scan, C.primary_key, F.col(SEQ)).collect())
    assert got == sorted((str(k), str(2_950 + k)) for k in range(50))


def test_splits_stay_as_they_were_counted(spark, splits):
    """Settings that change between the passes don't move the blocks."""
    splits(500)
    path = folder(spark, [odd_file(random.Random(2), 300)])
    df, want = L.read_csv(spark, path, SCHEMA), csv_split.whole_files(spark, [path], SCHEMA).collect()
    splits(90)
    assert sorted(map(repr, (tuple(r)[:3] for r in df.collect()))) == sorted(map(repr, (tuple(r)[:3] for r in want)))


def test_misplaced_quotes():
    import pyarrow as pa

    def bad(opened, *lines):
        return csv_split.misplaced(pa.array(lines), opened)
    assert bad(0, 'a,"b",c', '"x""y"', '""') == 0 and bad(1, 'rest",b', '"c"') == 0
    assert bad(0, 'a"b"') == 1 and bad(0, '"a"b') == 1 and bad(0, '"a"\r') == 0 and bad(0, '"a"\rb') == 1
    assert bad(1, 'a,"b",c') == 2


def test_cost_follows_the_file(spark, splits):
    """The plan has no shuffle of whole lines: only what blocks cut off is exchanged."""
    splits(32 << 10)
    path = folder(spark, [odd_file(random.Random(1), 8_000)])
    begun = time.time()
    df = L.read_csv(spark, path, SCHEMA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "SortMergeJoin" not in plan
    assert df.count() == 8_000 and time.time() - begun < 120
