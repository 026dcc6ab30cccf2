"""CSV files of any size read by many tasks, quoted line breaks included.

A line break ends a record only outside quotes, so a block of a large file
can't tell by itself where its records begin.  The scan works in two passes
over the physical lines, whose blocks (splits) Spark deals out:

1. Each block reports its number of quotes modulo 2 and, for either state that
   it may begin in, whether its quotes stand as CSV wants them: an opening one
   at the start of a field, a closing one at its end, doubled ones inside.
   The sums of the blocks before give every block's state.
2. Each block then joins its lines into records.  What begins in one block and
   ends in another, at most two pieces a block, is put together by file.

Records are parsed by Spark's own CSV functions.  A file with stray quotes, or
one that ends inside quotes, or with line ends of both kinds, isn't decided by
parity; it is read by one task, as ``spark.read.csv`` with ``multiLine`` reads
it, so every file gives the rows of that reader.  Empty lines are no records;
the first record of a file is its header.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fields may hold quoted line breaks, doubled quotes and blanks at their ends.
_PARSED = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV = {"header": True, "multiLine": True, **_PARSED}
_QUOTE, _COMMA, _BREAK, _RETURN = b'",\n\r'

BLOCKS = "file string, block long, odd int, bad_closed long, bad_open long, returns long, bare long, last_bare int, first_return int"
PIECES = "file string, block long, line long, part int, record string"
WHOLE, FIRST, MIDDLE, LAST = range(4)
_SIZES = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a split of a scan in this session."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    number = text.rstrip("bkmgt")
    return int(number) * _SIZES[text[len(number):][:1]]


def _reader(spark: SparkSession) -> SparkSession:
    """A session whose splits depend on nothing but the files, so that both passes see the same blocks whenever they run."""
    reader = spark.newSession()
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        reader.conf.set(name, spark.conf.get(name))
    reader.conf.set("spark.sql.files.minPartitionNum", "1")
    return reader


def _lines(spark: SparkSession, reader: SparkSession, files: list[str]) -> DataFrame:
    """(file, block, value) of every physical line; no file may be filtered away here, since that changes the splits."""
    read = reader.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    return spark.createDataFrame([], read.schema).union(read)  # of the caller's session


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """((file, block), its lines) of each stretch of one block's lines; a task reads blocks one after another."""
    n = batch.num_rows
    if not n:
        return
    block = batch.column("block").to_numpy()
    files = batch.column("file").dictionary_encode()
    code = files.indices.to_numpy()
    begin = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (code[1:] != code[:-1])]))
    for a, b in zip(begin, np.append(begin[1:], n)):
        yield (files.dictionary[int(code[a])].as_py(), int(block[a])), batch.column("value").slice(a, b - a)


def misplaced(lines: pa.Array, opened: int) -> int:
    """Quotes that don't stand where CSV wants them, if ``opened`` (0 or 1) quotes are open before the lines."""
    raw = np.frombuffer(b"\n".join([b"", *lines.cast(pa.binary()).to_pylist(), b""]), np.uint8)
    at = np.flatnonzero(raw == _QUOTE)
    opening = (np.arange(len(at)) + opened) % 2 == 0
    before, after = raw[at - 1], raw[at + 1]
    starts = (before == _COMMA) | (before == _BREAK) | (before == _QUOTE)
    ends = (after == _COMMA) | (after == _BREAK) | (after == _QUOTE) | ((after == _RETURN) & (raw[np.minimum(at + 2, len(raw) - 1)] == _BREAK))
    return int((~np.where(opening, starts, ends)).sum())


def _profiled(batches):
    """One row a block: its quotes' parity, what is misplaced in either state, and lines that end in \\r or don't."""
    key, odd, bad, returns, bare, last, first = None, 0, [0, 0], 0, 0, 0, 0

    def row():
        values = (key[1], odd, *bad, returns, bare, last, first)
        names = ("block", "odd", "bad_closed", "bad_open", "returns", "bare", "last_bare", "first_return")
        kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), *[pa.array([v], k) for v, k in zip(values, kinds)]], ["file", *names])

    for batch in batches:
        for now, lines in _runs(batch):
            if now != key:
                if key is not None:
                    yield row()
                key, odd, bad, returns, bare, first = now, 0, [0, 0], 0, 0, int(pc.ends_with(lines[:1], "\r")[0].as_py())
            ended = pc.ends_with(lines, "\r")
            with_return = pc.sum(ended).as_py() or 0
            returns, bare, last = returns + with_return, bare + len(lines) - with_return, int(not ended[-1].as_py())
            quotes = pc.sum(pc.count_substring(lines, '"')).as_py() or 0
            if quotes:
                bad = [bad[s] + misplaced(lines, (s + odd) % 2) for s in (0, 1)]
            odd = (odd + quotes) % 2
    if key is not None:
        yield row()


def _joined(states: dict, returns: set, skipped: set):
    """Records and pieces of records of every block but those of skipped files; ``states`` tells whether a block begins inside quotes.

    In files of ``returns``, whose lines end in \\r\\n, breaks become \\n.

    Empty lines and each file's header are left out; the first piece of a
    header that goes on in the next block has line 0.
    """
    def run(batches):
        key, line, pending, opened, inside, header = None, 0, [], False, False, False
        # pending: lines of a record that isn't over; inside: it began in an earlier block

        def pieces(rows):
            at, part, text = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(rows)), pa.array([key[1]] * len(rows), pa.int64()), pa.array(at, pa.int64()),
                                               pa.array(part, pa.int32()), pa.array(text, pa.binary()).view(pa.string())], ["file", "block", "line", "part", "record"])

        def left():
            """What the block's end cuts off."""
            if pending:
                yield pieces([(0 if header else line - len(pending) + 1, MIDDLE if inside else FIRST, b"\n".join(pending))])

        for batch in batches:
            for now, lines in _runs(batch):
                if now[0] in skipped:
                    continue
                if now != key:
                    yield from left()
                    if now not in states:
                        raise ValueError(f"{now[0]} changed between two passes: no block began at {now[1]}")
                    key, line, pending, header = now, 0, [], now[1] == 0
                    opened = inside = states[now]
                odd = (pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2).astype(np.int64)
                after = (int(opened) + np.cumsum(odd)) % 2  # inside quotes after each line
                text = lines.cast(pa.binary()).to_pylist()
                if now[0] in returns:
                    text = [x[:-1] if x.endswith(b"\r") else x for x in text]
                rows, begin = [], 0
                for e in np.flatnonzero(after == 0).tolist():
                    at = line + begin - len(pending) + 1
                    record = text[e] if e == begin and not pending else b"\n".join([*pending, *text[begin:e + 1]])
                    if inside:
                        rows.append((at, LAST, record))
                    elif record:
                        if not header:
                            rows.append((at, WHOLE, record))
                        header = False
                    pending, inside, begin = [], False, e + 1
                pending += text[begin:]
                line += len(text)
                opened = bool(after[-1])
                if rows:
                    yield pieces(rows)
        yield from left()
    return run


def block_states(lines: DataFrame) -> DataFrame:
    """(file, block, opened, regular, returns): one row a block.

    Not regular are files that parity doesn't decide, and those whose lines end
    in \\n and \\r\\n by turns; ``returns``: they end in \\r\\n, as the first does.
    """
    blocks = lines.mapInArrow(_profiled, BLOCKS)
    order = Window.partitionBy("file").orderBy("block")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = (F.sum("odd").over(order) - F.col("odd")) % 2
    bad = F.when(F.col("opened") == 1, F.col("bad_open")).otherwise(F.col("bad_closed"))
    returns = F.first("first_return").over(whole) == 1
    mixed = F.when(returns, F.sum("bare").over(whole) - F.last("last_bare").over(whole)).otherwise(F.sum("returns").over(whole))
    return (blocks.withColumn("opened", state)
            .select("file", "block", "opened", ((F.sum(bad).over(whole) == 0) & (F.sum("odd").over(whole) % 2 == 0) & (mixed == 0)).alias("regular"),
                    returns.alias("returns")))


def scan(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    """The records of CSV files with a header, and ``position``: (part, file, block, pos), in the order of each file."""
    lines = _lines(spark, _reader(spark), files)
    # One row a split, which the driver plans one by one anyway.
    blocks = block_states(lines).collect()
    odd = sorted({r["file"] for r in blocks if not r["regular"]})
    states = {(r["file"], r["block"]): bool(r["opened"]) for r in blocks}
    inside = any(r["opened"] and r["regular"] for r in blocks)
    pieces = lines.mapInArrow(_joined(states, {r["file"] for r in blocks if r["returns"]}, set(odd)), PIECES)
    records = pieces.filter(F.col("part") == WHOLE)
    if inside:
        # Pieces of a file in order; a first one begins a record.
        cut = pieces.filter(F.col("part") != WHOLE).withColumn(
            "number", F.sum((F.col("part") == FIRST).cast("long")).over(Window.partitionBy("file").orderBy("block", "line")))
        together = F.array_sort(F.collect_list(F.struct("block", "line", "record")))
        joined = (cut.groupBy("file", "number").agg(together.alias("own"))
                  .select("file", F.col("own")[0]["block"].alias("block"), F.col("own")[0]["line"].alias("line"), F.lit(WHOLE).alias("part"),
                          F.array_join(F.col("own")["record"], "\n").alias("record")))
        records = records.unionByName(joined)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = records.filter("line > 0").select(
        F.from_csv("record", columns, {k: str(v) for k, v in _PARSED.items()}).alias("row"), part_number(F.element_at(F.split("file", "/"), -1)).alias("part"), "file", "block", F.col("line").alias("pos"))
    out = rows.select("row.*", F.struct("part", "file", "block", "pos").alias("position"))
    return out.unionByName(whole_files(spark, odd, schema)) if odd else out


def part_number(file_name):
    """Files written by Spark are ordered by their part number, not by its text: ``part-100000`` comes after ``part-99999``."""
    return F.regexp_extract(file_name, r"^part-(\d+)", 1).try_cast("long")


def file_order(path: str) -> tuple[int, str]:
    """What sorts paths as ``position`` does."""
    found = re.match(r"part-([0-9]+)", path.rsplit("/", 1)[-1])
    number = int(found[1]) if found else -1
    return (number if number < 1 << 63 else -1), path


def whole_files(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    """As ``scan``, a file a task."""
    return spark.read.schema(schema).options(**CSV).csv(files).withColumn("position", F.struct(
        part_number(F.col("_metadata.file_name")).alias("part"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos")))
