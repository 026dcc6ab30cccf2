"""Removal of lines that several documents share, with two Bloom filters.

A line's key is the line without spaces at both ends and with A-Z in lower
case.  Keys of at least ``LEAST_CHARS`` code points that ``LEAST_DOCS``
documents or more hold go from all of them but those of the greatest id.

1. A scan writes the 64-bit hashes of each document's distinct keys (eight
   bytes a line), which also counts them.
2. Every task sets its keys' bits in a filter of bits seen once and, where a
   bit was set before, in one of bits seen twice.  Two pairs of filters add up
   to (one's once or the other's; twice in either, or once in both), so slices
   of them are merged wherever and in whatever order they arrive.
3. A second scan of the texts looks every line up in the twice-seen filter.
   Only what is in it, the suspected repeats, is shuffled: the key itself, with
   map-side counts and greatest ids, so a key that a third of all documents
   hold costs a row a task.  That is exact, whatever the filters let through.
4. A last scan drops the lines of confirmed keys.  These are broadcast as
   digests up to ``KEYS`` of them; beyond that the suspected lines are joined
   with them and documents with their own lines' numbers.

Filters have ``BITS_A_KEY`` bits a key and at most ``MOST_BITS`` bits, the
bound of what is collected and broadcast.  Beyond it they fill up and more
lines are shuffled; the result is the same.

Defined results: a null text is one empty line; rows count as documents, also
those of equal ids, and all rows of the greatest id keep the line; a null id is
below every other; a line repeated within a document counts once and goes or
stays as a whole; an empty table gives no rows; texts are read whole, a line
may be as long as a text; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import save, slices, small_batches, table

LEAST_CHARS, LEAST_DOCS = 20, 3
BITS_A_KEY, HASHES = 8, 3
MOST_BITS = 1 << 29  # 64 MB a filter
SLICE = 1 << 20
KEYS = 1 << 20
OUT = 4 << 20  # bytes of texts that are put out at once, about
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Lines:
    """Lines of a chunk of texts: row, byte span, span of the key, and the keys' hashes."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray, least: int):
        breaks = np.flatnonzero(raw == 10)
        self.start = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
        # ends: a break, or the end of the text
        self.end = np.sort(np.concatenate([breaks, offs[1:]]), kind="stable")
        per_row = 1 + np.searchsorted(breaks, offs[1:]) - np.searchsorted(breaks, offs[:-1])
        self.first = np.concatenate([[0], np.cumsum(per_row)])
        self.row = np.repeat(np.arange(len(offs) - 1), per_row)
        w = bw.words(raw, offs, hashed=False)
        lo, hi = np.searchsorted(w.start, self.start), np.searchsorted(w.start, self.end)
        filled = hi > lo
        self.key_start, self.key_end = self.start.copy(), self.start.copy()
        self.key_start[filled], self.key_end[filled] = w.start[lo[filled]], w.end[hi[filled] - 1]
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        self.long = np.flatnonzero(chars[self.key_end] - chars[self.key_start] >= least)
        at = self.long
        self.hash = bw.span_hash(bw.prefix_sums(raw, True), self.key_start[at], self.key_end[at]) if len(at) else np.zeros(0, np.uint64)


def key_bytes(raw: np.ndarray, start: int, end: int) -> bytes:
    return raw[start:end].tobytes().translate(_LOWER)


def positions(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash in a filter of ``bits`` (a power of two), one row a hash function."""
    step = bw.mixed(h) | np.uint64(1)
    return np.array([(h + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(HASHES)]).astype(np.int64)


class Pair:
    """Two Bloom filters: of bits that one key or more sets, and of those that two or more set."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)

    def add(self, h: np.ndarray) -> None:
        """Keys of one document or of several, each as often as documents hold it."""
        p, n = np.unique(positions(h, self.bits).ravel(), return_counts=True)
        byte, bit = p >> 3, (np.uint8(1) << (p & 7).astype(np.uint8))
        again = (n > 1) | ((self.once[byte] & bit) != 0)
        np.bitwise_or.at(self.twice, byte[again], bit[again])
        np.bitwise_or.at(self.once, byte, bit)

    def merge(self, once: np.ndarray, twice: np.ndarray) -> None:
        self.twice |= twice | (self.once & once)
        self.once |= once


def holds(filter_: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    p = positions(h, bits)
    return ((filter_[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(0)


def filter_bits(keys: int, most: int = MOST_BITS) -> int:
    """A power of two, at least a slice."""
    bits = SLICE
    while bits < keys * BITS_A_KEY and bits < most:
        bits *= 2
    return bits


def _hashed(least: int):
    def run(batches):
        for b in batches:
            for _, _, raw, offs in bw.chunks(b.column("text")):
                lines = Lines(raw, offs, least)
                _, keys = bw.distinct(lines.row[lines.long], lines.hash)
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])
    return run


def _filters(bits: int):
    """A task's filters, in slices that have a bit."""
    def run(batches):
        pair = Pair(bits)
        for b in batches:
            pair.add(b.column("key").to_numpy().view(np.uint64))
        width = SLICE >> 3
        for k in range(bits // SLICE):
            once, twice = (x[k * width:(k + 1) * width] for x in (pair.once, pair.twice))
            if once.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], ["slice", "once", "twice"])
    return run


def _added(batches):
    """Slices that lie in one partition, merged."""
    by: dict[int, Pair] = {}
    for b in batches:
        for k, once, twice in zip(b.column("slice").to_pylist(), b.column("once"), b.column("twice")):
            by.setdefault(k, Pair(SLICE)).merge(*(np.frombuffer(x.as_buffer(), np.uint8) for x in (once, twice)))
    for k, pair in by.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([pair.twice.tobytes()])], ["slice", "twice"])


def seen_twice(rows: DataFrame, least: int = LEAST_CHARS, most_bits: int = MOST_BITS) -> np.ndarray:
    """The twice-seen filter (bytes) of the texts' keys; at most ``most_bits`` bits."""
    spark = rows.sparkSession
    keys = save(rows.select("text").mapInArrow(_hashed(least), "key long"), "line-keys")
    bits = filter_bits(keys.count(), most_bits)
    parts = save(keys.mapInArrow(_filters(bits), "slice int, once binary, twice binary"), "line-filters")
    slices = bits // SLICE
    merged = parts.repartitionByRange(min(slices, int(spark.conf.get("spark.sql.shuffle.partitions"))), "slice").mapInArrow(_added, "slice int, twice binary")
    out = np.zeros(bits >> 3, np.uint8)
    for r in merged.collect():  # at most most_bits / 8 bytes
        out[r["slice"] * (SLICE >> 3):(r["slice"] + 1) * (SLICE >> 3)] = np.frombuffer(r["twice"], np.uint8)
    return out


def _suspected(shared, least: int):
    """(doc_id, rid, key) of every line in the twice-seen filter, once a document."""
    def run(batches):
        twice = shared.value
        bits = len(twice) << 3
        for b in batches:
            for lo, _, raw, offs in bw.chunks(b.column("text")):
                lines = Lines(raw, offs, least)
                hit = np.flatnonzero(holds(twice, bits, lines.hash))
                if not len(hit):
                    continue
                at = lines.long[hit]
                found = dict.fromkeys((int(r), key_bytes(raw, s, e)) for r, s, e in zip(lines.row[at], lines.key_start[at], lines.key_end[at]))
                take = pa.array([lo + r for r, _ in found])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), b.column("rid").take(take), pa.array([k for _, k in found], pa.binary())], ["doc_id", "rid", "key"])
    return run


def _digest(key: bytes) -> bytes:
    return hashlib.md5(key, usedforsecurity=False).digest()


def _dropped(listed, least: int):
    """Texts without the lines that ``listed`` drops: its call tells which long lines are worth a look, ``drops`` decides by the key."""
    def run(batches):
        for b in (x for whole in batches for x in slices(whole, OUT)):
            ids = b.column("doc_id").to_pylist()
            kept, total, gone = [], [], []
            for lo, hi, raw, offs in bw.chunks(b.column("text")):
                lines = Lines(raw, offs, least)
                drop = np.zeros(len(lines.row), bool)
                for k in listed(b, lo, lines):
                    line = lines.long[k]
                    drop[line] = listed.drops(b, lo + int(lines.row[line]), ids, key_bytes(raw, lines.key_start[line], lines.key_end[line]))
                lost = np.add.reduceat(drop.astype(np.int64), lines.first[:-1]) if len(drop) else np.zeros(0, int)
                total += np.diff(lines.first).tolist()
                gone += lost.tolist()
                for r in range(hi - lo):
                    if lost[r]:
                        own = [i for i in range(lines.first[r], lines.first[r + 1]) if not drop[i]]
                        kept.append(b"\n".join(raw[lines.start[i]:lines.end[i]].tobytes() for i in own))
                    else:
                        kept.append(raw[offs[r]:offs[r + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                                             ["doc_id", "n_lines", "n_dropped", "kept"])
    return run


class Confirmed:
    """All confirmed keys, broadcast: their hashes, and by digest the id that keeps the line."""

    def __init__(self, shared):
        self.shared = shared

    def __call__(self, batch, lo, lines):
        hashes, _ = self.shared.value
        return np.flatnonzero(np.isin(lines.hash, hashes))

    def drops(self, batch, row, ids, key):
        _, last = self.shared.value
        digest = _digest(key)
        return digest in last and last[digest] != ids[row]


class Own:
    """A document's own confirmed keys that it loses, joined to it as digests."""

    def __call__(self, batch, lo, lines):
        held = batch.column("lost").is_valid().to_numpy(zero_copy_only=False)[lo:lo + len(lines.first) - 1]
        return np.flatnonzero(held[lines.row[lines.long]])

    def drops(self, batch, row, ids, key):
        return _digest(key) in batch.column("lost")[row].as_py()


def key_hash(keys: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(keys), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int64)
    return bw.span_hash(bw.prefix_sums(raw, True), offs[:-1], offs[1:]) if keys else np.zeros(0, np.uint64)


def without_shared_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS,
                         least_docs: int = LEAST_DOCS, most_bits: int = MOST_BITS, most_keys: int = KEYS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every document, with the lines that stay joined by line breaks."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    twice = spark.sparkContext.broadcast(seen_twice(rows, least_chars, most_bits))
    suspected = save(rows.mapInArrow(_suspected(twice, least_chars), f"doc_id {kind}, rid long, key binary"), "line-suspects")
    confirmed = save(suspected.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
                     .filter(F.col("n") >= least_docs).select("key", "last"), "line-confirmed")
    schema = f"doc_id {kind}, n_lines long, n_dropped long, kept string"
    if confirmed.count() <= most_keys:
        # digests and hashes only: the keys themselves may be of any length
        def digests(batches):
            for b in batches:
                keys = [k.as_py() for k in b.column("key")]
                yield pa.RecordBatch.from_arrays([pa.array(key_hash(keys).view(np.int64)), pa.array([_digest(k) for k in keys], pa.binary()), b.column("last")], ["hash", "digest", "last"])

        listed = confirmed.mapInArrow(digests, f"hash long, digest binary, last {kind}").collect()
        known = (np.sort(np.array([r["hash"] for r in listed], np.int64).view(np.uint64)), {bytes(r["digest"]): r["last"] for r in listed})
        return rows.mapInArrow(_dropped(Confirmed(spark.sparkContext.broadcast(known)), least_chars), schema)
    lost = (suspected.join(confirmed, "key").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
            .select("rid", F.unhex(F.md5("key")).alias("digest")).groupBy("rid").agg(F.collect_set("digest").alias("lost")))
    return rows.join(lost, "rid", "left").mapInArrow(_dropped(Own(), least_chars), schema)


def op13_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = without_shared_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.doc_id, k.place, k.line, s.key IS NOT NULL AND k.doc_id <> s.last AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
