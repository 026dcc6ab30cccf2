"""Benchmark decontamination: a BM25 inverted index of the test items, searched with block-max WAND.

Every passage of every document is a query.  An item's score is its BM25 score
over the passage's distinct words as a part of the score that the item's own
text would get, so one threshold serves all items.  The search is run for a
chunk of passages at once, in the order of block-max WAND: passages whose
terms' upper bounds don't reach the threshold are left; then blocks of items
whose block maxima don't; only what is left is scored exactly, and all items
at or above the threshold are retrieved.  Each is verified on the words around
the passage: enough of the question's word pairs and of the answer's words.

Passages overlap by half and are at least twice as long as the items they are
searched for, so that a copied item lies whole in one of them.  A pass over the
documents takes up to ``PASS`` items, whatever their texts, which bounds the
broadcast: posting lists of index parts of ``PART`` items, of which a task opens
one at a time (as a table of terms and items) for ``OPEN`` bytes of texts.

Defined results: words are lower-case (ASCII) runs of letters, digits and
non-ASCII characters; a test item's answer is its last quarter of words; items
of fewer than ``LEAST`` distinct words match where a text holds them exactly:
their words in order or, if they hold a character of a script written without
spaces, their characters in order; items without a word and null texts match
nothing; repeated documents and items give repeated rows;
an empty table gives no rows; other columns are ignored.  ``leaks`` lists every
match.  ``clean`` keeps a document whose only matches say nothing: an item of
one word (or of fewer than ``CHARS`` characters of a script without spaces),
or an exactly matched item that more than ``SHARE`` of all documents, and more
than ``FEW``, hold.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import save, slices, table

K1, B = 1.2, 0.75
THRESHOLD = 0.5
QUESTION, ANSWER = 0.5, 0.5  # least overlap
LEAST = 6
SHORTEST = 32  # words of half a passage
PART, PASS, BLOCK = 512, 1 << 16, 8
OPEN = 4 << 20
SLOTS = 16
CHARS, SHARE, FEW = 4, 0.01, 20


class Index:
    """Items of at most ``half`` words: posting lists by term (item's place, impact) and, while open, bounds by term and block."""

    def __init__(self, items: list[tuple], half: int):
        self.half, self.ids, self.texts = half, [i for i, _ in items], [h for _, h in items]
        own = [np.unique(h, return_counts=True) for _, h in items]
        self.terms = np.unique(np.concatenate([t for t, _ in own]))
        n, size = len(items), np.array([len(h) for _, h in items], float)
        at = [np.searchsorted(self.terms, t) for t, _ in own]
        holds = np.bincount(np.concatenate(at), minlength=len(self.terms))
        idf = np.log(1 + (n - holds + 0.5) / (holds + 0.5))
        score = [idf[a] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[k] / size.mean())) for k, (a, (_, tf)) in enumerate(zip(at, own))]
        order = np.argsort(np.concatenate(at), kind="stable")
        self.posted = np.repeat(np.arange(n, dtype=np.int32), [len(a) for a in at])[order]
        self.value = np.concatenate([x / x.sum() for x in score]).astype(np.float32)[order]
        self.begin = np.concatenate([[0], np.cumsum(holds)])
        self.open()

    def open(self) -> "Index":
        impact = np.zeros((len(self.terms) + 1, -(-len(self.ids) // BLOCK) * BLOCK), np.float32)
        impact[np.repeat(np.arange(len(self.terms)), np.diff(self.begin)), self.posted] = self.value
        self.impact = impact
        self.block = impact.reshape(len(impact), -1, BLOCK).max(2)
        self.term = impact.max(1)
        slot = (self.terms >> np.uint64(64 - SLOTS)).astype(np.int64)
        self.slots = np.searchsorted(slot, np.arange((1 << SLOTS) + 1))  # of the terms with these first bits
        return self

    def close(self) -> None:
        self.impact = self.block = self.term = self.slots = None

    def __getstate__(self):
        return {**self.__dict__, "impact": None, "block": None, "term": None, "slots": None}

    def find(self, h: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes; len(terms) where there is none."""
        slot = (h >> np.uint64(64 - SLOTS)).astype(np.int64)
        lo, hi = self.slots[slot], self.slots[slot + 1]
        out = np.full(len(h), len(self.terms))
        left = np.flatnonzero(lo < hi)
        while len(left):
            same = self.terms[lo[left]] == h[left]
            out[left[same]] = lo[left[same]]
            left = left[~same]
            lo[left] += 1
            left = left[lo[left] < hi[left]]
        return out

    def search(self, w: bw.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, item's place, score) of all items at or above the threshold in all passages."""
        none = (np.zeros(0, int),) * 3 + (np.zeros(0),)
        per_row = np.diff(w.first)
        halves = np.concatenate([[0], np.cumsum(-(-per_row // self.half))])
        term = self.find(w.hash)
        hit = np.flatnonzero(term < len(self.terms))
        if not len(hit):
            return none
        row = w.row[hit]
        half, term = bw.distinct(halves[row] + (hit - w.first[row]) // self.half, term[hit])
        n = int(halves[-1])
        row_of = np.repeat(np.arange(len(per_row)), np.diff(halves))
        joined = np.zeros(n, bool)  # a passage: this half and, in the same text, the next
        joined[:-1] = row_of[:-1] == row_of[1:]
        following = np.minimum(np.arange(n) + 1, n - 1)

        def passages(bound):
            return bound + np.where(joined if bound.ndim == 1 else joined[:, None], bound[following], 0)

        cut = np.searchsorted(half, np.arange(n + 1))
        live = passages(np.bincount(half, self.term[term], n)) >= THRESHOLD  # the terms' bounds
        if not live.any():
            return none
        wanted = live.copy()
        wanted[1:] |= live[:-1] & joined[:-1]
        use = np.flatnonzero(wanted[half])
        begin = np.flatnonzero(np.diff(half[use], prepend=-1))
        bound = np.zeros((n, self.block.shape[1]), np.float32)
        bound[half[use][begin]] = np.add.reduceat(self.block[term[use]], begin)
        at, block = np.nonzero((passages(bound) >= THRESHOLD) & live[:, None])  # the blocks' bounds
        out = []
        for p in np.unique(at):
            end = cut[p + 2] if joined[p] else cut[p + 1]
            own = np.unique(term[cut[p]:end])
            blocks = block[np.searchsorted(at, p):np.searchsorted(at, p, "right")]
            columns = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            score = self.impact[own[:, None], columns].sum(0)
            for k in np.flatnonzero(score >= THRESHOLD):
                out.append((row_of[p], w.first[row_of[p]] + (p - halves[row_of[p]]) * self.half, columns[k], float(score[k])))
        if not out:
            return none
        return tuple(np.array(x) for x in zip(*out))


def _overlap(part: np.ndarray, of: np.ndarray) -> float:
    return float(np.isin(np.unique(part), of).mean()) if len(part) else 1.0


def _pairs(h: np.ndarray) -> np.ndarray:
    return bw.mixed(h[:-1] * np.uint64(3) + h[1:])


def verified(item: np.ndarray, around: np.ndarray) -> tuple[float, float]:
    """Overlap of the item's question, as word pairs, and of its answer, as words, with the words around a passage."""
    cut = len(item) - max(1, len(item) // 4)
    return _overlap(_pairs(item[:cut]), _pairs(around)), _overlap(item[cut:], around)


def _hashes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return bw.words(raw, np.array([0, len(raw)]), bw.PUNCTUATION, lower=True).hash


#: Chinese, Japanese, Thai, Lao, Tibetan, Burmese and Khmer are written without spaces.
UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _compact(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts without what separates words."""
    keep = ~bw.PUNCTUATION[raw]
    return raw[keep], np.concatenate([[0], np.cumsum(keep)])[offs]


class Exact:
    """Items of fewer than ``LEAST`` distinct words, by hash of their words or characters in order.

    ``telling`` has those of more than one word, or of ``CHARS`` characters.
    """

    def __init__(self, items: list[tuple[int, str]]):
        self.telling: set[int] = set()
        self.words: dict[int, dict[int, list]] = {}  # number of words -> hash -> items
        self.chars: dict[int, dict[int, list]] = {}  # bytes -> hash -> items
        self.begin = np.zeros(256, bool)  # first bytes of items by characters
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            w = bw.words(raw, np.array([0, len(raw)]), bw.PUNCTUATION, lower=True)
            if not 0 < len(np.unique(w.hash)) < LEAST:
                continue
            if UNSPACED.search(text):
                kept, _ = _compact(raw, np.array([0, len(raw)]))
                at, n, h = self.chars, len(kept), bw.span_hash(bw.prefix_sums(kept, True), np.array([0]), np.array([len(kept)]))
                first, telling = chr(kept[0]), len(kept.tobytes().decode()) >= CHARS
                self.begin[[ord(first.lower()), ord(first.upper())] if first.isascii() else kept[0]] = True
            else:
                at, n, h = self.words, len(w.hash), bw.grams(w, len(w.hash))[1]
                telling = n > 1
            if telling:
                self.telling.add(item_id)
            at.setdefault(n, {}).setdefault(int(h[0]), []).append(item_id)

    @staticmethod
    def _hits(known: dict[int, list], row: np.ndarray, h: np.ndarray):
        hit = np.isin(h, np.array(list(known), np.uint64))
        return [(int(r), i) for r, v in zip(*bw.distinct(row[hit], h[hit])) for i in known[int(v)]]

    def search(self, w: bw.Words, raw: np.ndarray, offs: np.ndarray) -> list[tuple[int, int]]:
        """(row, item) of every text that holds an item, once each."""
        found = [x for n, known in self.words.items() for x in self._hits(known, *bw.grams(w, n))]
        if self.chars:
            kept, cut = _compact(raw, offs)
            sums, start = bw.prefix_sums(kept, True), np.flatnonzero(self.begin[kept])
            row = np.searchsorted(cut, start, "right") - 1
            for n, known in self.chars.items():
                whole = start + n <= cut[row + 1]
                found += self._hits(known, row[whole], bw.span_hash(sums, start[whole], start[whole] + n))
        return found


def indexes(items: list[tuple[int, str]]) -> list[Index]:
    """The items' index, by the length of passage that they need; parts are open until they are sent."""
    by: dict[int, list] = {}
    for item_id, text in items:
        h = _hashes(text or "")
        if len(np.unique(h)) >= LEAST:
            half = SHORTEST
            while half < len(h):
                half *= 2
            by.setdefault(half, []).append((item_id, h))
    return [Index(rows[k:k + PART], half) for half, rows in sorted(by.items()) for k in range(0, len(rows), PART)]


def _found(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """The rows of ``leaks``, and: place, which tells benchmark rows apart; how, 0 by score, 1 exactly, 2 exactly but by one word."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind, item_kind = dict(rows.dtypes)["doc_id"], dict(benchmark.dtypes)[item_id]
    schema = f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double, place long, how int"
    tests = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).filter("text IS NOT NULL")
    tests = save(tests.withColumn("place", F.monotonically_increasing_id()), "leaks-items")
    passes = max(1, -(-tests.count() // PASS))

    def one_pass(number: int) -> DataFrame:
        listed = tests.filter(F.pmod("place", F.lit(passes)) == number).orderBy("place").toArrow().combine_chunks()
        ids, places = (listed.column(c).combine_chunks() for c in ("item_id", "place"))  # ids keep their type
        items = list(enumerate(listed.column("text").to_pylist()))
        shared = spark.sparkContext.broadcast((indexes(items), Exact(items), ids, places))

        def searched(batches):
            parts, exact, ids, places = shared.value
            for whole in batches:
                for b in slices(whole, OPEN):
                    chunks = [(lo, raw, offs, bw.words(raw, offs, bw.PUNCTUATION, lower=True)) for lo, _, raw, offs in bw.chunks(b.column("text"))]
                    found = [(lo + row, item, 1.0, 1.0, 1.0, 1 if item in exact.telling else 2)
                             for lo, raw, offs, w in chunks for row, item in exact.search(w, raw, offs)]
                    for part in parts:
                        part.open()
                        for lo, raw, offs, w in chunks:
                            best: dict[tuple, tuple] = {}
                            for row, word, k, score in zip(*part.search(w)):
                                item = part.texts[k]
                                around = w.hash[max(w.first[row], word - len(item)):min(w.first[row + 1], word + 2 * part.half + len(item))]
                                question, answer = verified(item, around)
                                if question >= QUESTION and answer >= ANSWER:
                                    key = (lo + int(row), part.ids[k])
                                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, question, answer))
                            found += [(*key, *values, 0) for key, values in best.items()]
                        part.close()
                    row, item, *values = zip(*found) if found else [()] * 6
                    row, item = pa.array(row, pa.int64()), pa.array(item, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(row), ids.take(item), *[pa.array(x, pa.float64()) for x in values[:3]], places.take(item), pa.array(values[3], pa.int32())],
                        ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "place", "how"])

        return rows.mapInArrow(searched, schema)

    out = one_pass(0)
    for number in range(1, passes):
        out = out.unionByName(one_pass(number))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): the best passage of each document for each item it holds."""
    return _found(docs, benchmark, doc_id, text, item_id, item_text).drop("place", "how")


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = SHARE, few: int = FEW) -> DataFrame:
    """The documents, all columns, without those that hold a test item; rows without an id are judged by their text.

    Exactly matched items that more than ``share`` of the documents (and more
    than ``few``) hold, and those of one word, drop nothing.
    """
    key = "leak_key"
    while key in docs.columns:
        key = f"_{key}"
    keyed = docs.withColumn(key, F.xxhash64(F.col(doc_id), F.col(text)))
    found = save(_found(keyed, benchmark, key, text, "item_id", "text").filter("how < 2").select(F.col("doc_id").alias(key), "place", "how"), "leaks-found")
    most = max(few, share * docs.count())
    common = found.filter("how = 1").groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("place")
    found = found.join(common, "place", "left_anti").select(key).distinct()
    return keyed.join(found, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
