"""Periodic runs of words, found with suffix trees of a document and of its reversal.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends and that has at least max(``LEAST``, ``TIMES`` * q)
words.

1. Ukkonen's algorithm builds the suffix trees of the words and of the words
   in reverse, word by word.  An Euler tour of each tree, its string depths and
   a table of minima over blocks give the depth of any two leaves' lowest
   common ancestor in constant time: how many words two positions agree on, to
   the right and to the left.
2. Every run has a Lyndon root that is the longest Lyndon word at its start,
   by the order of words or by the opposite order.  These are the spans from
   a position to the next smaller suffix, read off the tree's leaves; two
   candidates a position, so linearly many.
3. Each candidate is extended to both sides by the two trees; those long enough
   are the runs.

Trees are built for the stretches of a text that can hold a run: each word of
one occurs ``TIMES`` times in it at least (its residues do, and a run of one
repeated word has ``LEAST``), so a text is cut at words rarer than that, and its
pieces again (``CUTS`` times at most, since that only spares work).  No run is
lost or shortened: the words at the cuts don't occur in the pieces beside them.

Each text is searched by one task, in memory linear in its words; there is no
shuffle.  Defined results: null and empty texts have no words and no runs;
repeated rows give repeated results; texts of any length are whole; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm.common import WORD, let, small_batches, table

TIMES, LEAST = 4, 6
BLOCK = 16
CUTS = 8
HELD = 100_000  # words of the texts that are searched together
_WORD = re.compile(WORD)


class SuffixTree:
    """Ukkonen's suffix tree of a list of positive numbers, which a 0 ends.

    Edges are keyed by node * ``span`` + first symbol; a leaf's edge is open.
    Leaves are made in the order of their suffixes.
    """

    def __init__(self, s: list[int]):
        self.s = s = [*s, 0]
        self.span = span = max(s) + 1
        end = len(s)
        self.edges = edges = {}
        start, size, link, suffix = [0], [0], [0], [-1]
        node = pending = leaves = 0  # the active point is ``pending`` symbols below ``node``
        for i, c in enumerate(s):
            pending += 1
            waiting = 0  # an inner node without its suffix link
            while pending:
                first = s[i + 1 - pending]
                child = edges.get(node * span + first)
                while child is not None and pending > size[child]:
                    node = child
                    pending -= size[child]
                    first = s[i + 1 - pending]
                    child = edges.get(node * span + first)
                if child is None:
                    edges[node * span + first] = len(start)
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    at = start[child] + pending - 1
                    follows = s[at]
                    if follows == c:
                        if waiting:
                            link[waiting] = node
                        break
                    inner = len(start)
                    edges[node * span + first] = inner
                    start.append(start[child])
                    size.append(pending - 1)
                    link.append(0)
                    suffix.append(-1)
                    start[child] = at
                    size[child] -= pending - 1
                    edges[inner * span + follows] = child
                    edges[inner * span + c] = len(start)
                    if waiting:
                        link[waiting] = inner
                    waiting = inner
                start.append(i)
                size.append(end)  # an open edge: longer than any
                link.append(0)
                suffix.append(leaves)
                leaves += 1
                if node:
                    node = link[node]
                else:
                    pending -= 1
        self.size, self.suffix = size, suffix

    def tour(self, ordered: bool = True) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
        """(string depths along an Euler tour, each suffix's place in it, suffixes in order, suffixes in the opposite order).

        In both orders a suffix follows its own prefixes; they are empty if not ``ordered``.
        """
        keys = np.fromiter(self.edges, np.int64, len(self.edges))
        by = np.argsort(keys)
        kids = np.fromiter(self.edges.values(), np.int64, len(keys))[by].tolist()
        begin = np.searchsorted(keys[by] // self.span, np.arange(len(self.size) + 1)).tolist()
        closes = (keys[by] % self.span == 0).tolist()  # an edge of the end mark alone
        size, suffix, end = self.size, self.suffix, len(self.s)
        depths, place, order = [0], [0] * end, []
        path = [(0, 0, begin[0])]  # inner nodes: number, string depth, next child
        while path:
            node, depth, at = path.pop()
            if at == begin[node + 1]:
                if path:
                    depths.append(path[-1][1])
                continue
            path.append((node, depth, at + 1))
            child = kids[at]
            k = suffix[child]
            if k >= 0:
                place[k] = len(depths)
                depths += (end - k, depth)
                order.append(k)
            else:
                depth += size[child]
                depths.append(depth)
                path.append((child, depth, begin[child]))
        opposite, stack = [], [0] * ordered
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                opposite.append(suffix[node])
            else:  # the end mark comes first in this order too, then the greatest symbol
                a, b = begin[node], begin[node + 1]
                stack += kids[a + 1:b] + [kids[a]] if closes[a] else kids[a:b]
        return np.array(depths, np.int32), np.array(place, np.int64), order, opposite


class Depths:
    """Least depth between two places of Euler tours that lie behind one another, in constant time."""

    def __init__(self, depths: np.ndarray):
        blocks = -(-len(depths) // BLOCK)
        grid = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        grid[:len(depths)] = depths
        self.flat, grid = grid, grid.reshape(-1, BLOCK)
        self.until = np.minimum.accumulate(grid, 1).ravel()
        self.since = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [grid.min(1)]
        while len(self.table[-1]) > 1 << len(self.table) - 1:
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))

    def least(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        low, high = np.minimum(one, two), np.maximum(one, two)
        a, b = low // BLOCK, high // BLOCK
        out = np.minimum(self.since[low], self.until[high])
        same = np.flatnonzero(a == b)
        if len(same):
            lo, hi = low[same], high[same]
            least = self.flat[lo]
            for k in range(1, BLOCK):
                least = np.minimum(least, self.flat[np.minimum(lo + k, hi)])
            out[same] = least
        between = b - a - 1
        level = np.frexp(np.maximum(between, 1))[1] - 1
        for k in np.unique(level[between > 0]):
            at = np.flatnonzero((between > 0) & (level == k))
            row = self.table[k]
            out[at] = np.minimum(out[at], np.minimum(row[a[at] + 1], row[b[at] - (1 << int(k))]))
        return out


def next_smaller(order: list[int], n: int) -> list[int]:
    """For every position the next one whose suffix is smaller in this order; n where there is none."""
    rank = [0] * (n + 1)
    for r, k in enumerate(order):
        rank[k] = r
    out, open_ = [n] * n, []
    for i in range(n):
        r = rank[i]
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def stretches(words: list[str], rounds: int = CUTS) -> Iterator[tuple[int, list[str]]]:
    """(first word's number, words) of the pieces that may hold a run, cut at rare words up to ``rounds`` times over."""
    todo = [(0, words, rounds)]
    while todo:
        at, piece, left = todo.pop()
        if len(piece) < LEAST:
            continue
        times = Counter(piece)
        rare = {w for w, n in times.items() if n < TIMES}
        if not rare or not left:
            yield at, piece
        elif len(rare) < len(times):
            cuts = [k for k, w in enumerate(piece) if w in rare]
            for a, b in zip([-1, *cuts], [*cuts, len(piece)]):
                if b - a > LEAST:
                    todo.append((at + a + 1, piece[a + 1:b], left - 1))


class Search:
    """Stretches of texts whose trees are built and whose candidates are extended together."""

    def __init__(self):
        self.words, self.base = 0, [0, 0]
        self.tours: tuple[list, list] = ([], [])
        self.found: list[tuple] = []  # per stretch: text, first word, candidates and their places in the tours

    def add(self, text: int, at: int, words: list[str]) -> None:
        number: dict[str, int] = {}
        s = [number.setdefault(w, len(number) + 1) for w in words]
        n = len(s)
        depths, place, order, opposite = SuffixTree(s).tour()
        i = np.tile(np.arange(n), 2)
        j = np.array(next_smaller(order, n) + next_smaller(opposite, n))
        use = (j < n) & ((j - i) * TIMES <= n)
        i, j = i[use], j[use]
        back, place_back, _, _ = SuffixTree(s[::-1]).tour(False)
        self.found.append((np.full(len(i), text), np.full(len(i), at), i, j, place[i] + self.base[0], place[j] + self.base[0],
                           place_back[n - i] + self.base[1], place_back[n - j] + self.base[1]))
        for k, tour in enumerate((depths, back)):
            self.tours[k].append(tour)
            self.base[k] += len(tour)
        self.words += n

    def runs(self) -> dict[int, list[tuple[int, int, int]]]:
        """(start, length, period) of each text's runs, by start, then period."""
        if not self.found:
            return {}
        text, at, i, j, *places = (np.concatenate(x) for x in zip(*self.found))
        right = Depths(np.concatenate(self.tours[0])).least(*places[:2])
        left = Depths(np.concatenate(self.tours[1])).least(*places[2:])
        period, start, length = j - i, i - left, j + right - i + left
        use = length >= np.maximum(LEAST, TIMES * period)
        out: dict[int, list] = {}
        for t, *run in np.unique(np.stack([text, at + start, period, length], 1)[use], axis=0).tolist():
            out.setdefault(t, []).append((run[0], run[2], run[1]))
        return out


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return " ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return " ".join([w for w, n in zip(words, np.cumsum(gone[:-1]).tolist()) if not n])


def _searched(batches):
    for b in batches:
        ids, texts = b.column("doc_id"), b.column("text")
        rows, search, begin, size = [], Search(), 0, 0
        for k in range(b.num_rows):
            words = _WORD.findall(texts[k].as_py() or "")
            rows.append(words)
            size += len(words)
            for at, piece in stretches(words):
                search.add(k - begin, at, piece)
            if size >= HELD or k + 1 == b.num_rows:
                found = search.runs()
                listed = [found.get(r, []) for r in range(len(rows))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(begin, len(rows)), pa.array([len(w) for w in rows], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), x)) for x in own] for own in listed], RUNS),
                     pa.array([_collapsed(w, own) for w, own in zip(rows, listed)], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                rows, search, begin, size = [], Search(), k + 1, 0


RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per document: all runs by start, then period, and the text without their repetitions."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_searched, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def planted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): where the id's crc32 ends in 0, the words from one on repeat with a period, both drawn from the crc32."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i)))
        return F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text"))

    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, repeated)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = runs(planted(table(spark, sf_dir, "documents")))
    best = F.expr("array_sort(runs, (x, y) -> CASE WHEN x.length <> y.length THEN int(sign(y.length - x.length)) "
                  "WHEN x.start <> y.start THEN int(sign(x.start - y.start)) ELSE int(sign(x.period - y.period)) END)[0]")
    best = F.when(F.size("runs") > 0, best)
    lines = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
