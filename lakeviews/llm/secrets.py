"""Secret scan by grammar inference.

The base patterns label credentials in the corpus.  Spark counts the prefixes
of their character-class strings; the prefix tree of one kind (states that at
least 1 in ``1 / MIN_SHARE`` of its credentials pass, and what follows them:
rarer states are leaves, which keep their outgoing counts) is merged into a
probabilistic automaton: states whose outgoing frequencies are statistically
compatible (Hoeffding bound, recursively) become one.  Every candidate, a
token of 16 or more credential characters with a letter and a digit, is scored
by its likelihood per character under each automaton.  A candidate at least as
likely as all but 1 % of the kind's labelled credentials is a learned span.
Candidates are the runs of credential characters, without what base spans take
of them; a run that isn't a learned span is tried without punctuation at its
ends, then in its parts between ``=``, ``/`` and ``.``, one mark after the other.

Defined results: null texts are empty; texts without a match give 0 counts, an
empty span list and the digest of the empty string; a kind with fewer than
``least_labelled`` credentials infers no automaton and adds nothing, and
``learned_kinds`` names the kinds that did; repeated rows give repeated results;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm.common import save, table

# The base patterns; kind, pattern, least length of the value.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"(AKIA[A-Z0-9]+)"),
    "hex": re.compile(r"([0-9a-f]+)"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Runs of hex digits or key characters below the least length are never kept, so only longer ones are looked for.
SEARCH = PATTERNS | {"hex": re.compile(r"([0-9a-f]{24,})"), "access": re.compile(r"(AKIA[A-Z0-9]{16,})")}
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
LENGTH = 16  # of a candidate, at least
MARKS = "+/_.=-"  # tried without at both ends
SPLITS = "=/."
WORTH = r"(?i:password|passwd|secret|token|api_?key)|[A-Za-z0-9+/_.=-]{16,}"

MIN_SHARE = 0.002  # of a kind's credentials that pass a state whose successors come to the driver, at least
MIN_LABELLED = 5  # credentials of a kind from which an automaton is inferred
DEPTH = 64  # of the prefix tree; longer credentials go on in the automaton
ALPHA = 1e-3  # of the compatibility test
SMOOTH = 1e-4
RARE = 0.01

# Character classes, their symbol and size.
CLASSES = {"0123456789": "9", "abcdef": "f", "ghijklmnopqrstuvwxyz": "z", "ABCDEF": "F", "GHIJKLMNOPQRSTUVWXYZ": "Z",
           "+/": "+", "=": "=", "_-": "-", ".": "."}
SYMBOL = {c: s for chars, s in CLASSES.items() for c in chars}
SIZE = {s: len(chars) for chars, s in CLASSES.items()}
END = "$"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of the base patterns, by start, then kind."""
    found = []
    for k, kind in enumerate(KINDS):
        found += [(m.start(), k, m.end(), m[1]) for m in SEARCH[kind].finditer(text) if len(m[1]) >= LEAST[kind]]
    return sorted(found)


def shape(value: str) -> str:
    return "".join(map(SYMBOL.__getitem__, value))


def _worth(column: pa.Array) -> np.ndarray:
    """Rows that may hold a base match or a candidate."""
    return np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, WORTH), False).to_numpy(zero_copy_only=False))


def _labelled(batches):
    for b in batches:
        column = b.column("text")
        found = {(KINDS[k], shape(v), hashlib.md5(v.encode(), usedforsecurity=False).digest()) for i in _worth(column) for _, k, _, v in base_spans(column[int(i)].as_py())}
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in enumerate((pa.string(), pa.string(), pa.binary()))], ["kind", "shape", "value"])


def credentials(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, shape, n): labelled credentials of all documents as class strings, with their number.

    A credential counts once, however many copies of its document there are:
    the test for compatible states takes credentials as drawn one by one.
    """
    rows = docs.select(F.col(text).alias("text")).mapInArrow(_labelled, "kind string, shape string, value binary")
    return rows.distinct().groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("n"))


def prefixes(counted: DataFrame, least_labelled: int = MIN_LABELLED) -> DataFrame:
    """(kind, prefix, passed, ended, follows) of prefix-tree states that enough credentials pass, and of all their children.

    ``follows`` counts the next symbols of a state, whether or not the states they lead to are listed.
    """
    depth = F.least(F.length("shape"), F.lit(DEPTH))
    each = counted.select("kind", "shape", "n", F.explode(F.sequence(F.lit(0), depth)).alias("d"))
    steps = (each.groupBy("kind", F.expr("substring(shape, 1, d)").alias("prefix"), F.expr("substring(shape, d + 1, 1)").alias("symbol"))
             .agg(F.sum("n").alias("n")))
    states = steps.groupBy("kind", "prefix").agg(
        F.sum("n").alias("passed"), F.coalesce(F.sum(F.when(F.col("symbol") == "", F.col("n"))), F.lit(0)).alias("ended"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("symbol") != "", F.struct("symbol", "n"))))).alias("follows"))
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    states = save(states.join(F.broadcast(total), "kind").filter(F.col("total") >= least_labelled), "secret-states")  # a row per kind: three
    often = states.filter(F.col("passed") >= F.greatest(F.lit(2.0), F.col("total") * MIN_SHARE)).select("kind", F.col("prefix").alias("parent"))
    parent = F.when(F.col("prefix") != "", F.expr("substring(prefix, 1, length(prefix) - 1)")).otherwise("")
    # At most DEPTH / MIN_SHARE rows a kind are broadcast.  A state that is passed often has a parent that is.
    listed = states.withColumn("parent", parent).join(F.broadcast(often), ["kind", "parent"], "left_semi")
    return listed.select("kind", "prefix", "passed", "ended", "follows")


class Automaton:
    """Probabilistic automaton merged from a prefix tree {prefix: (passed, ended)} or {prefix: (passed, ended, follows)}.

    ``follows`` counts next symbols, also those whose states the tree doesn't
    list; without it the listed children are counted.  States are tested in order of their prefix: each is merged into the first
    compatible state already kept, and so are their successors, or is kept.
    """

    def __init__(self, tree: dict[str, tuple[int, int]]):
        self.passed = {p: x[0] for p, x in tree.items()}
        self.ended = {p: x[1] for p, x in tree.items()}
        self.next: dict[str, dict[str, str]] = {p: {} for p in tree}
        self.counts: dict[str, dict[str, int]] = {p: dict(x[2]) if len(x) > 2 else {} for p, x in tree.items()}
        for p in sorted(tree, key=len):
            if p and p[:-1] in tree:
                self.next[p[:-1]][p[-1]] = p
                self.counts[p[:-1]].setdefault(p[-1], tree[p][0])
        kept: list[str] = []
        todo = [""] if "" in tree else []
        while todo:
            p = todo.pop(0)
            into = next((q for q in kept if self._compatible(q, p)), None)
            if into is None:
                kept.append(p)
                todo += [t for t in self.next[p].values() if t not in kept and t not in todo]
                todo.sort(key=lambda t: (len(t), t))
            else:
                self._merge(into, p, kept, todo)
        self.states = kept

    def _differs(self, a: int, m: int, b: int, n: int) -> bool:
        if m == 0 or n == 0:
            return False
        return abs(a / m - b / n) > math.sqrt(math.log(2 / ALPHA) / 2) * (m ** -0.5 + n ** -0.5)

    def _compatible(self, q: str, p: str, depth: int = 0) -> bool:
        if q == p or depth > DEPTH:
            return True
        m, n = self.passed[q], self.passed[p]
        if self._differs(self.ended[q], m, self.ended[p], n):
            return False
        for s in self.counts[q].keys() | self.counts[p].keys():
            if self._differs(self.counts[q].get(s, 0), m, self.counts[p].get(s, 0), n):
                return False
            if s in self.next[q] and s in self.next[p] and not self._compatible(self.next[q][s], self.next[p][s], depth + 1):
                return False
        return True

    def _merge(self, q: str, p: str, kept: list[str], todo: list[str]) -> None:
        """Fold state p, and what only follows it, into q."""
        stack, done = [(q, p)], set()
        for d in self.next.values():
            for s, t in d.items():
                if t == p:
                    d[s] = q
        while stack:
            a, b = stack.pop()
            if a == b or (a, b) in done:
                continue
            done.add((a, b))
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for s, n in self.counts[b].items():
                self.counts[a][s] = self.counts[a].get(s, 0) + n
            for s, t in self.next[b].items():
                if s not in self.next[a]:
                    self.next[a][s] = t
                    if a in kept and t not in kept and t not in todo:
                        todo.append(t)
                elif t not in kept:
                    stack.append((self.next[a][s], t))
        todo.sort(key=lambda t: (len(t), t))

    def table(self) -> dict:
        """state -> (symbol -> (log-probability of a character, next state)); what isn't seen keeps the state."""
        out = {}
        for p in {t for d in self.next.values() for t in d.values()} | {""}:
            n = max(1, self.passed[p])
            row = {}
            for s, size in SIZE.items():
                prob = (1 - SMOOTH * len(SIZE)) * self.counts[p].get(s, 0) / n + SMOOTH
                row[s] = (math.log(prob / size), self.next[p].get(s, p if not self.next[p] else ""))
            out[p] = row
        return out


def likelihood(automaton: dict, shaped: str) -> float:
    """Mean log-likelihood of a character."""
    state, total = "", 0.0
    for s in shaped:
        logp, state = automaton[state][s]
        total += logp
    return total / max(1, len(shaped))


def infer(docs: DataFrame, text: str = "text", least_labelled: int = MIN_LABELLED) -> dict[str, tuple[dict, float]]:
    """kind -> (automaton's table, least likelihood of a secret), from all documents' labelled credentials."""
    return learned(save(credentials(docs, text), "secret-shapes"), least_labelled)


def learned(counted: DataFrame, least_labelled: int = MIN_LABELLED) -> dict[str, tuple[dict, float]]:
    """``infer`` from (kind, shape, n), a written table."""
    trees: dict[str, dict] = {}
    # At most DEPTH / MIN_SHARE states a kind and their children come to the driver.
    for r in prefixes(counted, least_labelled).collect():
        trees.setdefault(r["kind"], {})[r["prefix"]] = (r["passed"], r["ended"], r["follows"])
    tables = {kind: Automaton(tree).table() for kind, tree in sorted(trees.items())}
    if not tables:
        return {}

    def scored(batches):
        for b in batches:
            kinds, shapes, n = (b.column(c).to_pylist() for c in ("kind", "shape", "n"))
            # thousandths, so that equal values meet before the shuffle
            values = [round(1000 * likelihood(tables[k], s)) if k in tables else None for k, s in zip(kinds, shapes)]
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values, pa.int64()), pa.array(n, pa.int64())], ["kind", "value", "n"])

    hist = counted.mapInArrow(scored, "kind string, value long, n long").filter("value IS NOT NULL").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    out = {}
    by: dict[str, list] = {}
    # Values lie between 0 and the log of SMOOTH / 20 in thousandths: some 12,000 rows a kind at most.
    for r in hist.collect():
        by.setdefault(r["kind"], []).append((r["value"], r["n"]))
    for kind, rows in by.items():
        left = RARE * sum(n for _, n in rows)
        for value, n in sorted(rows):
            left -= n
            if left < 0:
                break
        out[kind] = (tables[kind], (value - 1) / 1000)
    return out


def _runs(text: str, base: list):
    """(start, end) of the runs of credential characters, and of what base spans leave of them."""
    taken, i = sorted((s, e) for s, _, e, _ in base), 0
    for m in CANDIDATE.finditer(text):
        at = m.start()
        while i < len(taken) and taken[i][0] < m.end():
            if taken[i][0] - at >= LENGTH:
                yield at, taken[i][0]
            at = max(at, taken[i][1])
            if taken[i][1] > m.end():  # goes on in later runs
                break
            i += 1
        if m.end() - at >= LENGTH:
            yield at, m.end()


def _parts(text: str, start: int, end: int, mark: str):
    for part in text[start:end].split(mark):
        yield start, start + len(part)
        start += len(part) + 1


def spans_of(text: str, model: dict[str, tuple[dict, float]]) -> tuple[list, list]:
    """(base spans, learned spans); a learned one is (start, kind, end, likelihood)."""
    base, learned = base_spans(text), []

    def scored(start: int, end: int) -> bool:
        value = text[start:end]
        if len(value) < LENGTH or not (re.search("[0-9]", value) and re.search("[A-Za-z]", value)):
            return False
        shaped = shape(value)
        best = max(((likelihood(t, shaped) - least, kind) for kind, (t, least) in model.items()))
        if best[0] >= 0:
            learned.append((start, f"learned_{best[1]}", end, best[0]))
        return best[0] >= 0

    def tried(start: int, end: int, splits: str) -> None:
        if end - start < LENGTH or scored(start, end):
            return
        value = text[start:end]
        left, right = start + len(value) - len(value.lstrip(MARKS)), start + len(value.rstrip(MARKS))
        if (left, right) != (start, end) and scored(left, right):
            return
        for k, mark in enumerate(splits):
            if mark in value:
                for s, e in _parts(text, start, end, mark):
                    tried(s, e, splits[k + 1:])
                return

    for start, end in _runs(text, base) if model else ():
        tried(start, end, SPLITS)
    return base, learned


def scan(docs: DataFrame, model: dict | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_learned, learned_kinds), one row per document; positions in code points."""
    model = infer(docs, text) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    empty = hashlib.sha256(b"").hexdigest()

    def scanned(batches):
        for b in batches:
            column, n = b.column("text"), b.num_rows
            counts, digests, joined, added = np.zeros((3, n), np.int64), [empty] * n, [""] * n, [0] * n
            for i in map(int, _worth(column)):
                base, learned = spans_of(column[i].as_py(), shared.value)
                for _, k, _, _ in base:
                    counts[k, i] += 1
                named = [(s, KINDS[k], e) for s, k, e, _ in base]
                if named:
                    digests[i] = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in named).encode()).hexdigest()
                named = sorted(named + [(s, k, e) for s, k, e, _ in learned], key=lambda x: (x[0], KINDS.index(x[1]) if x[1] in KINDS else 3, x[1]))
                joined[i], added[i] = ",".join(f"{k}:{s}:{e}" for s, k, e in named), len(learned)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, counts), pa.array(digests, pa.string()), pa.array(joined, pa.string()),
                                              pa.array(added, pa.int64())],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"])

    found = rows.mapInArrow(scanned, f"doc_id {dict(rows.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, "
                                     "base_sha256 string, spans string, n_learned long")
    return found.withColumn("learned_kinds", F.lit(",".join(sorted(model))))


def redact(docs: DataFrame, model: dict | None = None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The documents with every span's text replaced by ``mark``; all rows and columns stay."""
    model = infer(docs, text) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def cleaned(value: str) -> str:
        base, learned = spans_of(value, shared.value)
        out, at = [], 0
        for s, _, e, _ in sorted([*base, *learned], key=lambda x: (x[0], -x[2])):
            if e > at:
                out += [value[at:s], mark] if s >= at else []
                at = e
        return "".join([*out, value[at:]])

    def masked(batches):
        for b in batches:
            column = b.column(text)
            worth = set(map(int, _worth(column)))
            texts = pa.array([cleaned(x) if i in worth else x for i, x in enumerate(column.to_pylist())], pa.string())
            yield b.set_column(b.schema.get_field_index(text), text, texts)

    return docs.mapInArrow(masked, docs.schema)


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
