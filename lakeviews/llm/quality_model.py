"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words.  Every passage becomes a
vector of character and word statistics and hashed words, encoded by a learned
layer; gated attention (tanh times sigmoid) weighs the encodings, and the
weighted sum gives the document's score.  Only document labels are used.  A
bounded sample of labelled rows is turned into vectors in parallel and fitted
by one task with Adam, in a fixed order and from a fixed start.

Defined results: null, empty and wordless texts have no passage and get the
score of an empty bag; without labelled rows every score is 1 (nothing is
rejected); repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import held_out, table
from lakeviews.llm.training import SAMPLE, labelled

PASSAGE = 64
HASHED = 32
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE, DECAY = 25, 64, 5e-3, 1e-4
KEEP = 0.3

_CLASS = np.full(256, 5, np.uint8)  # 0 symbol, 1 digit, 2 capital, 3 other punctuation, 4 not ASCII, 5 the rest
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 3
_CLASS[np.frombuffer(b"#*$%&|<>", np.uint8)] = 0
_CLASS[ord("0"):ord("9") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[128:] = 4
STATS = 12
WIDTH = STATS + HASHED


def vectors(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages x WIDTH, index of each text's first passage and one more) of whole texts."""
    w = bw.words(raw, offs)
    per_row = np.diff(w.first)
    bags = np.concatenate([[0], np.cumsum(-(-per_row // PASSAGE))])
    n = int(bags[-1])
    out = np.zeros((n, WIDTH), np.float32)
    if not n:
        return out, bags
    place = np.arange(len(w.row)) - w.first[w.row]
    passage = bags[w.row] + place // PASSAGE
    begin = np.flatnonzero(np.diff(passage, prepend=-1))
    count = np.diff(np.append(begin, len(passage))).astype(np.float64)
    length = (w.end - w.start).astype(np.float64)
    chars = np.add.reduceat(length, begin)
    last = np.append(begin[1:], len(passage)) - 1
    kind = _CLASS[raw]
    for k in range(5):
        upto = np.concatenate([[0], np.cumsum(kind == k, dtype=np.int64)])
        out[:, k] = (upto[w.end[last]] - upto[w.start[begin]]) / chars
    out[:, 5] = chars / count / 10
    out[:, 6] = np.sqrt(np.maximum(0, np.add.reduceat(length ** 2, begin) / count - (chars / count) ** 2)) / 10
    own = bw.distinct(passage, w.hash)[0]
    out[:, 7] = np.bincount(own, minlength=n) / count
    in_text = bw.distinct(w.row, w.hash)[0]
    whole = np.bincount(in_text, minlength=len(per_row)) / np.maximum(per_row, 1)
    out[:, 8] = np.repeat(whole, np.diff(bags))
    alone = (w.end - w.start) == 1
    out[:, 9] = np.add.reduceat(alone.astype(np.float64), begin) / count
    line = np.concatenate([[0], np.cumsum(raw == 10, dtype=np.int64)])
    out[:, 10] = (line[w.end[last]] - line[w.start[begin]]) / count
    out[:, 11] = np.log1p(np.repeat(per_row, np.diff(bags))) / 10
    bucket = passage * HASHED + (w.hash & np.uint64(HASHED - 1)).astype(np.int64)
    sign = np.where(w.hash >> np.uint64(63), 1.0, -1.0)
    out[:, STATS:] = (np.bincount(bucket, sign, n * HASHED).reshape(n, HASHED) / np.sqrt(count)[:, None])
    return out, bags


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Attention:
    """The network; ``p`` holds its parameters."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def start(cls, x: np.ndarray) -> Attention:
        r = np.random.RandomState(7)
        return cls({
            "mean": x.mean(0), "spread": x.std(0) + 1e-3,
            "W": r.normal(0, WIDTH ** -0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN),
            "V": r.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)), "U": r.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTENTION)),
            "w": r.normal(0, ATTENTION ** -0.5, ATTENTION), "c": r.normal(0, HIDDEN ** -0.5, HIDDEN), "c0": np.zeros(1),
        })

    def forward(self, x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logits of the bags, and what the gradient needs."""
        p, n = self.p, len(bags) - 1
        bag = np.repeat(np.arange(n), np.diff(bags))
        x = np.clip((x - p["mean"]) / p["spread"], -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = np.exp(np.clip((t * g) @ p["w"], -30, 30))
        a = e / np.bincount(bag, e, n)[bag] if n else e
        z = np.zeros((n, HIDDEN))
        np.add.at(z, bag, a[:, None] * h)
        return z @ p["c"] + p["c0"], (x, h, t, g, a, z, bag)

    def gradient(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, (x, h, t, g, a, z, bag) = self.forward(x, bags)
        d = (_sigmoid(logit) - y) / len(y)
        dz = d[:, None] * p["c"]
        dh = a[:, None] * dz[bag]
        da = (h * dz[bag]).sum(1)
        ds = a * (da - np.bincount(bag, a * da, len(y))[bag])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - h * h)
        return {"W": x.T @ dpre, "b": dpre.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (ds[:, None] * t * g).sum(0),
                "c": z.T @ d, "c0": np.array([d.sum()])}


def train(x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> Attention:
    net, r = Attention.start(x), np.random.RandomState(11)
    first, second, step = {}, {}, 0
    for _ in range(EPOCHS):
        order = r.permutation(len(y))
        for at in range(0, len(y), BATCH):
            chosen = order[at:at + BATCH]
            size = np.diff(bags)[chosen]
            rows = np.repeat(bags[chosen] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            step += 1
            for k, g in net.gradient(x[rows], np.concatenate([[0], np.cumsum(size)]), y[chosen]).items():
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                move = first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                net.p[k] = net.p[k] - RATE * (move + DECAY * net.p[k])
    return net


def _vectorised(batches):
    for b in batches:
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            x, bags = vectors(raw, offs)
            flat = pa.ListArray.from_arrays(pa.array(bags * WIDTH, pa.int32()), pa.array(x.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([b.slice(lo, hi - lo).column("label"), flat], ["label", "x"])


def _fitted(batches):
    labels, parts, sizes = [], [], [0]
    for b in batches:
        labels += b.column("label").to_pylist()
        parts += [v.values.to_numpy().reshape(-1, WIDTH) for v in b.column("x")]
    if labels:
        sizes = np.concatenate([[0], np.cumsum([len(v) for v in parts])])
        x = np.concatenate(parts).astype(np.float64)
        if len(x):
            net = train(x, sizes, np.array(labels, np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(list(net.p)), pa.array([v.ravel().tolist() for v in net.p.values()], pa.list_(pa.float64()))], ["name", "values"])


def fit(sample: DataFrame) -> Attention | None:
    rows = sample.mapInArrow(_vectorised, "label int, x array<float>")
    found = {r["name"]: np.array(r["values"]) for r in rows.coalesce(1).mapInArrow(_fitted, "name string, values array<double>").collect()}
    if not found:
        return None
    shapes = {"W": (WIDTH, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION)}
    return Attention({k: v.reshape(shapes.get(k, v.shape)) for k, v in found.items()})


def score(docs: DataFrame, net: Attention | None, text: str = "text", into: str = "score") -> DataFrame:
    """The documents with a column ``into``, the score of their whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(net.p if net else None)

    def scored(batches):
        model = Attention(shared.value) if shared.value else None
        for b in batches:
            out = np.ones(b.num_rows)
            for lo, hi, raw, offs in bw.chunks(b.column(text)) if model else ():
                out[lo:hi] = _sigmoid(model.forward(*vectors(raw, offs))[0])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], [*b.schema.names, into])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField(into, DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    out = score(docs.select("doc_id", "text"), fit(labelled(docs, labels, label, sample)))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))


def accepted(docs: DataFrame, net: Attention | None, text: str = "text") -> DataFrame:
    """The documents that score KEEP at least, with the columns they came with."""
    mark = "score"
    while mark in docs.columns:
        mark = f"_{mark}"
    return score(docs, net, text, mark).filter(F.col(mark) >= KEEP).drop(mark)


def op7_quality_model(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
