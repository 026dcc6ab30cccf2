"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct buckets (2^20) of words, word pairs and pairs with
one word between, lower case, punctuation apart.  All of them are learned from,
however few texts hold one: per-coordinate rates and L1 alone leave few
non-zero weights; only those are broadcast.  A bounded sample of
labelled rows is featurised in parallel and fitted by one task in hash order.

Defined results: null and empty texts have no features and get the
intercept's score; without labelled rows every score is 0; repeated rows score
alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm import bytewords as bw
from lakeviews.llm.common import held_out, table
from lakeviews.llm.training import SAMPLE, labelled

BUCKETS = 1 << 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 20.0, 0.5
EPOCHS = 5


def _features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram and skip-gram."""
    w = bw.words(raw, offs, bw.PUNCTUATION, lower=True)
    parts = [(w.row, w.hash), bw.grams(w, 2), bw.grams(w, 2, gap=2)]
    return np.concatenate([r for r, _ in parts]), np.concatenate([(h >> np.uint64(44)).astype(np.int64) for _, h in parts])


def _featurised(batches):
    for b in batches:
        for lo, hi, raw, offs in bw.chunks(b.column("text")):
            row, bucket = bw.distinct(*_features(raw, offs))
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            part = b.slice(lo, hi - lo)
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), lists], ["doc_id", "label", "buckets"])


class Ftrl:
    """McMahan et al.'s update: weights follow from the sums z and n of each coordinate."""

    def __init__(self, size: int, l1: float = L1):
        self.z, self.n, self.l1 = np.zeros(size), np.zeros(size), l1

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def _fitted(batches):
    rows = [(label, x) for b in batches for label, x in zip(b.column("label").to_pylist(), (s.values.to_numpy() for s in b.column("buckets")))]
    model = Ftrl(BUCKETS + 1)  # the last coordinate is the intercept
    for _ in range(EPOCHS):
        for label, x in rows:
            model.learn(np.append(x, BUCKETS), label)
    at = np.flatnonzero(model.weights(np.arange(BUCKETS + 1)))
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(model.weights(at))], ["at", "weight"])


def fit(sample: DataFrame) -> dict[int, float]:
    """Non-zero weights by bucket from (doc_id, text, label)."""
    rows = sample.mapInArrow(_featurised, f"doc_id {dict(sample.dtypes)['doc_id']}, label int, buckets array<int>")
    found = rows.coalesce(1).mapInArrow(_fitted, "at int, weight double").collect()
    return {r["at"]: r["weight"] for r in found}


def score(docs: DataFrame, weights: dict[int, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of whole texts."""
    dense = np.zeros(BUCKETS + 1, np.float32)
    for k, v in weights.items():
        dense[k] = v
    at = np.flatnonzero(dense)
    shared = docs.sparkSession.sparkContext.broadcast((at, dense[at]))
    trained = bool(weights)

    def scored(batches):
        lookup = np.zeros(BUCKETS + 1, np.float32)
        lookup[shared.value[0]] = shared.value[1]
        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi, raw, offs in bw.chunks(b.column("text")):
                row, bucket = _features(raw, offs)
                hit = np.flatnonzero(lookup[bucket])
                row, bucket = bw.distinct(row[hit], bucket[hit])
                total = np.bincount(row, lookup[bucket], hi - lo) + lookup[BUCKETS]
                out[lo:hi] = 1 / (1 + np.exp(-np.clip(total, -35, 35))) if trained else 0.0
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scored, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    out = score(docs, fit(labelled(docs, labels, label, sample)))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
