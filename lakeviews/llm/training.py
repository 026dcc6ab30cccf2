"""Labelled rows for the classifiers: a bounded, reproducible sample of those not held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.llm.common import hash60, held_out

#: Documents a classifier is fitted on, at most: those with the least hash of the id.
SAMPLE = 8_000


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, label), ``sample`` rows at most, none held out.

    An id labelled more than once has the highest label; rows without id or
    label are left out.
    """
    known = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    chosen = known.withColumn("h", hash60(F.col("id"))).orderBy("h", "id").limit(sample)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample's ids are at most ``sample`` rows: a bounded broadcast.
    return (rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
            .select("doc_id", "text", "label", "h").orderBy("h", "doc_id", F.md5("text")).limit(sample).select("doc_id", "text", "label"))
