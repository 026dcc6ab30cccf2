"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

# A side is broadcast only if it was written and counted, and has at most so
# many rows; beyond that the join is left to Spark's own sized choice.
BROADCAST_ROWS = 100_000

# Rows of an Arrow batch, which the JVM and a Python worker hold at once: texts are long.
ARROW_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``ARROW_ROWS`` rows in this session, from now on."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ARROW_ROWS:
        spark.conf.set(setting, str(ARROW_ROWS))


def slices(batch: pa.RecordBatch, limit: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about ``limit`` bytes of text; one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join with ``small`` (a written table) broadcast when its counted rows are within the bound."""
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id is never held out."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(F.encode(col.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, computed once (a lambda's variable isn't computed anew for each use)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*cols: Column) -> Column:
    """60-bit hash of the first non-null column (as text), the same in any SQL engine with md5."""
    return F.conv(F.substring(F.md5(F.coalesce(*[c.cast("string") for c in cols], F.lit(""))), 1, 15), 16, 10).cast("long")
