"""Keep the last row per primary key.

"Last" is by an explicit sequence column: rows read from files carry their
input position (file path, block start, position inside the split) taken
before any shuffle; other callers pass any total order.  The operator is a
``groupBy(keys).agg(max_by(struct(row), seq))``: ``max_by`` is a
declarative aggregate, so Spark combines map-side and a key holding a third
of all rows costs one partial row per partition instead of one huge task.
NULL keys form one group each, as in pandas.

A sequence column named as text is only carried as what ``max_by`` orders by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEQ = "_input_seq"


def with_input_order(df: DataFrame) -> DataFrame:
    """Attach the input position of every row of a file scan (call before any shuffle).

    Files written by Spark are ordered by their part number, not by its text:
    ``part-100000`` comes after ``part-99999``.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("long")
    return df.withColumn(SEQ, F.struct(
        part.alias("part"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos")))


def dedupe_keep_last(df: DataFrame, primary_key, seq: Column | str | None = None) -> DataFrame:
    """Drop all but the last row per key; unchanged if no key column is present.

    ``seq`` defaults to the ``_input_seq`` column added by ``with_input_order``.
    """
    keys = [k for k in primary_key if k in df.columns]
    if not keys:
        return df
    seq = SEQ if seq is None else seq
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    aside = [seq] if isinstance(seq, str) and seq in rest else []  # pruned if the caller drops it
    row = [c for c in rest if c not in aside]
    last = F.max_by(F.struct(*row) if row else F.lit(True), F.col(seq) if isinstance(seq, str) else seq)
    kept = df.groupBy(*keys).agg(last.alias("_last"), *[F.max(c).alias(c) for c in aside])
    return kept.select(*[F.col(f"_last.{c}").alias(c) if c in row else F.col(c) for c in df.columns])


def total_order(df: DataFrame, exclude=()) -> Column:
    """A sequence over all non-excluded columns (a total order when no two rows are equal)."""
    return F.struct(*[F.col(c) for c in df.columns if c not in exclude])
