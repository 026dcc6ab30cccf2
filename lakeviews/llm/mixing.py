"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash.  The words of each source are summed
by hash bucket (4,096 buckets: map-side partial sums, so a hot source costs a
few thousand rows); the running sum finds the bucket in which a source's
budget ends, only that bucket is refined (three levels, 36 bits), and documents
are kept by comparing their hash with the threshold.  Nothing is sorted, and
thresholds are nested: a smaller budget keeps a subset of a larger one's
documents.

Defined results: a null text has size 0; null sources are one source, last in
order; documents with the same id (or, where it is null, the same text) have
one hash and are taken together; an empty table gives no rows; columns of the
input other than those named are ignored.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeviews.llm.common import hash60, join_small, n_words, save, table

BITS = 12  # of a level
LEVELS = 3
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MAX_EPOCHS = 2


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, bucket): one pass over the texts; bucket has LEVELS * BITS bits."""
    h = F.shiftright(hash60(F.col(doc_id), F.col(text)), 60 - LEVELS * BITS)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       n_words(F.col(text)).alias("size"), h.alias("bucket"))


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size): one row per source.

    Sources in code-point order (null last) take the weights in turn and share
    ``share`` of all words.  A target stops at ``max_epochs`` times its
    source's size and the excess is shared anew by weight: with sources in
    order of cap per weight, a source is capped exactly when its cap is below
    its part of what the sources before it have left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long")
    everything = Window.partitionBy()
    rows = per_source.withColumn("weight", weight)
    rows = rows.withColumns({
        "total": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything),
        "cap": F.col("source_size") * max_epochs,
    })
    before = (Window.orderBy((F.col("cap").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
                             "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0))})
    whole = F.col("total").cast("double") * share.numerator / share.denominator
    capped = (F.col("cap").cast("double") * (F.col("all_weight") - F.col("weight_before"))
              < F.col("weight") * (whole - F.col("cap_before")))
    rows = rows.withColumn("capped", capped)
    left = whole - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    free = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    target = (F.when(F.col("capped") | (F.col("source_size") == 0), F.col("cap").cast("double"))
              .otherwise(F.least(F.col("weight") * left / F.when(free > 0, free), F.col("cap").cast("double"))))
    return rows.select("source", "source_size", target.alias("target"))


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, full, threshold) from (source, source_size, target).

    ``full`` whole passes are taken of every document, and one more of the
    documents whose bucket is below ``threshold``.
    """
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = goals.withColumn("full", full).withColumns({
        "left": F.col("target") - F.col("full") * F.col("source_size"), "prefix": F.lit(0).cast("long")})
    for level in range(LEVELS):
        state = save(state, f"mix-state{level}")
        shift = (LEVELS - 1 - level) * BITS
        inside = sized if level == 0 else (
            join_small(sized.alias("d"), state.select("source", "prefix").alias("s"),
                       _same_source("d", "s") & (F.shiftright("d.bucket", shift + BITS) == F.col("s.prefix")), "left_semi"))
        hist = inside.groupBy("source", F.shiftright("bucket", shift).alias("part")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        hist = hist.withColumn("upto", running)
        last = level == LEVELS - 1
        found = (hist.alias("h").join(state.alias("s"), _same_source("h", "s"))
                 .filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
                 .select("s.source", F.col("part").alias("found"), (F.col("upto") - F.col("words")).alias("skipped"),
                         F.col("upto").alias("reached")))
        over = F.when(F.col("reached") - F.col("left") < F.col("left") - F.col("skipped"), 1).otherwise(0)
        state = (state.alias("s").join(found.alias("f"), _same_source("s", "f"), "left")
                 .select("s.source", "source_size", "target", "full",
                         (F.col("left") - F.coalesce(F.col("skipped"), F.lit(0))).alias("left"),
                         (F.coalesce(F.col("found"), F.lit(0)) + (over if last else 0)).cast("long").alias("prefix")))
    # A source taken as often as allowed has nothing left to take.
    state = state.withColumn("prefix", F.when(F.col("full") >= MAX_EPOCHS, 0).otherwise(F.col("prefix")))
    return save(state.select("source", "source_size", "target", "full", F.col("prefix").alias("threshold")), "mix-thresholds")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document."""
    sized = save(sizes(docs, doc_id, text, source), "mix-sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = thresholds(sized, targets(per_source, weights, share))
    out = join_small(sized.alias("d"), cuts.alias("s"), _same_source("d", "s"))
    copies = F.col("s.full") + F.when(F.col("d.bucket") < F.col("s.threshold"), 1).otherwise(0)
    return out.select("d.doc_id", "d.source", "d.size", "s.source_size", "s.target", copies.alias("copies"),
                      (F.col("d.size") * copies).alias("taken"))


def taken_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
                    doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents that the mix takes, all columns, with ``copies``, how often each is taken (``mix_copies`` if the input has such a column)."""
    sized = save(sizes(docs, doc_id, text, source), "mix-sizes")
    cuts = thresholds(sized, targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share))
    name = "copies" if "copies" not in docs.columns else "mix_copies"
    bucket = F.shiftright(hash60(F.col(f"d.{doc_id}"), F.col(f"d.{text}")), 60 - LEVELS * BITS)
    out = join_small(docs.alias("d"), cuts.alias("s"), F.col(f"d.{source}").cast("string").eqNullSafe(F.col("s.source")))
    copies = F.col("s.full") + F.when(bucket < F.col("s.threshold"), 1).otherwise(0)
    return out.select("d.*", copies.alias(name)).filter(F.col(name) > 0)


def op1_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT) >> 24 AS bucket
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM per_source),
runs AS (
  SELECT *, 2 * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS whole, sum(weight) OVER () AS all_weight
  FROM weighed),
ordered AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    coalesce(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
  FROM runs),
flagged AS (
  SELECT *, cap::DOUBLE * (all_weight - weight_before)::DOUBLE < weight * (whole - cap_before::DOUBLE) AS capped FROM ordered),
goals AS (
  SELECT source, source_size,
    CASE WHEN capped OR source_size = 0 THEN cap::DOUBLE ELSE least(
      weight * (whole - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()::DOUBLE)
        / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0)::DOUBLE, cap::DOUBLE) END AS target
  FROM flagged),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS full_takes FROM goals),
hist AS (SELECT source, bucket, sum(size) AS words FROM sized GROUP BY ALL),
upto AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY bucket) AS reached FROM hist),
cuts AS (
  SELECT b.*, coalesce(u.bucket + CASE WHEN u.reached - (target - full_takes * source_size)
                 < (target - full_takes * source_size) - (u.reached - u.words) THEN 1 ELSE 0 END, 0) AS cut
  FROM budgets b LEFT JOIN upto u ON u.source IS NOT DISTINCT FROM b.source
    AND u.reached > target - full_takes * source_size AND u.reached - u.words <= target - full_takes * source_size)
SELECT d.doc_id, d.size, c.source_size::BIGINT AS source_size, c.target,
  (d.size * (full_takes + CASE WHEN full_takes < 2 AND d.bucket < cut THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
