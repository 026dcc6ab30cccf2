"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Main path: DataFrame functions only.  Per document the rule metrics are counted
in one pass.  Each metric, as an integer, goes into a sketch per language and
source: a histogram whose bins keep the ten highest bits of a value (exact
below 1,024, 0.2 % relative error above).  Such sketches merge by adding
counts, so partial sums are made before the shuffle and a hot group costs a
few thousand rows.  A group with fewer than ``MIN_DOCS`` documents uses the
merged sketch of its language, and a small language that of all documents.
The fences (quartile plus or minus ``SPREAD`` times the interquartile range)
replace fixed cutoffs and are joined back to the documents.

Defined results: null text has no words and fails the base rule; null
language or source is a value of its own; repeated rows are judged alike; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeviews.llm.common import SPACES, WORD, join_small, let, save, table

GRAM = 8
SYMBOLS = "#*$%&|<>"
MIN_DOCS = 200
SPREAD = 4

# metric: (numerator, denominator, least interquartile range in thousandths, side)
METRICS = {
    "symbols": ("n_symbols", "word_chars", 10, "high"),
    "word_length": ("word_chars", "n_words", 500, "both"),
    "repeats": ("n_repeat_words", "n_words", 50, "high"),
    "dup_lines": ("n_dup_lines", "n_lines", 100, "high"),
}


def repeat_words(words: Column) -> Column:
    """Number of words inside any GRAM-word window that occurs twice or more among ``words``."""

    def covered(starts: Column) -> Column:
        # starts ascending: each adds the words up to the next start, GRAM at most
        steps = F.transform(starts, lambda p, i: F.least(F.lit(GRAM), F.coalesce(F.get(starts, i + 1) - p, F.lit(GRAM))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated(windows: Column) -> Column:
        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0))
                .otherwise(let(let(ordered, starts), covered)))

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(hashes, i, GRAM)))

    short = F.size(words) <= GRAM
    return F.when(short, F.lit(0)).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: let(windows(hashes), repeated)))


def metrics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            source: str = "source") -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)."""
    body = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                       F.col(source).cast("string").alias("source"), body.alias("body"))
    words = F.regexp_extract_all("body", F.lit(WORD), F.lit(0))
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))
    counted = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                             repeat_words(w).cast("long").alias("n_repeat_words")))
    lined = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                           (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    out = read.select("doc_id", "lang", "source", counted.alias("w"), lined.alias("x"),
                      F.length(F.translate("body", SPACES, "")).cast("long").alias("word_chars"),
                      (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    return out.select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "x.n_lines", "x.n_dup_lines",
                      "w.n_repeat_words")


def value(metric: str) -> Column:
    """A metric in thousandths, as an integer; null where its denominator is 0."""
    top, below, _, _ = METRICS[metric]
    return F.expr(f"CASE WHEN {below} > 0 THEN (1000 * {top}) DIV {below} END")


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, n): the mergeable sketches, one per language, source and metric."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), value(m).alias("v")) for m in METRICS]))
    v = measured.select("lang", "source", pairs.alias("p")).select("lang", "source", "p.metric", "p.v").filter("v IS NOT NULL")
    low = F.greatest(F.length(F.bin("v")) - 10, F.lit(0))
    kept_bits = F.call_function("shiftleft", F.call_function("shiftright", F.col("v"), low), low)
    return (v.withColumn("bin", kept_bits).groupBy("lang", "source", "metric", "bin")
            .agg(F.count(F.lit(1)).alias("n")))


def _quartiles(bins: DataFrame, keys: list[str]) -> DataFrame:
    by = Window.partitionBy(*keys, "metric")
    merged = bins.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    ranked = merged.withColumns({"upto": F.sum("n").over(by.orderBy("bin")), "docs": F.sum("n").over(by)})
    return ranked.groupBy(*keys, "metric").agg(
        F.first("docs").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("docs") * 3, F.col("bin"))).alias("q3"))


def fences(bins: DataFrame) -> DataFrame:
    """(lang, source, one low and high column per metric): a row per language and source."""
    own = _quartiles(bins, ["lang", "source"])
    of_lang = _quartiles(bins, ["lang"])
    of_all = _quartiles(bins, [])
    joined = (own.alias("o").join(of_lang.alias("l"), (F.col("o.metric") == F.col("l.metric")) & F.col("o.lang").eqNullSafe(F.col("l.lang")))
              .join(of_all.alias("a"), F.col("o.metric") == F.col("a.metric")))

    def chosen(q: str) -> Column:
        return (F.when(F.col("o.docs") >= MIN_DOCS, F.col(f"o.{q}"))
                .when(F.col("l.docs") >= MIN_DOCS, F.col(f"l.{q}")).otherwise(F.col(f"a.{q}")))

    rows = joined.select("o.lang", "o.source", "o.metric", chosen("q1").alias("q1"), chosen("q3").alias("q3"))
    cols = []
    for m, (_, _, least, _) in METRICS.items():
        spread = SPREAD * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        cols += [F.max(F.when(F.col("metric") == m, F.col("q1") - spread)).alias(f"{m}_low"),
                 F.max(F.when(F.col("metric") == m, F.col("q3") + spread)).alias(f"{m}_high")]
    return rows.groupBy("lang", "source").agg(*cols)


def judge(docs: DataFrame, **columns) -> DataFrame:
    """The metrics with ``base_failed`` and ``kept``, one row per document."""
    measured = save(metrics(docs, **columns), "rules-metrics")
    cuts = save(fences(save(sketch(measured), "rules-sketches")), "rules-fences")
    out = join_small(measured.alias("d"), cuts.alias("f"), F.col("d.lang").eqNullSafe(F.col("f.lang"))
                     & F.col("d.source").eqNullSafe(F.col("f.source")))
    out = out.select("d.*", *[f"f.{m}_{side}" for m in METRICS for side in ("low", "high")])
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    inside = F.lit(True)
    for m, (_, _, _, side) in METRICS.items():
        inside = inside & F.coalesce(value(m) <= F.col(f"{m}_high"), F.lit(True))
        if side == "both":
            inside = inside & F.coalesce(value(m) >= F.col(f"{m}_low"), F.lit(True))
    return out.withColumns({"base_failed": base, "kept": ~base & inside})


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP8_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS body FROM documents),
words AS (SELECT rid, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM docs),
grams AS (
  SELECT rid, p, list_slice(w, p, p + 7) AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS p FROM words WHERE len(w) >= 8)),
twice AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM grams),
covered AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + 8)) AS q FROM twice WHERE c > 1) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS x FROM docs) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM docs d JOIN words USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN covered c USING (rid)),
vals AS (
  SELECT rid, lang, source, metric, v FROM (
    SELECT rid, lang, source, unnest(['symbols', 'word_length', 'repeats', 'dup_lines']) AS metric,
      unnest([CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars END, CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words END,
              CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words END, CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines END]) AS v
    FROM m) WHERE v IS NOT NULL),
binned AS (
  SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 10, 0)) << greatest(length(bin(v)) - 10, 0) AS bin, count(*) AS n
  FROM vals GROUP BY ALL),
own AS (
  SELECT lang, source, metric, max(docs) AS docs, min(bin) FILTER (upto * 4 >= docs) AS q1, min(bin) FILTER (upto * 4 >= 3 * docs) AS q3
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY bin) AS upto,
          sum(n) OVER (PARTITION BY lang, source, metric) AS docs FROM binned) GROUP BY ALL),
of_lang AS (
  SELECT lang, metric, max(docs) AS docs, min(bin) FILTER (upto * 4 >= docs) AS q1, min(bin) FILTER (upto * 4 >= 3 * docs) AS q3
  FROM (SELECT lang, metric, bin, sum(sum(n)) OVER (PARTITION BY lang, metric ORDER BY bin) AS upto,
          sum(sum(n)) OVER (PARTITION BY lang, metric) AS docs FROM binned GROUP BY lang, metric, bin) GROUP BY ALL),
of_all AS (
  SELECT metric, max(docs) AS docs, min(bin) FILTER (upto * 4 >= docs) AS q1, min(bin) FILTER (upto * 4 >= 3 * docs) AS q3
  FROM (SELECT metric, bin, sum(sum(n)) OVER (PARTITION BY metric ORDER BY bin) AS upto,
          sum(sum(n)) OVER (PARTITION BY metric) AS docs FROM binned GROUP BY metric, bin) GROUP BY ALL),
quart AS (
  SELECT o.lang, o.source, o.metric,
    CASE WHEN o.docs >= 200 THEN o.q1 WHEN l.docs >= 200 THEN l.q1 ELSE a.q1 END AS q1,
    CASE WHEN o.docs >= 200 THEN o.q3 WHEN l.docs >= 200 THEN l.q3 ELSE a.q3 END AS q3,
    CASE o.metric WHEN 'symbols' THEN 10 WHEN 'word_length' THEN 500 WHEN 'repeats' THEN 50 ELSE 100 END AS least_spread
  FROM own o JOIN of_lang l ON o.metric = l.metric AND o.lang IS NOT DISTINCT FROM l.lang JOIN of_all a ON a.metric = o.metric),
outside AS (
  SELECT DISTINCT v.rid FROM vals v JOIN quart q ON v.metric = q.metric AND v.lang IS NOT DISTINCT FROM q.lang
    AND v.source IS NOT DISTINCT FROM q.source
  WHERE v.v > q3 + 4 * greatest(q3 - q1, least_spread)
     OR (v.metric = 'word_length' AND v.v < q1 - 4 * greatest(q3 - q1, least_spread)))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND rid NOT IN (SELECT rid FROM outside) AS kept
FROM m
"""
