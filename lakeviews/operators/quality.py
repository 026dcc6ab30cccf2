"""Data-quality checks as Spark jobs.

Every check produces rows of one long metrics table
``(dataset, check, column, parent, value)``:

  row_count   rows in the dataset
  null        NULL (or NaN) values per ``not_null`` column that exists
  duplicate   rows beyond the first per primary key (key columns present)
  fk          orphan rows per foreign key; -1 when the parent or the
              column is missing (unverifiable counts as a failure)

``dataset_metrics`` and ``constraint_metrics`` take all datasets (or star tables)
through one exchange (see ``audit``); the functions of one dataset are lazy.

Plan shape of these: row count, NULL counts and duplicates come from one pass, a
``groupBy(primary key)`` holding per-key row and NULL counts followed by a
global sum (partial aggregation, so a hot key is combined map-side and a
dataset is scanned once for all three); orphans first count the child per
foreign-key value, then
anti-join those counts to the parent's distinct keys, so the shuffle moves
one row per distinct key rather than every child row.  The report row per
dataset is a pivot of the metrics (bounded by the contract, not the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeviews.contracts import Contract
from lakeviews.operators import audit as A

METRIC_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("parent", T.StringType()),
    T.StructField("value", T.LongType()),
])


def is_missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _sql_text(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'"


def _metric(dataset: str, check: str, column: str | None, parent: str | None, value: str) -> str:
    """One metrics row as a SQL ``named_struct``; ``value`` is a SQL expression."""
    return (f"named_struct('dataset', {_sql_text(dataset)}, 'check', {_sql_text(check)}, "
            f"'column', {_sql_text(column)}, 'parent', {_sql_text(parent)}, "
            f"'value', CAST({value} AS BIGINT))")


def _explode_metrics(one_row: DataFrame, metrics: list[str]) -> DataFrame:
    """Unpivot a one-row aggregate into metrics rows (one ``inline`` expression)."""
    return one_row.selectExpr(f"inline(array({', '.join(metrics)}))")


def check_nulls(df: DataFrame, contract: Contract) -> DataFrame:
    """Row count and NULL counts of the not-null columns, in one aggregate pass."""
    name = contract.full_name
    cols = [c for c in contract.not_null if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(is_missing(df, c)).alias(f"__null_{i}") for i, c in enumerate(cols)])
    metrics = [_metric(name, "row_count", None, None, "__rows")]
    metrics += [_metric(name, "null", c, None, f"__null_{i}") for i, c in enumerate(cols)]
    return _explode_metrics(agg, metrics)


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows beyond the first per key (NULL keys compare equal)."""
    return (df.groupBy(*keys).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dups")))


def check_duplicates(df: DataFrame, contract: Contract) -> DataFrame:
    spark = df.sparkSession
    keys = [k for k in contract.primary_key if k in df.columns]
    if not keys:
        return _constant(spark, contract.full_name, "duplicate", None, None, 0)
    return _explode_metrics(duplicate_count(df, keys),
                            [_metric(contract.full_name, "duplicate", None, None, "dups")])


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row: child rows whose non-null ``column`` is not among the parent's non-null keys."""
    per_key = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__k")).count()
    valid = parent.where(F.col(parent_column).isNotNull()).select(F.col(parent_column).alias("__k")).distinct()
    return (per_key.join(valid, "__k", "left_anti")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("orphans")))


def anti_join_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The orphan rows themselves."""
    valid = parent.where(F.col(parent_column).isNotNull()).select(F.col(parent_column).alias("__k")).distinct()
    return (child.where(F.col(column).isNotNull())
            .join(valid, F.col(column) == F.col("__k"), "left_anti"))


def check_referential_integrity(df: DataFrame, contract: Contract, parents: dict) -> DataFrame:
    spark = df.sparkSession
    parts = []
    for column, parent_name, parent_column in contract.fk_checks:
        parent = parents.get(parent_name)
        if parent is None or column not in df.columns or parent_column not in parent.columns:
            parts.append(_constant(spark, contract.full_name, "fk", column, parent_name, -1))
            continue
        parts.append(_explode_metrics(orphan_count(df, column, parent, parent_column),
                                      [_metric(contract.full_name, "fk", column, parent_name, "orphans")]))
    return _union(spark, parts)


def check_rows_nulls_duplicates(df: DataFrame, contract: Contract) -> DataFrame:
    """Row count, NULL counts and duplicate count in one scan of ``df``.

    Rows are grouped by the primary key (NULL keys form one group) with per-group
    row and NULL counts; one more aggregate sums them and counts rows beyond the
    first per key.  Without key columns the duplicate count is 0.
    """
    name = contract.full_name
    cols = [c for c in contract.not_null if c in df.columns]
    keys = [k for k in contract.primary_key if k in df.columns]
    nulls = [F.count_if(is_missing(df, c)).alias(f"__null_{i}") for i, c in enumerate(cols)]
    if keys:
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *nulls)
        agg = per_key.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__rows"),
                          F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("__dups"),
                          *[F.coalesce(F.sum(f"__null_{i}"), F.lit(0)).alias(f"__null_{i}")
                            for i in range(len(cols))])
    else:
        agg = df.agg(F.count(F.lit(1)).alias("__rows"), F.lit(0).alias("__dups"), *nulls)
    metrics = [_metric(name, "row_count", None, None, "__rows")]
    metrics += [_metric(name, "null", c, None, f"__null_{i}") for i, c in enumerate(cols)]
    metrics.append(_metric(name, "duplicate", None, None, "__dups"))
    return _explode_metrics(agg, metrics)


def run_quality_checks(df: DataFrame, contract: Contract, parents: dict | None = None) -> DataFrame:
    """All metrics of one dataset: one pass for rows / NULLs / duplicates, one per foreign key."""
    parents = parents or {}
    return _union(df.sparkSession, [check_rows_nulls_duplicates(df, contract),
                                    check_referential_integrity(df, contract, parents)])


def dataset_metrics(frames: dict[str, DataFrame], contracts: dict[str, Contract], checks: tuple[str, ...] = ("row_count", "null", "duplicate", "fk"),
                    parents: dict[str, DataFrame] | None = None, unique: bool = False) -> DataFrame:
    """The chosen metrics of all datasets, from one scan of each and one exchange.

    ``parents`` are the frames that foreign keys may point to (``frames``, unless
    given); a key whose parent or column isn't there counts -1.  ``unique``: see ``audit``.
    """
    parents = frames if parents is None else parents
    known = {**parents, **frames}
    rules, rows = [], []  # a metric row is (dataset, check, column, parent, rule's number and field, or a fixed value)

    def ruled(rule) -> int:
        rules.append(rule)
        return len(rules) - 1

    for name, df in frames.items():
        contract = contracts[name]
        keys = tuple(k for k in contract.primary_key if k in df.columns)
        if "row_count" in checks or "duplicate" in checks:
            number = ruled(A.Unique(name, keys) if keys else A.Count(name, lambda d: F.lit(True)))
            if "row_count" in checks:
                rows.append((name, "row_count", None, None, (number, "rows")))
            if "duplicate" in checks:
                rows.append((name, "duplicate", None, None, (number, "repeated") if keys else 0))
        if "null" in checks:
            rows += [(name, "null", c, None, (ruled(A.Count(name, lambda d, c=c: is_missing(d, c))), "rows")) for c in contract.not_null if c in df.columns]
        if "fk" in checks:
            for column, parent, parent_column in contract.fk_checks:
                there = parent in parents and column in df.columns and parent_column in parents[parent].columns
                rows.append((name, "fk", column, parent, (ruled(A.Refer(name, column, parent, parent_column)), "orphans") if there else -1))
    return _measured(known, rules, rows, unique)


def _measured(frames: dict[str, DataFrame], rules: list, rows: list[tuple], unique: bool = False) -> DataFrame:
    totals = A.audit(frames, rules, unique=unique)
    spark = SparkSession.active() if not frames else next(iter(frames.values())).sparkSession
    return spark.createDataFrame([(*r[:4], getattr(totals[r[4][0]], r[4][1]) if isinstance(r[4], tuple) else r[4]) for r in rows], METRIC_SCHEMA)


def constraint_metrics(star: dict[str, DataFrame], tables: dict, checks: tuple[str, ...] = ("pk", "fk", "not_null", "varchar"), unique: bool = False) -> DataFrame:
    """Violations of the chosen constraints of all star tables, from one scan of each and one exchange."""
    rules, rows = [], []

    def measured(table, check, column, parent, rule, field) -> None:
        rules.append(rule)
        rows.append((table, check, column, parent, (len(rules) - 1, field)))

    for table, df in star.items():
        spec = tables[table]
        if "pk" in checks:
            label, keys = ",".join(spec.primary_key), tuple(spec.primary_key)
            measured(table, "pk_duplicate", label, None, A.Unique(table, keys), "repeated")
            rows.append((table, "pk_null", label, None, (len(rules) - 1, "void")))
        if "fk" in checks:
            for column, dim, dim_column in spec.foreign_keys:
                if dim in star:
                    measured(table, "fk", column, dim, A.Refer(table, column, dim, dim_column), "orphans")
        if "not_null" in checks:
            for c in spec.not_null:
                measured(table, "not_null", c, None, A.Count(table, lambda d, c=c: F.col(c).isNull()), "rows")
        if "varchar" in checks:
            for c, _, n in spec.columns:
                if n:
                    measured(table, "varchar", c, None, A.Count(table, lambda d, c=c, n=n: F.length(F.col(c).cast("string")) > n), "rows")
    return _measured(star, rules, rows, unique)


def quality_report(metrics: DataFrame) -> DataFrame:
    """One report row per dataset: row_count, null map, duplicate count, fk map, passed."""
    check, value = F.col("check"), F.col("value")

    def entries(kind: str, key: Column) -> Column:
        return F.map_from_entries(F.sort_array(F.collect_list(
            F.when(check == kind, F.struct(key.alias("key"), value.alias("value"))))))

    failing = F.max(F.when(check != "row_count", value != 0))
    return (metrics.groupBy("dataset")
            .agg(F.max(F.when(check == "row_count", value)).alias("row_count"),
                 entries("null", F.col("column")).alias("null_violations"),
                 F.coalesce(F.max(F.when(check == "duplicate", value)), F.lit(0)).alias("duplicate_key_count"),
                 entries("fk", F.concat_ws("->", "column", "parent")).alias("fk_violations"),
                 (~F.coalesce(failing, F.lit(False))).alias("passed")))


def quality_passed(report: DataFrame) -> DataFrame:
    return report.select("dataset", "passed")


def quality_summary(reports: DataFrame) -> DataFrame:
    return reports.agg(F.count(F.lit(1)).alias("datasets_processed"),
                       F.count_if(~F.col("passed")).alias("datasets_with_warnings"))


# --- warehouse constraints (the star schema's PK / FK / NOT NULL) ---
def primary_key_violations(df: DataFrame, table: str, keys) -> DataFrame:
    """Duplicate keys and keys with a NULL part, from one ``groupBy(key)`` pass."""
    keys = list(keys)
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    agg = per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("__dups"),
                      F.coalesce(F.sum(F.when(any_null, F.col("__n"))), F.lit(0)).alias("__nulls"))
    label = ",".join(keys)
    return _explode_metrics(agg, [_metric(table, "pk_duplicate", label, None, "__dups"),
                                  _metric(table, "pk_null", label, None, "__nulls")])


def foreign_key_violations(df: DataFrame, table: str, column: str, dim: DataFrame,
                           dim_name: str, dim_column: str) -> DataFrame:
    return _explode_metrics(orphan_count(df, column, dim, dim_column),
                            [_metric(table, "fk", column, dim_name, "orphans")])


def not_null_violations(df: DataFrame, table: str, columns) -> DataFrame:
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)])
    return _explode_metrics(agg, [_metric(table, "not_null", c, None, f"__n{i}")
                                  for i, c in enumerate(columns)])


def varchar_violations(df: DataFrame, table: str, limits: dict) -> DataFrame:
    """Values longer than the column's VARCHAR(n) limit."""
    agg = df.agg(*[F.count_if(F.length(F.col(c).cast("string")) > n).alias(f"__v{i}")
                   for i, (c, n) in enumerate(limits.items())])
    return _explode_metrics(agg, [_metric(table, "varchar", c, None, f"__v{i}")
                                  for i, c in enumerate(limits)])


class ConstraintViolation(ValueError):
    pass


def enforce(violations: DataFrame) -> None:
    """Raise, naming every violation count that isn't zero (as many rows at most as the schema has constraints)."""
    bad = violations.where(F.col("value") != 0).collect()
    if bad:
        raise ConstraintViolation("; ".join(f"{r.dataset}.{r.column} {r.check}={r.value}" for r in bad))


def _constant(spark: SparkSession, dataset, check, column, parent, value) -> DataFrame:
    return spark.createDataFrame([(dataset, check, column, parent, value)], METRIC_SCHEMA)


def _union(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], METRIC_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
