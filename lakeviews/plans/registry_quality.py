"""Keyed queries for cleaning, quality checks and the star schema (see registry.py)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS, TRANSFORM_ORDER
from lakeviews.functions import coerce as C
from lakeviews.operators import dedupe as D
from lakeviews.operators import quality as QC
from lakeviews.plans import star as S
from lakeviews.plans.binding import StarBinding
from lakeviews.plans.raw_zone import RawZone
from lakeviews.plans.registry import register, star


def _raw(spark, sf_dir) -> RawZone:
    """The raw datasets of the star, built once with it."""
    held = star(spark, sf_dir)
    if not hasattr(held, "raw"):
        held.raw = RawZone(held)
    return held.raw


def coerced(raw: RawZone, name: str) -> DataFrame:
    return C.coerce_types(raw.dataset(name), CONTRACTS[name])


def all_coerced(raw: RawZone) -> dict[str, DataFrame]:
    if not hasattr(raw, "all_coerced"):
        raw.all_coerced = {n: coerced(raw, n) for n in TRANSFORM_ORDER}
    return dict(raw.all_coerced)


# ---------------- coercion (§2.2) ----------------
@register("coerce_types")
def _(spark, sf_dir):
    """The coerced rows of every dataset, every column with its value."""
    return S.stacked_rows(all_coerced(_raw(spark, sf_dir)), "dataset")


@register("coerce_date")
def _(spark, sf_dir):
    o = StarBinding(spark, sf_dir).t.orders
    d = F.to_date("o_orderdate")
    unpadded = F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"),
                           F.dayofmonth(d).cast("string"))
    return o.select("o_orderkey",
                    C.coerce_date(unpadded).alias("from_unpadded"),
                    C.coerce_date(F.col("o_orderdate").cast("string")).alias("from_datetime"),
                    C.coerce_date(F.col("o_orderpriority")).alias("from_word"))


@register("coerce_int")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.coerce_int(F.col("l_quantity").cast("string")).alias("from_decimal_point"),
                     C.coerce_int(F.col("l_linenumber").cast("string")).alias("from_integer"),
                     C.coerce_int(F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("from_fraction"),
                     C.coerce_int(F.col("l_returnflag")).alias("from_word"))


@register("coerce_float")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    price = F.col("l_extendedprice").cast("decimal(14,2)").cast("string")
    nan_or_price = F.when(F.col("l_returnflag") == "R", F.lit("NaN")).otherwise(price)
    return li.select("l_orderkey", "l_linenumber",
                     C.coerce_float(price).alias("from_decimal"),
                     C.coerce_float(F.concat(price, F.lit("d"))).alias("from_suffixed"),
                     C.coerce_float(nan_or_price).alias("from_nan"),
                     C.coerce_float(F.concat(F.col("l_linenumber").cast("string"), F.lit("e2")))
                     .alias("from_scientific"))


@register("coerce_bool")
def _(spark, sf_dir):
    e = StarBinding(spark, sf_dir).t.events
    t = F.col("event_type")
    text = (F.when(t == "purchase", F.lit("Yes")).when(t == "click", F.lit("TRUE"))
            .when(t == "view", F.lit("1")).when(t == "error", F.lit(None).cast("string"))
            .otherwise(t))
    return e.select("event_id", C.coerce_bool(text).alias("flag"))


@register("coerce_string")
def _(spark, sf_dir):
    c = StarBinding(spark, sf_dir).t.customer
    padded = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return c.select("c_custkey", C.coerce_string(padded).alias("customer_code"))


# ---------------- keep-last de-duplication (§2.5) ----------------
@register("dedupe_keep_last")
def _(spark, sf_dir):
    gl = _raw(spark, sf_dir).finance__gl_transactions
    # The input tables give no row order, so "last" is by the remaining columns.
    return D.dedupe_keep_last(gl, ["txn_id"], D.total_order(gl, exclude=("txn_id",)))


# ---------------- quality checks (§2.8) ----------------
def _metrics_all(raw: RawZone, *checks: str) -> DataFrame:
    return QC.dataset_metrics(all_coerced(raw), CONTRACTS, *[checks] * bool(checks))


@register("check_nulls")
def _(spark, sf_dir):
    return _metrics_all(_raw(spark, sf_dir), "row_count", "null")


@register("check_duplicates")
def _(spark, sf_dir):
    return _metrics_all(_raw(spark, sf_dir), "duplicate")


@register("check_referential_integrity")
def _(spark, sf_dir):
    """Every foreign key of every dataset, and those of one dataset whose parents aren't there (-1)."""
    cur = all_coerced(_raw(spark, sf_dir))
    alone = QC.dataset_metrics({"hr.attrition_events": cur["hr.attrition_events"]}, CONTRACTS, ("fk",), {})
    return S.stacked([QC.dataset_metrics(cur, CONTRACTS, ("fk",)), alone.withColumn("dataset", F.concat("dataset", F.lit(" (no parents)")))])


@register("anti_join_orphans")
def _(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return QC.anti_join_orphans(coerced(raw, "sales.customers"), "region_code",
                                coerced(raw, "sales.regions"), "region_code")


@register("run_quality_checks")
def _(spark, sf_dir):
    return _metrics_all(_raw(spark, sf_dir))


def _report_json(report: DataFrame) -> DataFrame:
    return report.select("dataset", "row_count", F.to_json("null_violations").alias("null_violations"),
                         "duplicate_key_count", F.to_json("fk_violations").alias("fk_violations"), "passed")


@register("quality_report")
def _(spark, sf_dir):
    return _report_json(QC.quality_report(_metrics_all(_raw(spark, sf_dir))))


@register("quality_passed")
def _(spark, sf_dir):
    return QC.quality_passed(QC.quality_report(_metrics_all(_raw(spark, sf_dir))))


@register("quality_summary")
def _(spark, sf_dir):
    return QC.quality_summary(QC.quality_report(_metrics_all(_raw(spark, sf_dir))))


@register("clean_dataset")
def _(spark, sf_dir):
    """All sixteen datasets coerced and de-duplicated: the rows that are kept, with every value."""
    kept = {}
    for name, df in all_coerced(_raw(spark, sf_dir)).items():
        pk = CONTRACTS[name].primary_key
        kept[name] = D.dedupe_keep_last(df, pk, D.total_order(df, exclude=pk))
    return S.stacked_rows(kept, "dataset")


# ---------------- star schema (§2.2, §2.9) ----------------
def _star_from_raw(spark, sf_dir) -> dict[str, DataFrame]:
    raw = _raw(spark, sf_dir)
    cur = all_coerced(raw)
    departments = S.dim_department_from(cur["hr.headcount_costs"])
    return S.build_star(spark, cur, departments)


for _table in S.STAR_SOURCES:
    def _make(table):
        def fn(spark, sf_dir):
            return _star_from_raw(spark, sf_dir)[table]
        return fn
    register("project_" + _table)(_make(_table))


@register("dim_region")
def _(spark, sf_dir):
    return _star_from_raw(spark, sf_dir)["dim_region"]


@register("dim_department")
def _(spark, sf_dir):
    return _star_from_raw(spark, sf_dir)["dim_department"]


@register("dim_date")
def _(spark, sf_dir):
    return _star_from_raw(spark, sf_dir)["dim_date"]


@register("union_distinct_dates")
def _(spark, sf_dir):
    cur = all_coerced(_raw(spark, sf_dir))
    return S.union_distinct_dates([(cur[n], c) for n, c in S.DATE_SOURCES])


@register("fn_month_start")
def _(spark, sf_dir):
    o = StarBinding(spark, sf_dir).t.orders
    return o.select("o_orderkey", S.fn_month_start(F.to_date("o_orderdate")).alias("month_start"))


@register("fn_date_parts")
def _(spark, sf_dir):
    o = StarBinding(spark, sf_dir).t.orders
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", *S.fn_date_parts(d))


@register("narrow_money")
def _(spark, sf_dir):
    li = StarBinding(spark, sf_dir).t.lineitem
    disc_amount = F.col("l_extendedprice").cast("decimal(14,2)") * F.col("l_discount").cast("decimal(4,2)")
    return li.select("l_orderkey", "l_linenumber",
                     disc_amount.cast("decimal(14,2)").cast("double").alias("discount_amount"),
                     (disc_amount * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(10,2)").cast("double")
                     .alias("discount_hundredths"))


@register("enforce_primary_keys")
def _(spark, sf_dir):
    return S.violations(_star_from_raw(spark, sf_dir), ("pk",))


@register("enforce_foreign_keys")
def _(spark, sf_dir):
    return S.violations(_star_from_raw(spark, sf_dir), ("fk",))


@register("enforce_not_null")
def _(spark, sf_dir):
    return S.violations(_star_from_raw(spark, sf_dir), ("not_null",))


@register("check_varchar_len")
def _(spark, sf_dir):
    return S.violations(_star_from_raw(spark, sf_dir), ("varchar",))
