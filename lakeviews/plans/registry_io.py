"""Keyed round-trip queries: landing, raw scans, curated files, star load, exports, catalogue, job.

Each callable writes into a fresh folder under the shared checkpoint
location (``spark.checkpoint.dir``) and returns a DataFrame that reads the
written files back, so the comparison covers the write and the read.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS, STAR_LOAD_ORDER, TRANSFORM_ORDER
from lakeviews.plans import catalog as CAT
from lakeviews.plans import incremental as INC
from lakeviews.plans import job as JOB
from lakeviews.plans import star as S
from lakeviews.plans import views as V
from lakeviews.plans.registry import register, star
from lakeviews.plans.registry_quality import _raw, _star_from_raw, all_coerced, coerced
from lakeviews.session import scratch_path
from lakeviews.sources import lake as L

DAY1, DAY2 = "2024-01-01", "2024-01-02"
T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def _land_two_days(spark, sf_dir, name: str):
    """Land a stale copy on day 1 and the real data on day 2; returns (lake root, contract)."""
    raw = _raw(spark, sf_dir).dataset(name)
    c = CONTRACTS[name]
    root = scratch_path(spark, "lake")
    stale = raw.select(*[F.concat(F.col(x), F.lit("-stale")).alias(x) if x == c.primary_key[0] else F.col(x)
                         for x in raw.columns])
    L.land_raw(stale, root, c.domain, c.name, DAY1)
    # Missing values are landed as the text "NA", which the raw scan reads back as NULL.
    L.land_raw(raw.fillna("NA"), root, c.domain, c.name, DAY2)
    return root, c


@register("land_raw")
def _(spark, sf_dir):
    root, c = _land_two_days(spark, sf_dir, "sales.customers")
    # Re-landing day 2 replaces only that day's partition.
    L.land_raw(_raw(spark, sf_dir).dataset("sales.customers"), root, c.domain, c.name, DAY2)
    path = L.raw_path(root, c.domain, c.name)
    return spark.read.schema(c.raw_schema().add("dt", "string")).options(**L.CSV).csv(path)


@register("latest_partition")
def _(spark, sf_dir):
    root, c = _land_two_days(spark, sf_dir, "sales.orders")
    latest = L.latest_partition(spark, root, c.domain, c.name, c)
    return L.scan_raw_csv(spark, root, c, keep_input_order=False).agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit(latest).alias("latest_dt"), "rows")


@register("scan_raw_csv")
def _(spark, sf_dir):
    root, c = _land_two_days(spark, sf_dir, "sales.orders")
    return L.scan_raw_csv(spark, root, c, keep_input_order=False)


@register("scan_raw_csv_blocks")
def _(spark, sf_dir):
    """Documents landed as CSV, with the line breaks and quotes of their texts, and read back a block a task."""
    docs = star(spark, sf_dir).t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text")
    path = scratch_path(spark, "csv-documents")
    docs.write.options(**L.CSV).csv(path)
    return L.read_csv(spark, path, docs.schema, split_above=0).drop("position")


@register("raw_file_inventory")
def _(spark, sf_dir):
    """Data rows of the landed files, by dataset and day."""
    root, _ = _land_two_days(spark, sf_dir, "sales.orders")
    where = r"/raw/([^/]+)/([^/]+)/dt=([^/]+)/"
    files = L.raw_file_inventory(spark, root)
    return (files.groupBy(F.concat_ws(".", F.regexp_extract("file_path", where, 1), F.regexp_extract("file_path", where, 2)).alias("dataset"),
                          F.regexp_extract("file_path", where, 3).alias("ingest_date"))
            .agg(F.sum("data_rows").alias("data_rows"), F.bool_and(F.col("file_size") > 0).alias("all_have_bytes")))


@register("write_curated")
def _(spark, sf_dir):
    """Writes all sixteen datasets, the first one twice; returns the rows of each as read back from its current version."""
    root = scratch_path(spark, "lake")
    frames = all_coerced(_raw(spark, sf_dir))
    first = next(iter(frames))

    def write(name):
        c, df = CONTRACTS[name], frames[name]
        if name == first:
            L.write_curated(df.limit(0), root, c.domain, c.name)
        L.write_curated(df, root, c.domain, c.name)
        return name, L.scan_curated_parquet(spark, root, c.domain, c.name)
    # The datasets are independent: several at once leave no core idle at the end of each.
    return S.stacked_rows(dict(JOB.in_parallel(write, list(frames))), "dataset")


@register("scan_curated_parquet")
def _(spark, sf_dir):
    root = scratch_path(spark, "lake")
    L.write_curated(coerced(_raw(spark, sf_dir), "finance.gl_transactions"), root, "finance", "gl_transactions")
    return L.scan_curated_parquet(spark, root, "finance", "gl_transactions")


@register("load_star_table")
def _(spark, sf_dir):
    root = scratch_path(spark, "lake")
    """Loads all eleven tables; returns the rows of each as read back, with every value."""
    L.load_star_tables(spark, _star_from_raw(spark, sf_dir), root, STAR_LOAD_ORDER, JOB.CONCURRENT_JOBS)
    return S.stacked_rows(L.read_star(spark, root, STAR_LOAD_ORDER), "table_name")


@register("export_flat_csv")
def _(spark, sf_dir):
    """Writes all eight exports; returns the rows of each as read back, the header its files hold and whether they are in order."""
    root = scratch_path(spark, "export")
    built, views = _star_from_raw(spark, sf_dir), V.Views(star(spark, sf_dir))
    sources = {"vw_revenue_vs_hr_cost": views.revenue_vs_hr(), "vw_revenue_vs_hr_cost_by_region": views.by_region(),
               "vw_marketing_spend_vs_sales": views.marketing(), "vw_inventory_turns_vs_sales": views.inventory(),
               "vw_department_pnl": views.pnl(), **{d: built[d] for d in ("dim_date", "dim_department", "dim_region")}}
    parts = {}
    for name, view, order in JOB.EXPORTS:
        df = V.to_output(sources[view])
        L.export_flat_csv(df, f"{root}/{name}", order)
        read = spark.read.schema(df.schema).options(**L.CSV).csv(f"{root}/{name}")
        key = F.struct(*[F.col(c) for c in order]) if order else F.lit(0)
        # Part files are in name order; a part holds a range of the order.
        placed = read.select(key.alias("k"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
        by_file = placed.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("least"), F.max("k").alias("most"),
                                             F.min_by("k", "at").alias("first"), F.max_by("k", "at").alias("last"))
        before = F.lag("most").over(Window.orderBy("file"))
        checked = by_file.withColumn("ok", (F.col("first") == F.col("least")) & (F.col("last") == F.col("most"))
                                     & F.coalesce(before <= F.col("least"), F.lit(True)))
        lines = spark.read.text(f"{root}/{name}").select("value", F.col("_metadata.file_name").alias("file"),
                                                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
        first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
        # One row each: the distinct headers of the files, and whether all files are in order.
        header = first.agg(F.array_join(F.array_sort(F.collect_set("header")), " | ").alias("header"))
        parts[name] = read.crossJoin(F.broadcast(header)).crossJoin(F.broadcast(checked.agg(F.bool_and("ok").alias("in_order"))))
    return S.stacked_rows(parts, "export")


@register("json_safe_records")
def _(spark, sf_dir):
    """Records of line items; the quantity of those without a discount is NaN, so null in the record."""
    li = star(spark, sf_dir).t.lineitem
    quantity = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double"))
    return L.json_safe_records(li.select("l_orderkey", "l_linenumber", quantity.alias("quantity"), "l_returnflag"))


# ---------------- catalogue (§2.11) ----------------
def _profiles(spark, sf_dir, deduped: bool, updated_at, raw=None):
    from lakeviews.operators.dedupe import dedupe_keep_last, total_order
    cur = all_coerced(raw or _raw(spark, sf_dir))
    out = []
    for name in TRANSFORM_ORDER:
        df = cur[name]
        if deduped:
            pk = CONTRACTS[name].primary_key
            df = dedupe_keep_last(df, pk, total_order(df, exclude=pk))
        c = CONTRACTS[name]
        out.append(CAT.profile_dataset(df, c.domain, c.name, [], updated_at))
    res = out[0]
    for p in out[1:]:
        res = res.unionByName(p)
    return res


def _catalog(spark, sf_dir):
    """Register every dataset as landed, then upsert the de-duplicated profiles."""
    raw = _raw(spark, sf_dir)
    first = CAT.upsert(CAT.empty_catalog(spark), _profiles(spark, sf_dir, False, T1, raw))
    return CAT.upsert(first, _profiles(spark, sf_dir, True, T2, raw))


@register("profile_dataset")
def _(spark, sf_dir):
    return _profiles(spark, sf_dir, False, T1).drop("last_updated")


def _shown(catalog):
    """All columns of the catalogue, the time as text."""
    return catalog.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss"))


@register("catalog_upsert")
def _(spark, sf_dir):
    """Two updates of a saved catalogue: every dataset as landed, then the de-duplicated profiles."""
    root, raw = scratch_path(spark, "lake"), _raw(spark, sf_dir)
    CAT.update_catalog(spark, root, _profiles(spark, sf_dir, False, T1, raw))
    CAT.update_catalog(spark, root, _profiles(spark, sf_dir, True, T2, raw))
    return _shown(CAT.load_catalog(spark, root))


@register("catalog_get")
def _(spark, sf_dir):
    cat = _catalog(spark, sf_dir)
    hit = CAT.catalog_get(cat, "finance", "gl_transactions")
    miss = CAT.catalog_get(cat, "nonexistent", "dataset")
    return _shown(hit.unionByName(miss))


@register("catalog_list")
def _(spark, sf_dir):
    return _shown(CAT.catalog_list(_catalog(spark, sf_dir)))


# ---------------- aggregates kept up to date from changed months (§2.4, §2.9) ----------------
def _kept_up(spark, sf_dir, name: str) -> INC.Store:
    """The store after three refreshes: over older months, over all months, and over a month with a file more.

    The fact comes in three parts: months before 1997, the others without every
    seventh row, and these.
    """
    s = star(spark, sf_dir)
    root = scratch_path(spark, "kept")
    store = INC.Store(spark, root, name)
    path = f"{root}/{store.kept.fact}"
    fact = s.fact(store.kept.fact)
    late = F.pmod(F.xxhash64(*fact.columns[:2]), F.lit(7)) == 0
    old = F.col("month_start") < "1997-01-01"
    for part in (fact.where(old), fact.where(~old & ~late), fact.where(~old & late)):
        INC.append_to_fact(part, path)
        store.refresh(path)
    return store


for _name in INC.AGGREGATES:
    def _make_kept(name):
        def fn(spark, sf_dir):
            return V.to_output(_kept_up(spark, sf_dir, name).read())
        return fn
    register(f"kept_{_name}")(_make_kept(_name))


@register("kept_vw_revenue_vs_hr_cost_by_region")
def _(spark, sf_dir):
    """The view over stored GL sums that were refreshed month by month."""
    gl = _kept_up(spark, sf_dir, "agg_gl_filtered").read()
    return V.to_output(V.hr_and_gl(V.agg_hr_cost(star(spark, sf_dir).fact_hr_cost), gl))


@register("kept_vw_marketing_spend_vs_sales")
def _(spark, sf_dir):
    sales = _kept_up(spark, sf_dir, "agg_sales").read()
    return V.to_output(V.spend_and_sales(V.agg_spend(star(spark, sf_dir).fact_marketing_spend), sales))


# ---------------- the full job (§2.13) ----------------
@register("job_full_refresh")
def _(spark, sf_dir):
    """The whole refresh: the report of each dataset, the rows of each star table, rows and digest of each export.

    The tables give no row order, so what is landed is put in order of key and
    other columns: of rows with one key, the greatest is the last.
    """
    raw = _raw(spark, sf_dir)
    inputs, in_order = ({name: of(name) for name in TRANSFORM_ORDER} for of in (raw.dataset, raw.ordered))
    root = scratch_path(spark, "lake")
    return JOB.summary(JOB.job_full_refresh(spark, inputs, root, DAY2, export_root=f"{root}/exports", in_order=in_order))
