"""The full refresh: land -> clean -> check -> curate -> catalogue -> star -> views -> export.

One Spark application; each stage ends in a write, and the next stage reads
what was written, so lineage is cut at every stage boundary (a lost
executor only recomputes the current stage) and a re-run starts from
written data.  Parents are cleaned before children; a child's foreign keys
are checked against the parents' *curated* files.  Failing checks warn (the
report says so) but do not stop the run.  A violated constraint of the star
schema (primary key, foreign key, NOT NULL, VARCHAR length) stops it before
the load, so the live version stays as it was; ``strict=False`` only skips that.
Orphans in the curated data that no constraint of the star forbids are loaded
and reported.

A journal holds what each step has done, by the day and a digest of all input
rows.  A run that was cut off goes on after the last step it finished; after a
finished run, the next call for the same inputs is a new run.  Steps that go on
use the very versions that the journal names, not what other runs wrote since.
The digest is taken while rows are landed, unless there is a run to go on with.
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeviews.contracts import CONTRACTS, STAR_LOAD_ORDER, TRANSFORM_ORDER
from lakeviews.functions.coerce import coerce_types
from lakeviews.operators import quality as QC
from lakeviews.operators.dedupe import SEQ, dedupe_keep_last
from lakeviews.plans import catalog as CAT
from lakeviews.plans import star as S
from lakeviews.plans import views as V
from lakeviews.sources import lake as L
from lakeviews.sources.versions import Journal, names

EXPORTS = [
    # (file name, view, order)
    ("revenue_vs_hr_cost", "vw_revenue_vs_hr_cost", ["department", "month_start"]),
    ("revenue_vs_hr_cost_by_region", "vw_revenue_vs_hr_cost_by_region",
     ["department", "region_code", "month_start"]),
    ("marketing_spend_vs_sales", "vw_marketing_spend_vs_sales", ["region_code", "month_start"]),
    ("inventory_turns_vs_sales", "vw_inventory_turns_vs_sales", ["sku", "region_code", "month_start"]),
    ("department_pnl", "vw_department_pnl", ["department", "month_start"]),
    ("dim_date", "dim_date", ["date_key"]),
    ("dim_department", "dim_department", None),
    ("dim_region", "dim_region", None),
]


@dataclass
class RefreshResult:
    reports: DataFrame   # one row per dataset (passed, null / fk maps, duplicates)
    metrics: DataFrame   # long metrics table, including rows_before_dedupe
    catalog: DataFrame
    star_path: str
    views: dict
    star: dict           # the loaded star tables, as read back
    exports: dict        # name -> folder
    journal: Journal


# Independent per-dataset jobs (landing, curating, loading) are submitted from a
# few driver threads at once, so small datasets do not leave the cluster idle
# between jobs.  Each job is still a full Spark job over the whole dataset.
CONCURRENT_JOBS = 4


def in_parallel(fn, items):
    with ThreadPoolExecutor(max_workers=CONCURRENT_JOBS) as pool:
        return list(pool.map(fn, items))


def land_all(raw_inputs: dict[str, DataFrame], lake_root: str, ingest_date: str, journal: Journal, digested: bool = False) -> int:
    """Land every given raw dataset under its domain; returns the number landed.

    ``digested``: records hold a dataset's digest line too, taken from the rows as they are landed.
    """
    def landed(c):
        files = L.data_files(journal.spark, f"{L.raw_path(lake_root, c.domain, c.name)}/dt={ingest_date}")
        return sorted([path.rsplit("/", 1)[1], size] for path, size in files)

    def holds(name, record) -> bool:
        c = CONTRACTS[name]
        days = L.folders(journal.spark, L.raw_path(lake_root, c.domain, c.name)) or []
        return f"dt={ingest_date}" in days and landed(c) == record

    def land(item):
        name, df = item
        c = CONTRACTS[name]

        def work():
            if not digested:
                L.land_raw(df, lake_root, c.domain, c.name, ingest_date, "gzip")
                return landed(c)
            seen = Observation()
            L.land_raw(df.observe(seen, *digest_parts(df)), lake_root, c.domain, c.name, ingest_date, "gzip")
            return {"files": landed(c), "line": digest_line(name, df.columns, seen.get)}
        return journal.once(f"land-{name}", work, lambda record: holds(name, record))
    return len(in_parallel(land, list(raw_inputs.items())))


def land_inputs(spark: SparkSession, raw_inputs: dict[str, DataFrame], in_order: dict[str, DataFrame], lake_root: str, ingest_date: str) -> Journal:
    """Land all inputs; returns the journal of the run, named by the day and their digest.

    If no run of the day was cut off, there is none to go on with, and the digest
    is taken from the rows as they are landed; until it is known, landings are
    recorded in a journal of their own.  Otherwise the inputs are digested first,
    to tell whether this run goes on with theirs, and landings of the same rows
    are taken over.
    """
    root, landing = f"{lake_root}/_journal", f"{ingest_date}-landing-"
    unfinished = {key: j for key in names(spark, root) or [] if key.startswith(f"{ingest_date}-") and (j := Journal(spark, root, key)).resumed}
    if unfinished:
        lines = digest_lines(raw_inputs)
        begun = [j for key, j in unfinished.items() if key.startswith(landing)]
    else:
        first = Journal(spark, root, f"{landing}{uuid.uuid4().hex}")
        land_all(in_order, lake_root, ingest_date, first, digested=True)
        lines = {n: first.done(f"land-{n}")["line"] for n in in_order}
        begun = [first]
    journal = Journal(spark, root, f"{ingest_date}-{digest_of(lines)[:32]}")
    for before in begun:
        same = {n: record["files"] for n in lines if (record := before.done(f"land-{n}")) and record["line"] == lines[n]}
        for name, files in same.items():
            if journal.done(f"land-{name}") is None:
                journal.record(f"land-{name}", files)
                journal.resumed |= before.resumed
        if same or not before.resumed:
            before.finish()
    if unfinished:
        land_all(in_order, lake_root, ingest_date, journal)
    return journal


def _curate(spark: SparkSession, lake_root: str, name: str):
    """Scan the newest landing, coerce, keep the last row per key, write a curated version; its path and the rows scanned."""
    contract = CONTRACTS[name]
    raw = L.scan_raw_csv(spark, lake_root, contract)
    if raw is None:  # absent dataset: skip, not an error
        return None
    seen = Observation()
    typed = coerce_types(raw.observe(seen, F.count(F.lit(1)).alias("rows")), contract)
    cleaned = dedupe_keep_last(typed, contract.primary_key, SEQ).drop(SEQ)
    path = L.write_curated(cleaned, lake_root, contract.domain, contract.name)
    return {"path": path, "rows": seen.get["rows"]}


def clean_all(spark: SparkSession, lake_root: str, journal: Journal):
    """Curate every landed dataset; returns (rows scanned, curated frames) by dataset."""
    def curate(name):
        return journal.once(f"curate-{name}", lambda: _curate(spark, lake_root, name) or {},
                            lambda record: not record or L.folders(spark, record["path"]) is not None)

    done = {n: r for n, r in zip(TRANSFORM_ORDER, in_parallel(curate, TRANSFORM_ORDER)) if r}
    return {n: r["rows"] for n, r in done.items()}, {n: spark.read.parquet(r["path"]) for n, r in done.items()}


def digest_parts(df: DataFrame) -> list[Column]:
    """Aggregates that tell of all rows, whatever their order."""
    h = F.xxhash64(*[x for c in df.columns for x in (F.col(c), F.col(c).isNull())])
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s")]


def digest_line(name: str, columns: list[str], parts: dict) -> str:
    return " ".join([name, *[str(parts[k]) for k in ("n", "x", "s") if parts[k] is not None], ",".join(columns)])


def digest_lines(raw_inputs: dict[str, DataFrame]) -> dict[str, str]:
    parts = [df.agg(*digest_parts(df)).select(F.lit(name).alias("name"), "n", "x", "s") for name, df in raw_inputs.items()]
    rows = S.stacked(parts).collect() if parts else []  # a row a dataset
    return {r["name"]: digest_line(r["name"], raw_inputs[r["name"]].columns, r.asDict()) for r in rows}


def digest_of(lines: dict[str, str]) -> str:
    return hashlib.sha256("\n".join(sorted(lines.values())).encode()).hexdigest()


def input_digest(raw_inputs: dict[str, DataFrame]) -> str:
    """A digest of all rows of all datasets, whatever their order."""
    return digest_of(digest_lines(raw_inputs))


def job_full_refresh(spark: SparkSession, raw_inputs: dict[str, DataFrame], lake_root: str,
                     ingest_date: str, export_root: str | None = None, strict: bool = True,
                     updated_at=None, in_order: dict[str, DataFrame] | None = None) -> RefreshResult:
    """``in_order``: the rows of ``raw_inputs`` in the order in which they are landed, if that isn't left to the inputs."""
    lake_root = lake_root.rstrip("/")
    journal = land_inputs(spark, raw_inputs, in_order or raw_inputs, lake_root, ingest_date)
    scanned, curated = clean_all(spark, lake_root, journal)
    quality_root = f"{lake_root}/quality"
    metrics_path, reports_path = (f"{quality_root}/{kind}/dt={ingest_date}/run={journal.run}" for kind in ("metrics", "reports"))

    def check():
        # Rows removed by de-duplication stay visible next to the post-dedupe checks.
        before = spark.createDataFrame([(n, "rows_before_dedupe", None, None, rows) for n, rows in scanned.items()], QC.METRIC_SCHEMA)
        QC.dataset_metrics(curated, CONTRACTS, unique=True).unionByName(before).write.mode("overwrite").parquet(metrics_path)
        written = spark.read.parquet(metrics_path)
        QC.quality_report(written.where(F.col("check") != "rows_before_dedupe")).write.mode("overwrite").parquet(reports_path)
        return True

    journal.once("check", check, lambda _: L.folders(spark, reports_path) is not None)
    metrics, reports = spark.read.parquet(metrics_path), spark.read.parquet(reports_path)

    def register():
        rows = [CAT.profile_dataset(df, CONTRACTS[n].domain, CONTRACTS[n].name, [], updated_at) for n, df in curated.items()]
        CAT.update_catalog(spark, lake_root, S.stacked(rows))
        return True

    journal.once("register", register)
    catalog = CAT.load_catalog(spark, lake_root)

    def load():
        departments = S.dim_department_from(curated["hr.headcount_costs"]) if "hr.headcount_costs" in curated else None
        star = S.build_star(spark, curated, departments)
        if strict:
            QC.enforce(S.violations(star, unique=True))
        return {"path": L.load_star_tables(spark, star, lake_root, STAR_LOAD_ORDER, CONCURRENT_JOBS), "tables": sorted(star)}

    star = journal.once("load", load, lambda record: L.folders(spark, record["path"]) is not None)
    loaded = {t: spark.read.parquet(f"{star['path']}/{t}") for t in STAR_LOAD_ORDER if t in star["tables"]}
    views = star_views(loaded)
    exports = {}
    if export_root:
        sources = dict(views, **{d: loaded[d] for d in ("dim_date", "dim_department", "dim_region") if d in loaded})

        def export(entry):
            name, view, order = entry
            path = f"{export_root.rstrip('/')}/{name}"
            journal.once(f"export-{name}", lambda: L.export_flat_csv(sources[view], path, order), lambda record: record == path and L.folders(spark, path) is not None)
            return name, path

        exports = dict(in_parallel(export, [e for e in EXPORTS if e[1] in sources]))
    journal.finish()
    return RefreshResult(reports, metrics, catalog, star["path"], views, loaded, exports, journal)


def star_views(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five views over loaded star tables, for output."""
    views = {
        "vw_revenue_vs_hr_cost_by_region": V.vw_revenue_vs_hr_cost_by_region(star["fact_hr_cost"], star["fact_finance_gl"]),
        "vw_marketing_spend_vs_sales": V.vw_marketing_spend_vs_sales(star["fact_marketing_spend"], star["fact_sales"]),
        "vw_inventory_turns_vs_sales": V.vw_inventory_turns_vs_sales(star["fact_inventory_stock"], star["fact_inventory_movement"]),
        "vw_department_pnl": V.vw_department_pnl(star["fact_finance_gl"], star["fact_finance_budget"], star["fact_hr_cost"]),
    }
    views["vw_revenue_vs_hr_cost"] = V.agg_rollup_regions(views["vw_revenue_vs_hr_cost_by_region"])
    return {k: V.to_output(v) for k, v in views.items()}


def export_digest(df: DataFrame) -> Column:
    """Sum of 32-bit digests of all rows' values as text; numbers with three decimals, so that it can be checked elsewhere."""
    texts = [F.coalesce((F.col(c).cast("decimal(28,3)") if kind == "double" else F.col(c)).cast("string"), F.lit("~")) for c, kind in df.dtypes]
    return F.sum(F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("long"))


def summary(result: RefreshResult) -> DataFrame:
    """One table of all that a refresh made: the report of each dataset, the rows of each star table, rows and digest of each export as written."""
    before = result.metrics.where(F.col("check") == "rows_before_dedupe").select("dataset", F.col("value").alias("rows_before_dedupe"))
    report = result.reports.join(before, "dataset", "left").select(
        F.lit("report").alias("part"), F.col("dataset").alias("name"), "row_count", "rows_before_dedupe", F.to_json("null_violations").alias("null_violations"),
        "duplicate_key_count", F.to_json("fk_violations").alias("fk_violations"), "passed", F.lit(None).cast("long").alias("digest"))
    out = report
    for table, df in result.star.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit("star").alias("part"), F.lit(table).alias("name"), "row_count"), True)
    for name, view, _ in EXPORTS:
        if name in result.exports:
            schema = (result.views | result.star)[view].schema
            written = result.reports.sparkSession.read.schema(schema).options(**L.CSV).csv(result.exports[name])
            out = out.unionByName(written.agg(F.count(F.lit(1)).alias("row_count"), export_digest(written).alias("digest"))
                                  .select(F.lit("export").alias("part"), F.lit(name).alias("name"), "row_count", "digest"), True)
    return out
