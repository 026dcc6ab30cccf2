"""The lake: raw CSV zone (date-partitioned), curated parquet, star tables, exports.

Layout under a lake root (any Hadoop-compatible URI):

  raw/<domain>/<dataset>/dt=YYYY-MM-DD/part-*.csv   landed text, header row; .csv.gz if compressed
  curated/<domain>/<dataset>/v=<version>/           cleaned parquet, the last versions
  star/v=<version>/<table>/                         warehouse tables, one folder per load
  .../_CURRENT/                                     numbered versions, the last one counts (see versions.py)

Re-landing a day overwrites only that day's partition (dynamic partition
overwrite).  The newest landing is found from the file listing (no data is
read for it) and the scan is pruned to that partition.  Curated datasets, star
loads and the catalogue write a fresh version and then switch to it, so readers
never see a half-written or empty one, and nothing is overwritten while read.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lakeviews.contracts import NULL_TOKENS, Contract
from lakeviews.operators.dedupe import SEQ
from lakeviews.sources import csv_split
from lakeviews.sources.csv_split import CSV
from lakeviews.sources.versions import names, point_to, pointed_to, retire


KEPT_VERSIONS = 3  # of a curated dataset or the catalogue
GZIP_RECORDS = 1_000_000  # of a compressed landed file, which one task reads


def folders(spark: SparkSession, path: str) -> list[str] | None:
    """Names directly below ``path``; None if there is no such folder.  Any other failure raises."""
    return names(spark, path)


def raw_path(root: str, domain: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/raw/{domain}/{dataset}"


def curated_path(root: str, domain: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/curated/{domain}/{dataset}"


def land_raw(df: DataFrame, root: str, domain: str, dataset: str, ingest_date: str, compression: str | None = None) -> str:
    """Write ``df`` as header CSV, plain or with ``compression``, under ``dt=<ingest_date>``; other days stay untouched."""
    path = raw_path(root, domain, dataset)
    packed = {"compression": compression, "maxRecordsPerFile": GZIP_RECORDS, "zlib.compress.level": "BEST_SPEED"} if compression else {}
    (df.withColumn("dt", F.lit(ingest_date))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**CSV, **packed).partitionBy("dt").csv(path))
    return path


def latest_partition(spark: SparkSession, root: str, domain: str, dataset: str, contract: Contract) -> str | None:
    """Newest ``dt`` value (lexicographic max) from the names of the day folders; None when nothing landed."""
    names = folders(spark, raw_path(root, domain, dataset)) or []
    return max((n[3:] for n in names if n.startswith("dt=")), default=None)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files directly below ``path`` that hold data."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    entries = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return [(e.getPath().toString(), e.getLen()) for e in entries if e.isFile() and e.getPath().getName()[0] not in "._"]


def read_csv(spark: SparkSession, path: str, schema, split_above: int | None = None) -> DataFrame:
    """Records of a folder of CSV files, and ``position``, which orders them.

    A file above ``split_above`` bytes (a split of the session, unless given) is
    read by as many tasks as it has splits; smaller ones take one task each, and
    so do compressed ones.
    """
    limit = csv_split.split_bytes(spark) if split_above is None else split_above
    files = data_files(spark, path)
    large = [f for f, size in files if size > limit and not f.endswith(".gz")]
    if not large:
        return csv_split.whole_files(spark, [path], schema)
    out = csv_split.scan(spark, large, schema)
    small = [f for f, _ in files if f not in set(large)]
    return out.unionByName(csv_split.whole_files(spark, small, schema)) if small else out


def scan_raw_csv(spark: SparkSession, root: str, contract: Contract, keep_input_order: bool = True,
                 split_above: int | None = None) -> DataFrame | None:
    """All-string scan of the newest landing of one dataset; None when the dataset is absent.

    Text in ``NULL_TOKENS`` is read as missing.  With ``keep_input_order``
    each row carries its input position for keep-last de-duplication.
    """
    latest = latest_partition(spark, root, contract.domain, contract.name, contract)
    if latest is None:
        return None
    df = read_csv(spark, f"{raw_path(root, contract.domain, contract.name)}/dt={latest}", contract.raw_schema(), split_above)
    cols = [F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)).alias(c) for c in contract.columns]
    if not keep_input_order:
        return df.select(*cols)
    return numbered_files(df).select(*cols, F.struct("number", "position.block", "position.pos").alias(SEQ))


def numbered_files(df: DataFrame) -> DataFrame:
    """``number``: where a row's file stands among the files read, in the order of ``position``.

    Rows then carry a number rather than the path of their file.
    """
    hadoop, net = df.sparkSession._jvm.org.apache.hadoop.fs, df.sparkSession._jvm.java.net
    as_read = (hadoop.Path(hadoop.Path(net.URI(f)).toString()).toUri().toString() for f in df.inputFiles())
    files = sorted(as_read, key=csv_split.file_order)
    # A row a file, which the driver plans one by one anyway.
    table = df.sparkSession.createDataFrame(pa.table({"path": pa.array(files, pa.string()), "number": pa.array(range(len(files)), pa.int32())}))
    known = F.coalesce("number", F.raise_error(F.concat(F.lit("not among the files read: "), "position.file")))
    return df.join(F.broadcast(table), df["position.file"] == table["path"], "left").withColumn("number", known)


def raw_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed file: path, size in bytes, data rows."""
    where = f"{root.rstrip('/')}/raw/*/*/*/*.csv*"  # .csv.gz too
    files = spark.read.format("binaryFile").load(where).select(
        F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    rows = spark.read.schema("first_column string").options(**CSV).csv(where)
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("data_rows"))
    return files.join(counted, "file_path", "left").select("file_path", "file_size", F.coalesce("data_rows", F.lit(0)).alias("data_rows"))


def write_curated(df: DataFrame, root: str, domain: str, dataset: str, keep: int = KEPT_VERSIONS) -> str:
    """Write a new version of a curated dataset, switch to it and drop all but the last ``keep``; returns its path.

    Readers of the version before are left alone; they end unharmed if fewer than
    ``keep`` versions are written meanwhile.
    """
    base = curated_path(root, domain, dataset)
    path = f"{base}/v={uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    point_to(df.sparkSession, base, path)
    retire(df.sparkSession, base, keep)
    return path


def scan_curated_parquet(spark: SparkSession, root: str, domain: str, dataset: str) -> DataFrame:
    path = pointed_to(spark, curated_path(root, domain, dataset))
    if path is None:
        raise ValueError(f"{domain}.{dataset} was never written under {root}")
    return spark.read.parquet(path)


# Fact tables that grow with the business are written partitioned by month,
# so date-range reads prune whole folders.
PARTITIONED_FACTS = {"fact_sales", "fact_finance_gl", "fact_inventory_movement", "fact_marketing_leads"}


def load_star_tables(spark: SparkSession, star: dict[str, DataFrame], root: str, order: list[str],
                     concurrent_jobs: int = 1) -> str:
    """Write every star table into a fresh version folder, then switch ``_CURRENT`` to it.

    The tables are independent, so up to ``concurrent_jobs`` writes run at once.
    """
    version = uuid.uuid4().hex
    base = f"{root.rstrip('/')}/star/v={version}"

    def write(table: str) -> None:
        df = star[table]
        if table in PARTITIONED_FACTS:
            # Rows of one month go to the same tasks, so each task writes few
            # month folders (not tasks x months small files); AQE splits a large
            # month into advisory-size pieces and merges small ones.
            df.hint("rebalance", "month_start").write.mode("overwrite") \
                .partitionBy("month_start").option("compression", "zstd").parquet(f"{base}/{table}")
        else:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/{table}")

    tables = [t for t in order if t in star]
    with ThreadPoolExecutor(max_workers=max(1, concurrent_jobs)) as pool:
        list(pool.map(write, tables))
    point_to(spark, f"{root.rstrip('/')}/star", base)
    return base


def current_star(spark: SparkSession, root: str) -> str:
    base = pointed_to(spark, f"{root.rstrip('/')}/star")
    if base is None:
        raise ValueError(f"no star schema was loaded under {root}")
    return base


def read_star(spark: SparkSession, root: str, tables) -> dict[str, DataFrame]:
    base = current_star(spark, root)
    return {t: spark.read.parquet(f"{base}/{t}") for t in tables}


def export_flat_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> str:
    """CSV with a header, in the given order: numbered files that each hold a range of it (one file when small)."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").options(**CSV).csv(path)
    return path


def json_safe_records(df: DataFrame) -> DataFrame:
    """One JSON object per row; NaN becomes null and null fields are kept."""
    cols = [F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))
