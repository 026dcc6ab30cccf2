"""Dataset catalogue as a Spark table: profile, upsert, point lookup, listing.

A catalogue row is (domain, dataset_name, schema_json, partition_keys,
row_count, last_updated), keyed by (domain, dataset_name).  An upsert keeps
every target row whose key is not updated and appends the updates (newest
per key wins): an anti-join plus a union, so it is one shuffle on the key.
The catalogue is persisted by writing a new version and switching to it;
``update_catalog`` does so only if no other writer committed since it read, and
otherwise starts again from what that one wrote, so that no update is lost.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeviews.sources import versions as VS
from lakeviews.sources.lake import KEPT_VERSIONS

CATALOG_KEYS = ["domain", "dataset_name"]
CATALOG_SCHEMA = ("domain string, dataset_name string, schema_json string, partition_keys string, "
                  "row_count bigint, last_updated timestamp")


def schema_json(df: DataFrame) -> str:
    """Column -> type name map as compact JSON text (driver metadata, no data read)."""
    return json.dumps(dict(df.dtypes), separators=(",", ":"))


def profile_dataset(df: DataFrame, domain: str, dataset_name: str, partition_keys=(),
                    updated_at=None) -> DataFrame:
    """One catalogue row: the row count is an aggregate over the dataset."""
    ts = F.lit(updated_at).cast("timestamp") if updated_at is not None else F.current_timestamp()
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(domain).alias("domain"), F.lit(dataset_name).alias("dataset_name"),
        F.lit(schema_json(df)).alias("schema_json"),
        F.lit(json.dumps(list(partition_keys))).alias("partition_keys"),
        "row_count", ts.alias("last_updated"))


def empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOG_SCHEMA)


def upsert(target: DataFrame, updates: DataFrame, keys=CATALOG_KEYS, order_col: str = "last_updated") -> DataFrame:
    """Insert or replace by key; among several updates of one key the greatest ``order_col`` wins."""
    rest = [c for c in updates.columns if c not in keys]
    newest = (updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order_col, *rest)).alias("_r"))
              .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))
    kept = target.join(newest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def catalog_get(catalog: DataFrame, domain: str, dataset_name: str) -> DataFrame:
    """Point lookup; an empty result means the dataset is not registered."""
    return catalog.where((F.col("domain") == domain) & (F.col("dataset_name") == dataset_name))


def catalog_list(catalog: DataFrame) -> DataFrame:
    return catalog.orderBy(*CATALOG_KEYS)


def _write(catalog: DataFrame, base: str) -> str:
    path = f"{base}/v={uuid.uuid4().hex}"
    catalog.coalesce(1).write.parquet(path)  # a row a dataset
    return path


def save_catalog(catalog: DataFrame, root: str) -> str:
    """Write a new version and switch to it, whatever is current (never overwrite what is being read)."""
    base = f"{root.rstrip('/')}/catalog"
    path = _write(catalog, base)
    VS.point_to(catalog.sparkSession, base, path)
    return path


def load_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The newest saved catalogue, empty if none was ever saved; a failing read raises."""
    path = VS.pointed_to(spark, f"{root.rstrip('/')}/catalog")
    return empty_catalog(spark) if path is None else spark.read.schema(CATALOG_SCHEMA).parquet(path)


def update_catalog(spark: SparkSession, root: str, updates: DataFrame, attempts: int = 50) -> DataFrame:
    """Upsert rows into the saved catalogue; of several writers at once, every one's rows are kept.  Returns the catalogue."""
    base = f"{root.rstrip('/')}/catalog"
    rows = spark.createDataFrame(updates.select(*empty_catalog(spark).columns).collect(), CATALOG_SCHEMA)  # a row a dataset, computed once
    for _ in range(attempts):
        number = VS.next_number(spark, base)
        path = _write(upsert(load_catalog(spark, root), rows), base)
        try:
            VS.commit(spark, base, path, number)
        except VS.Conflict:
            VS.remove(spark, path)
            continue
        VS.retire(spark, base, KEPT_VERSIONS)
        return spark.read.schema(CATALOG_SCHEMA).parquet(path)
    raise VS.Conflict(f"{base}: {attempts} attempts were overtaken")
