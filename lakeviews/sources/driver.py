"""Scan of the parquet input tables (one parquet file or folder per table).

Each table is read lazily; Catalyst prunes columns and pushes filters into
the parquet scan, so a table handle costs nothing until a plan uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class DriverTables:
    """Lazy handles on ``{sf_dir}/{name}.parquet``; a table is opened once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._opened[name]

    def version(self, names: tuple[str, ...]) -> tuple:
        """Size and time of change of every file of the tables."""
        hadoop, found = self.spark._jvm.org.apache.hadoop.fs, []
        for name in names:
            where = hadoop.Path(f"{self.sf_dir}/{name}.parquet")
            fs = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
            found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(where)]
        return tuple(found)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
