"""Stored sums of a month-partitioned fact, kept up to date from the months that changed.

A store holds, for every month of a fact, the aggregate's rows and the files
they were made of (name, size, time).  ``refresh`` compares these with the
fact's file listing, without reading data:

* a month with new files only: the new files alone are aggregated and added to
  the stored sums;
* a month that lost or changed a file: it is aggregated again from all its files;
* a month that is gone is dropped; other months aren't read at all.

The months' sums lie in folders of their own; a manifest names the folder and
the files of every month and is committed as the store's next version (see
``versions``).  So sums and the list of what is in them change together: a
refresh that is lost half-way leaves the store as it was, a repeated one finds
nothing to do, and of two at once the later starts again.

Only aggregates of sums and counts can be kept like this; a sum over no value
stays NULL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeviews.plans import views as V
from lakeviews.sources import versions as VS
from lakeviews.sources.lake import folders

MONTH = "month_start"
KEPT = 3


@dataclass(frozen=True)
class Kept:
    """An aggregate of a fact: its grain, which has the month, and what it sums."""
    fact: str
    grain: tuple[str, ...]
    measures: tuple[str, ...]
    aggregate: Callable[[DataFrame], DataFrame]


AGGREGATES = {
    "agg_sales": Kept("fact_sales", tuple(V.MARKET_GRAIN), ("sales_revenue", "order_count"), V.agg_sales),
    "agg_gl_filtered": Kept("fact_finance_gl", tuple(V.REGION_GRAIN), ("gl_revenue", "cogs"), V.agg_gl_filtered),
    "agg_outbound": Kept("fact_inventory_movement", tuple(V.SKU_GRAIN), ("outbound_qty",), V.agg_outbound),
}


@dataclass(frozen=True)
class Change:
    """Months that a refresh added to, made anew, and dropped."""
    added: tuple[str, ...] = ()
    anew: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()


class Store:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.kept = spark, AGGREGATES[name]
        self.root = f"{root.rstrip('/')}/kept/{name}"

    def _manifest(self) -> dict:
        path = VS.pointed_to(self.spark, self.root)
        return json.loads(VS.read_text(self.spark, f"{path}/manifest.json")) if path else {"months": {}}

    def _listed(self, fact_path: str) -> dict[str, dict[str, list]]:
        """File name -> [size, time] of every month of the fact."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        found = {}
        for name in folders(self.spark, fact_path) or []:
            if name.startswith(f"{MONTH}="):
                where = hadoop.Path(f"{fact_path}/{name}")
                entries = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(where)
                found[name.partition("=")[2]] = {e.getPath().getName(): [e.getLen(), e.getModificationTime()] for e in entries if e.getPath().getName()[0] not in "._"}
        return {month: files for month, files in found.items() if files}

    def _sums(self, fact_path: str, files: list[str]) -> DataFrame:
        """The aggregate over some files of the fact; the month is read off their folders."""
        return self.kept.aggregate(self.spark.read.option("basePath", fact_path).parquet(*files))

    def _merged(self, parts: DataFrame) -> DataFrame:
        summed = [F.sum(m).cast(parts.schema[m].dataType).alias(m) for m in self.kept.measures]
        return parts.groupBy(*self.kept.grain).agg(*summed)

    def _stored(self, months: dict, some) -> DataFrame | None:
        paths = [months[m]["path"] for m in some if months[m]["path"]]
        return self.spark.read.parquet(*sorted(set(paths))) if paths else None

    def refresh(self, fact_path: str) -> Change:
        """Bring the sums up to date with the fact's files."""
        while True:
            number = VS.next_number(self.spark, self.root)
            old, now = self._manifest()["months"], self._listed(fact_path)
            added, anew = [], []
            for month, files in sorted(now.items()):
                before = old[month]["files"] if month in old else {}
                if before == files:
                    continue
                (added if before.items() <= files.items() else anew).append(month)
            change = Change(tuple(added), tuple(anew), tuple(sorted(set(old) - set(now))))
            if change == Change():
                return change
            version = f"{self.root}/v={uuid.uuid4().hex}"
            files = [f"{fact_path}/{MONTH}={m}/{f}" for m in added for f in sorted(set(now[m]) - set(old[m]["files"] if m in old else ()))]
            files += [f"{fact_path}/{MONTH}={m}/{f}" for m in anew for f in sorted(now[m])]
            months = {m: old[m] for m in now if m in old and m not in added and m not in anew}
            if files:
                new = self._sums(fact_path, files)
                earlier = self._stored(old, [m for m in added if m in old])
                # A stored folder holds a single month, so no month comes in that isn't added to.
                merged = self._merged(new.unionByName(earlier.select(*new.columns)) if earlier is not None else new)
                # A few rows a month: one file each.
                merged.repartition(F.col(MONTH)).withColumn("of", F.col(MONTH)).write.partitionBy("of").parquet(f"{version}/sums")
                written = {n.partition("=")[2] for n in folders(self.spark, f"{version}/sums") or [] if n.startswith("of=")}
                for m in (*added, *anew):  # a month may have rows and no sums
                    months[m] = {"path": f"{version}/sums/of={m}" if m in written else None, "files": now[m]}
            VS.create(self.spark, f"{version}/manifest.json", json.dumps({"months": months, "schema": self._schema(fact_path, now)}))
            try:
                VS.commit(self.spark, self.root, version, number)
            except VS.Conflict:
                VS.remove(self.spark, version)
                continue
            return change

    def _schema(self, fact_path: str, now: dict) -> str:
        month = next(iter(now), None)
        if month is None:
            return self._manifest().get("schema", "")
        return self._sums(fact_path, [f"{fact_path}/{MONTH}={month}/{next(iter(now[month]))}"]).schema.json()

    def read(self) -> DataFrame:
        """The sums of all months."""
        manifest = self._manifest()
        if not manifest.get("schema"):
            raise ValueError(f"{self.root} was never refreshed")
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        stored = self._stored(manifest["months"], manifest["months"])
        return stored.select(*schema.names) if stored is not None else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = KEPT) -> list[str]:
        """Delete folders of sums that none of the last ``keep`` manifests names."""
        entries = VS.log(self.spark, self.root)
        versions = [VS.read_text(self.spark, e) for _, e in entries]
        named = set(versions[-keep:])
        for v in versions[-keep:]:
            listed = json.loads(VS.read_text(self.spark, f"{v}/manifest.json"))["months"].values()
            named |= {x["path"].rsplit("/sums/", 1)[0] for x in listed if x["path"]}
        gone = [v for v in versions[:-keep] if v not in named and folders(self.spark, v) is not None]
        for v in gone:
            VS.remove(self.spark, v)
        return gone


def append_to_fact(df: DataFrame, fact_path: str) -> None:
    """Add rows to a month-partitioned fact, a few files a month; what is there stays."""
    df.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(fact_path)
