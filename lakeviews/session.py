"""SparkSession construction and the shared scratch location.

On a cluster the scratch location is the shared folder named by
``spark.checkpoint.dir``; it is read from the session and only set here when
it is missing (local tests).  Nothing is ever written to a machine-local
temporary folder when the setting exists.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings chosen for the workload: AQE re-plans joins from measured
# shuffle sizes (runtime broadcast, partition coalescing, skew splitting),
# ANSI mode makes overflow and bad casts fail unless a try_ form is used.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast joins are chosen only from *measured* sizes: the planner's
    # file-size estimate of a compressed table can be far below its size in
    # memory, so estimate-based broadcasting is off and AQE broadcasts a side
    # once its shuffle output is known to be under the threshold.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No Python call-site capture per Column call: plans here are built from
    # hundreds of column expressions, and the capture costs a stack walk each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MB = 1024 * 1024


def cluster_conf(input_bytes: int, total_cores: int, scan_mb: int = 512, partition_mb: int = 256,
                 shuffle_fraction: float = 0.25) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scans are split into ``scan_mb`` pieces.  The first shuffle of a query
    moves only the pruned columns, after map-side aggregation, so its volume
    is taken as ``shuffle_fraction`` of the input (line items, the largest
    table, are read for 4 of their 16 columns); it gets enough partitions
    that each holds about ``partition_mb`` of that (at least 2 per core, so
    every core has work).  Sizing reducers from the input instead would
    multiply the shuffle blocks (map tasks x reduce partitions) the driver
    tracks and every reducer fetches.  AQE then merges small partitions
    toward the advisory size (by size, not by parallelism) and splits skewed
    ones (five times the median and over 1 GiB).  Joins are broadcast only
    when the *measured* side is under 64 MiB (AQE); anything larger stays a
    sort-merge join, and no join is broadcast from a file-size estimate.
    """
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    shuffle = max(2 * total_cores, -(-shuffle_bytes // (partition_mb * MB)))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_mb * MB),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_mb * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * MB),
    }


def build_session(
    master: str | None = None,
    app_name: str = "lakeviews",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Session with the workload's settings.

    ``input_bytes`` / ``total_cores`` size partitions for a cluster run
    (see ``cluster_conf``); an explicit ``shuffle_partitions`` wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if input_bytes and total_cores:
        conf.update(cluster_conf(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Settings applied to any session that runs the registered queries.
_QUERY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def tune_session(spark: SparkSession) -> None:
    """Session-level settings the plans rely on (safe to call repeatedly).

    No estimate-based broadcasts (AQE decides from measured sizes) and AQE with
    skew-join splitting.  Only run-time settings are touched, so this works on a
    session built by anyone.
    The AQE broadcast threshold is set only if the session has none.
    """
    for key, value in _QUERY_CONF.items():
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) in (None, "", "-1"):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lakeviews-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the application's part of the shared checkpoint location."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lakeviews/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote with ``scratch_path``; results still to be read must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
