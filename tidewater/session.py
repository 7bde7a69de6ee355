"""Spark session conventions and shared scratch locations.

Every job in this package assumes:

* session time zone UTC (partition dates are UTC days),
* adaptive query execution on (runtime coalescing, skew-join splitting,
  runtime broadcast conversion),
* zstd Parquet output, timestamps as microseconds: unlike the legacy 96-bit
  form they have statistics, so time ranges skip row groups,
* dynamic partition overwrite, requested per write through the writer option
  so a caller's session default is never changed behind its back.

Durable intermediate state (staged merges, audit logs, stream checkpoints)
lives under the folder named by ``spark.checkpoint.dir``; on a cluster that is
a shared filesystem, so a lost executor never takes committed state with it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # gzip JSON is unsplittable: one task per hourly file; keep the packing
    # of small files sensible for parquet inputs.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str = "local[*]", app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package conventions."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conventions(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (dates in paths and marts are UTC days)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
SPARK_DEFAULT_LISTING_PARALLELISM = "10000"


def ensure_listing_parallelism(spark: SparkSession) -> None:
    """Cap parallel file listing at the cluster's default parallelism.

    When a listing covers more than 32 paths (a stream batch of hourly
    files, a day range of hour folders) Spark lists them with a job of one
    task per path, up to 10,000 tasks. A cluster still lists in parallel with
    the cap, each task taking a slice of the paths, instead of paying task
    scheduling per file. A value the deployment set is left alone.
    """
    if spark.conf.get(LISTING_PARALLELISM, SPARK_DEFAULT_LISTING_PARALLELISM) \
            == SPARK_DEFAULT_LISTING_PARALLELISM:
        cap = max(8, spark.sparkContext.defaultParallelism)
        spark.conf.set(LISTING_PARALLELISM, str(cap))


TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType"


def ensure_conventions(spark: SparkSession) -> None:
    """Session settings every job here relies on (idempotent, cheap)."""
    ensure_utc(spark)
    ensure_listing_parallelism(spark)
    if spark.conf.get(TIMESTAMP_TYPE) == "INT96":
        spark.conf.set(TIMESTAMP_TYPE, "TIMESTAMP_MICROS")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins. Only a bare local session (tests) gets a fresh temp folder;
    a cluster session without the setting is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # Executors on other machines cannot see a folder on this one.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(staged merges, landed copies and stream checkpoints live there)")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    base = configured or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tidewater/{label}-{uuid.uuid4().hex[:12]}"
