"""Lake load job: landed hourly JSON for a date range -> day-partitioned
Parquet events table, with a completeness guard and a count round trip.

The completeness guard reads the reader's own file listing (no job). Input
is scanned once: explicit schema (no inference pass), counts collected
by ``observe`` during the write, target counts read back from the touched
partitions only (Parquet footers answer the counts).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidewater import schemas
from tidewater.days import DaySpan
from tidewater.operators import lake
from tidewater.plans import sinks
from tidewater.plans.clustering import cluster_days
from tidewater.sources import files

PART = schemas.LAKE_PARTITION_COLUMN
# The table's own schema: read-backs skip the footer-inference job.
TABLE_SCHEMA = StructType(list(schemas.LAKE_EVENTS.fields)
                          + [StructField(PART, DateType()), StructField(sinks.LANDED, DateType())])


def ensure_events_table(spark: SparkSession, location: str, name: str | None = None) -> None:
    if name:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLE_SCHEMA.fields)
        sinks.ensure_table(spark, name, location, columns, f"{PART}, {sinks.LANDED}")


def write_events(spark: SparkSession, normalized: DataFrame, location: str,
                 start: dt.date, end: dt.date, extra_metrics: dict | None = None,
                 drop_columns: tuple[str, ...] = (), landing_column: str | None = None) -> dict:
    """Overwrite what landed on the days ``[start, end]`` from normalized events."""
    return sinks.overwrite_days(spark, lake.with_created_date(normalized), location, PART,
                                start, end, extra_metrics=extra_metrics,
                                drop_columns=drop_columns, landing_column=landing_column)


def read_days(spark: SparkSession, location: str, start: dt.date, end: dt.date) -> DataFrame:
    """The table's rows of the days ``[start, end]``: only those day folders
    are listed, whatever the length of the table."""
    root = location.rstrip("/")
    return (spark.read.schema(TABLE_SCHEMA).option("basePath", root)
                 .parquet(DaySpan(start, end).folders(root, PART)))


def read_day_list(spark: SparkSession, location: str, days: Sequence[dt.date]) -> DataFrame:
    """The table's rows of these days; no other day folder is listed."""
    root = location.rstrip("/")
    names = ",".join(d.isoformat() for d in days)
    return (spark.read.schema(TABLE_SCHEMA).option("basePath", root)
                 .parquet(f"{root}/{PART}={{{names}}}"))


def read_events(spark: SparkSession, location: str) -> DataFrame:
    """The whole table, with its declared schema."""
    return spark.read.schema(TABLE_SCHEMA).parquet(location)


def cluster_events(spark: SparkSession, location: str, start: dt.date, end: dt.date,
                   days_per_write: int = sinks.DAYS_PER_WRITE, **how) -> None:
    """Cluster the settled days ``[start, end]`` by time, a month at a time,
    with Bloom filters on the event id and the repository name."""
    for days in DaySpan(start, end).chunks(days_per_write):
        cluster_days(spark, location, TABLE_SCHEMA, list(days), (PART, sinks.LANDED),
                     "created_at", ("id", "repo.name"), **how)


def target_counts(spark: SparkSession, location: str, folders: list[list]) -> DataFrame:
    """Rows per landing day, read back from these folders (day, landing day)
    of a commit: no other folder of the table is listed, and Parquet footers
    answer the counts."""
    if not folders:
        return spark.createDataFrame([], "event_date date, target_count bigint")
    t = (spark.read.schema(TABLE_SCHEMA).option("basePath", location.rstrip("/"))
              .parquet(*[sinks.folder(location, PART, day, landed) for day, landed in folders]))
    return (t.groupBy(F.col(sinks.LANDED).alias("event_date"))
             .agg(F.count(F.lit(1)).alias("target_count")))


def load_events(spark: SparkSession, raw_root: str, location: str, start: dt.date,
                end: dt.date, table_name: str | None = None) -> dict:
    """Load ``[start, end]`` from the landed files; refuse on missing days."""
    src = files.read_lake_source(spark, raw_root, start, end)
    files.assert_days_listed(src, start, end)
    ensure_events_table(spark, location, table_name)
    broken = F.col("_corrupt_record")
    normalized = (lake.normalize_parsed(src, keep=("_corrupt_record", "event_date"))
                  # An unreadable line is kept: its text is the payload of a row without a day.
                  .withColumn("payload", F.when(F.to_date("created_at").isNull(),
                                                F.coalesce("payload", broken))
                              .otherwise(F.col("payload"))))
    summary = write_events(spark, normalized, location, start, end,
                           extra_metrics={"corrupt-records": F.count_if(broken.isNotNull())},
                           drop_columns=("_corrupt_record",), landing_column="event_date")
    if table_name:
        register_partitions(spark, table_name, summary["folders"], summary["emptied-folders"])
    return summary


def run_load(spark: SparkSession, raw_root: str, location: str, start: dt.date, end: dt.date,
             table_name: str | None = None) -> DataFrame:
    """The whole load job: guard, read, normalise, write, count round trip.
    Returns the reconciliation; a difference between what was read and what
    is stored is an error."""
    summary = load_events(spark, raw_root, location, start, end, table_name)
    report = reconciliation_from_summary(spark, summary, location)
    wrong = report.where("delta <> 0").count()
    if wrong:
        raise RuntimeError(f"the table does not hold what was read on {wrong} day(s)")
    return report


def register_partitions(spark: SparkSession, table_name: str, folders: list[list],
                        emptied: list[list] = ()) -> None:
    """Make newly written day folders visible to SQL readers of the table, and
    forget those that are gone.

    Only the folders this load touched are named (bounded by the requested
    range and its stragglers; rows without a day belong to no named partition),
    so the catalog never rescans a large table; queries on the table then
    prune partitions in the catalog before listing any folder.
    """
    def parts(pairs: list[list], between: str) -> str:
        return between.join(f"PARTITION ({PART} = DATE '{day}', {sinks.LANDED} = DATE '{landed}')"
                            for day, landed in sorted(p for p in pairs if p[0]))
    if parts(folders, " "):
        spark.sql(f"ALTER TABLE {table_name} ADD IF NOT EXISTS {parts(folders, ' ')}")
    if parts(emptied, ", "):
        spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS {parts(emptied, ', ')}")
    spark.sql(f"REFRESH TABLE {table_name}")


def reconciliation_from_summary(spark: SparkSession, summary: dict,
                                location: str) -> DataFrame:
    """Source counts (observed during the write) against the read-back target:
    the folders the commit filled."""
    per_day = summary["per-day"]
    src = spark.createDataFrame([(dt.date.fromisoformat(k), int(v)) for k, v in per_day.items() if v],
                                "event_date date, source_count bigint")
    return lake.reconcile(src, target_counts(spark, location, summary["folders"])).orderBy(
        "event_date")
