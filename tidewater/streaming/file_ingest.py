"""Incremental pickup of landed hourly files with Structured Streaming.

The file source remembers which files it has processed in its checkpoint, so
each run (``trigger(availableNow=True)``) ingests exactly the files that
landed since the previous run, then stops: a scheduled, restartable batch
with exactly-once bookkeeping. Each micro-batch is appended to a
day-partitioned staged-events table; the marts are then refreshed from that
table with the bounded lookback + keyed merge of :mod:`tidewater.plans.marts`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidewater import schemas
from tidewater.functions import parse_utc_timestamp
from tidewater.plans import notes
from tidewater.sources.files import RAW_GLOB


# The file source by default passes over files whose modification time lies a
# week behind the newest one it has seen; a late upload can carry any time.
NEVER_TOO_OLD = f"{100 * 365}d"


def staged_event_stream(spark: SparkSession, root: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming staged events from ``<root>/event_date=*/event_hour=*/*.json.gz``.

    Declared schema (a file stream never infers): only the staged paths are
    parsed; ``event_date``/``event_hour`` come from the folder names.
    """
    schema = StructType(list(schemas.STG_EVENT_JSON.fields) + [
        StructField("event_date", DateType()), StructField("event_hour", IntegerType())])
    reader = (spark.readStream.schema(schema)
                   .option("pathGlobFilter", RAW_GLOB)
                   .option("maxFileAge", NEVER_TOO_OLD))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return staged_columns(reader.json(root.rstrip("/")))


def staged_columns(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "event_date", "event_hour",
        F.col("id").alias("event_id"), F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"), F.col("actor.type").alias("actor_type"),
        F.col("repo.name").alias("repo_name"),
        parse_utc_timestamp(F.col("created_at")).alias("created_at"))


def ingest_available(spark: SparkSession, root: str, staged_location: str,
                     checkpoint: str, max_files_per_trigger: int | None = None) -> int:
    """Append every not-yet-seen file under ``root`` to the staged table.

    Returns the number of micro-batches run. The write inside
    ``foreachBatch`` is keyed by the batch id (see :func:`write_staged_batch`),
    so a batch replayed after a failure replaces its own output instead of
    duplicating it.
    """
    batches = []

    def write_batch(df: DataFrame, batch_id: int) -> None:
        write_staged_batch(df, staged_location, batch_id)
        batches.append(batch_id)

    q = (staged_event_stream(spark, root, max_files_per_trigger)
         .writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(batches)


BATCHES_SCHEMA = "event_date date, batch bigint"


def batches_path(staged_location: str) -> str:
    return staged_location.rstrip("/") + "_batches"


def note_days(spark: SparkSession, path: str, batch_of: dict) -> None:
    """Append (day, batch) notes. They travel as one literal."""
    noted = json.dumps({d.isoformat(): b for d, b in batch_of.items()})
    notes.append(spark, path, spark.range(1)
                 .select(F.explode(F.from_json(F.lit(noted), "map<string,bigint>"))
                         .alias("day", "batch"))
                 .select(F.col("day").cast("date").alias("event_date"), "batch"))


def write_staged_batch(df: DataFrame, staged_location: str, batch_id: int) -> list:
    """Write one micro-batch into ``<staged>/event_date=D/batch=N``; returns
    its days, which are noted beside the table.

    Day folders come first, so a reader of a few days lists only those days
    however many batches the stream has run. The dynamic overwrite replaces
    exactly the (day, batch) folders this batch writes: a replay of the batch
    after a failure replaces its own output and nothing else.
    """
    obs = Observation(f"stream_{uuid.uuid4().hex[:8]}")
    (df.withColumn("batch", F.lit(batch_id).cast("bigint")).hint("rebalance", "event_date")
       .observe(obs, F.collect_set("event_date").alias("days"))  # days of one batch
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd").partitionBy("event_date", "batch")
       .parquet(staged_location.rstrip("/")))
    days = sorted(obs.get.get("days") or [])
    if days:
        note_days(df.sparkSession, batches_path(staged_location), dict.fromkeys(days, batch_id))
    return days


# The staged table as written by the batches: day folders, then one folder
# per batch id. Declared, so reading it back never runs a schema-inference job.
STAGED_TABLE = StructType([
    StructField("event_hour", IntegerType()), StructField("event_id", StringType()),
    StructField("event_type", StringType()), StructField("actor_login", StringType()),
    StructField("actor_type", StringType()), StructField("repo_name", StringType()),
    StructField("created_at", TimestampType()),
    StructField("event_date", DateType()), StructField("batch", LongType()),
])


def read_staged(spark: SparkSession, staged_location: str, days=None) -> DataFrame:
    """The staged-events table (all batches), in model column order; with
    ``days``, only those day folders are listed and read."""
    root = staged_location.rstrip("/")
    reader = spark.read.schema(STAGED_TABLE).option("basePath", root)
    if days is None:
        df = reader.parquet(root)
    else:
        df = reader.parquet(f"{root}/event_date={{{','.join(d.isoformat() for d in days)}}}")
    return df.select(*schemas.STG_EVENTS_COLUMNS)


def refreshed_path(trends_location: str) -> str:
    return trends_location.rstrip("/") + "_refreshed"


def days_to_refresh(spark: SparkSession, staged_location: str, trends_location: str,
                    last_day, mart_exists: bool) -> dict:
    """Staged days up to ``last_day`` with their newest batch, where the mart
    lacks the day or was last refreshed from an older batch of it. A day that
    was never noted counts as not refreshed. Only the notes of batches and
    refreshes are compared; no staged folder is listed and no event read."""
    staged = (notes.read(spark, batches_path(staged_location), BATCHES_SCHEMA, distinct=False)
              .where(F.col("event_date") <= F.lit(last_day))
              .groupBy("event_date").agg(F.max("batch").alias("newest")))
    if mart_exists:
        built = spark.read.parquet(trends_location).select("event_date").distinct()
        noted = (notes.read(spark, refreshed_path(trends_location), BATCHES_SCHEMA, distinct=False)
                 .groupBy("event_date").agg(F.max("batch").alias("noted"))
                 .join(built, "event_date", "left_semi"))
        staged = (staged.join(noted, "event_date", "left")
                  .where(F.col("noted").isNull() | (F.col("newest") > F.col("noted"))))
    return {r["event_date"]: r["newest"] for r in staged.collect()}  # one row per day


def ingest_and_refresh_trends(spark: SparkSession, root: str, staged_location: str,
                              checkpoint: str, trends_location: str, as_of,
                              batched_at=None, max_files_per_trigger: int | None = None) -> int:
    """File stream -> staged table -> contributor-trends mart, per micro-batch.

    Each micro-batch is appended to the staged table; then the complete days
    (before ``as_of``) it touched are recomputed from the staged table and
    merged on the mart's key. Distinct counts are not additive, so touched
    days are recomputed rather than incremented; the work per batch is
    proportional to the days it touched, and late files for any day are
    repaired exactly. The first batch (no mart yet) builds it in full. Beside
    the mart stands, per day, the newest staged batch it was refreshed from.
    When the stream has caught up, every complete day that the mart lacks or
    that has a newer staged batch (its files came in a run whose ``as_of`` was
    not past it) is recomputed, so ``as_of`` may go back and forth.
    """
    from tidewater.days import ONE_DAY
    from tidewater.operators import intermediate, marts
    from tidewater.plans import sinks

    last_day = as_of - ONE_DAY
    batches = []
    # Whether the mart exists is known before the stream starts and changes
    # only when a batch creates it; no batch has to probe the folder.
    mart_exists = [sinks.table_exists(spark, trends_location)]

    def recompute(newest: dict) -> None:
        staged = read_staged(spark, staged_location, sorted(newest) if mart_exists[0] else None)
        batch = marts.contributor_trends(intermediate.events_classified(staged), as_of,
                                         batched_at=batched_at)
        if mart_exists[0]:
            sinks.delete_insert(spark, trends_location, batch, marts.TRENDS.keys, "event_date")
        else:
            sinks.write_full(spark, trends_location, batch, "event_date", operation="create")
            mart_exists[0] = True
        # Last: a failure before it has the days recomputed by the next run.
        note_days(spark, refreshed_path(trends_location), newest)

    def refresh(df: DataFrame, batch_id: int) -> None:
        days = write_staged_batch(df, staged_location, batch_id)
        batches.append(batch_id)
        touched = {d: batch_id for d in days if d <= last_day}
        if touched:
            recompute(touched)

    q = (staged_event_stream(spark, root, max_files_per_trigger)
         .writeStream.foreachBatch(refresh)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if sinks.table_exists(spark, staged_location):
        behind = days_to_refresh(spark, staged_location, trends_location, last_day,
                                 mart_exists[0])
        if behind:
            recompute(behind)
    return len(batches)
