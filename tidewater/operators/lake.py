"""Lake events table: normalisation of nested raw events and the queries
served from the day-partitioned table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import schemas

PART = schemas.LAKE_PARTITION_COLUMN


def normalize_events(lines: DataFrame, line_col: str = "line",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested raw event text -> the 8 lake columns.

    Structs are resolved by field name through the declared schema (unknown
    keys dropped, any key order accepted); ``payload`` stays JSON text; the
    ISO-8601 ``created_at`` becomes a TIMESTAMP.
    """
    j = F.from_json(F.col(line_col), schemas.LAKE_EVENT_JSON)
    return normalize_parsed(lines.select(j.alias("j"), *keep).select("j.*", *keep), keep)


def normalize_parsed(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast already-parsed top-level fields to the lake columns (``keep``
    passes extra columns such as a corrupt-record marker through)."""
    return parsed.select(
        F.col("id").cast("string").alias("id"),
        F.col("type").cast("string").alias("type"),
        F.col("actor"),
        F.col("repo"),
        F.col("payload"),
        F.col("public").cast("boolean").alias("public"),
        F.try_to_timestamp(F.col("created_at")).alias("created_at"),
        F.col("org"),
        *[F.col(c) for c in keep if c in parsed.columns],
    )


def with_created_date(events: DataFrame) -> DataFrame:
    """Add the day partition column derived from ``created_at`` (UTC)."""
    return events.withColumn(PART, F.to_date("created_at"))


def time_bounds(ts: Column, start: dt.datetime, end: dt.datetime) -> Column:
    """Half-open ``[start, end)`` on a TIMESTAMP column."""
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def day_bounds(start: dt.datetime, end: dt.datetime) -> Column:
    """The day-partition range implied by ``[start, end)`` on ``created_at``.

    Parquet cannot prune partitions from a predicate on ``created_at`` alone,
    so readers add this implied predicate on the partition column.
    """
    last = (end - dt.timedelta(microseconds=1)).date()
    return (F.col(PART) >= F.lit(start.date())) & (F.col(PART) <= F.lit(last))


def time_range(events: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows with ``start <= created_at < end``, pruned to the touched days."""
    out = events
    if PART in events.columns:
        out = out.filter(day_bounds(start, end))
    return out.filter(time_bounds(F.col("created_at"), start, end))


def events_per_day(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.to_date("created_at").alias("event_date"))
                  .agg(F.count(F.lit(1)).alias("event_count"))
                  .orderBy("event_date"))


def top_event_types(events: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` event types by count; ties broken by type name."""
    return (events.groupBy("type").agg(F.count(F.lit(1)).alias("event_count"))
                  .orderBy(F.desc("event_count"), F.asc("type")).limit(n))


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("row_count"))


def payload_field(payload: Column, path: str, type_: str) -> Column:
    """Parse one path out of the JSON-text payload on demand."""
    return F.get_json_object(payload, path).cast(type_)


def flatten(events: DataFrame) -> DataFrame:
    """One column per nested field (``actor.login`` -> ``actor_login``)."""
    cols = []
    for f in events.schema.fields:
        if hasattr(f.dataType, "fields"):
            cols += [F.col(f"{f.name}.{s.name}").alias(f"{f.name}_{s.name}")
                     for s in f.dataType.fields]
        else:
            cols.append(F.col(f.name))
    return events.select(*cols)


def per_day_counts(events: DataFrame, date_col: Column, name: str) -> DataFrame:
    return events.groupBy(date_col.alias("event_date")).agg(F.count(F.lit(1)).alias(name))


def reconcile(source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Source-to-target per-day counts side by side with their difference."""
    j = source_counts.join(target_counts, "event_date", "full_outer")
    return j.select(
        "event_date",
        F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.coalesce("target_count", F.lit(0)).alias("target_count"),
        (F.coalesce("target_count", F.lit(0)) - F.coalesce("source_count", F.lit(0))).alias("delta"),
    )
