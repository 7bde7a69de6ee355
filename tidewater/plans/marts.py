"""Incremental mart runners. By the calendar: full build on the first run,
bounded lookback recompute plus keyed delete+insert afterwards. By what was
written: the days that the source table's commits touched since the mart last
used them. And a backfill over any range of days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.days import ONE_DAY, DaySpan
from tidewater.operators.marts import DEFAULT_LOOKBACK_DAYS, MartSpec
from tidewater.operators.quality import Rule
from tidewater.plans import notes, sinks

#: Events of these days, for a mart to be built from.
ReadDays = Callable[[Sequence[dt.date]], DataFrame]


def refresh_from(spark: SparkSession, location: str, as_of: dt.date,
                 lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> dt.date:
    """First day that an incremental run recomputes: the start of the lookback
    or, after missed runs, the day after the last one built."""
    start = as_of - lookback_days * ONE_DAY
    last = spark.read.parquet(location).agg(F.max("event_date")).first()[0]
    return start if last is None else min(start, last + ONE_DAY)


def run_mart(spark: SparkSession, spec: MartSpec, source: DataFrame, location: str,
             as_of: dt.date, batched_at: dt.datetime | None = None,
             lookback_days: int = DEFAULT_LOOKBACK_DAYS, full_refresh: bool = False,
             fill_gap: bool = True, checks: Sequence[Rule] = ()) -> dict:
    """Build or update the mart at ``location`` as of ``as_of``.

    * target absent (or ``full_refresh``): every complete day before
      ``as_of`` is aggregated and the table replaced;
    * target present: the last ``lookback_days`` complete days (late data
      repair) and any days since the last one built are recomputed and merged
      on the mart's unique key. ``fill_gap=False`` keeps to the lookback, and
      leaves a hole where scheduled runs were missed.

    A batch that breaks one of the ``checks`` is refused and the mart stays as
    it was.
    """
    incremental = (not full_refresh) and sinks.table_exists(spark, location)
    if incremental and fill_gap:
        lookback_days = (as_of - refresh_from(spark, location, as_of, lookback_days)).days
    batch = spec.build(source, as_of, incremental=incremental, batched_at=batched_at,
                       lookback_days=lookback_days)
    if incremental:
        summary = sinks.delete_insert(spark, location, batch, spec.keys, spec.partition_column,
                                      checks=checks)
    else:
        summary = sinks.write_full(spark, location, batch, spec.partition_column, checks=checks,
                                   operation="create" if not full_refresh else "overwrite")
    summary["incremental"] = incremental
    return summary


# -- by what was written --------------------------------------------------------

MARKS_SCHEMA = "snapshot_id long, event_date date"


def marks_path(location: str) -> str:
    return location.rstrip("/") + "_marks"


def unused_commits(spark: SparkSession, source_location: str, location: str,
                   last_day: dt.date) -> DataFrame:
    """(snapshot_id, event_date): what commits of the source table wrote or
    emptied, up to ``last_day``, that the mart wasn't built from yet. A later
    day stays unused until it is complete."""
    summary = F.col("summary")
    touched = F.concat(*[F.coalesce(F.from_json(summary[name], "array<array<string>>"), F.array())
                         for name in ("folders", "emptied-folders")])
    days = (notes.read(spark, sinks.history_path(source_location), sinks.HISTORY_SCHEMA, False)
            .select("snapshot_id", F.explode(touched).alias("folder"))
            .select("snapshot_id", F.col("folder")[0].cast("date").alias("event_date"))
            .where(F.col("event_date") <= F.lit(last_day)).distinct())
    used = notes.read(spark, marks_path(location), MARKS_SCHEMA, False)
    return days.join(used, ["snapshot_id", "event_date"], "left_anti")


def run_mart_from_commits(spark: SparkSession, spec: MartSpec, source_location: str,
                          read_days: ReadDays, location: str, as_of: dt.date,
                          batched_at: dt.datetime | None = None,
                          days_per_write: int = sinks.DAYS_PER_WRITE) -> dict:
    """Build or update the mart from the source table's write history.

    Rebuilt are the complete days before ``as_of`` that a commit touched since
    the mart last used it, however long ago they are, and no others. Only
    those days are read. Days are marked as used after they are merged, so a
    run that fails in between has them built again by the next one.
    """
    unused = unused_commits(spark, source_location, location, as_of - ONE_DAY).collect()
    by_day: dict[dt.date, list] = {}
    for r in unused:  # commits and the days they wrote
        by_day.setdefault(r["event_date"], []).append((r["snapshot_id"], r["event_date"]))
    days = sorted(by_day)
    for k in range(0, len(days), days_per_write):
        part = days[k:k + days_per_write]
        merge_days(spark, spec, read_days, location, part, as_of, batched_at)
        notes.append(spark, marks_path(location), spark.createDataFrame(
            [mark for d in part for mark in by_day[d]], MARKS_SCHEMA))
    return {"days": [d.isoformat() for d in days]}


def merge_days(spark: SparkSession, spec: MartSpec, read_days: ReadDays, location: str,
               days: Sequence[dt.date], as_of: dt.date, batched_at: dt.datetime | None) -> None:
    batch = spec.build(read_days(days), as_of, batched_at=batched_at)
    if sinks.table_exists(spark, location):
        sinks.delete_insert(spark, location, batch, spec.keys, spec.partition_column)
    else:
        sinks.write_full(spark, location, batch, spec.partition_column, operation="create")


def backfill_mart(spark: SparkSession, spec: MartSpec, read_days: ReadDays, location: str,
                  first: dt.date, last: dt.date, as_of: dt.date,
                  batched_at: dt.datetime | None = None,
                  days_per_write: int = sinks.DAYS_PER_WRITE) -> dict:
    """Build the days ``[first, last]`` of a mart again, a month at a time; all
    other days stay as they are. A day that isn't complete is refused."""
    span = DaySpan(first, last)
    if last >= as_of:
        raise ValueError(f"{last} is not complete as of {as_of}")
    for part in span.chunks(days_per_write):
        merge_days(spark, spec, read_days, location, list(part), as_of, batched_at)
    return {"days": len(span)}


def read_mart(spark: SparkSession, location: str, columns: list[str]) -> DataFrame:
    return sinks.read_table(spark, location, order=columns)
