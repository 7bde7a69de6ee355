"""Model build from landed files: raw events + repo snapshots -> both marts.

One call is one scheduled run: staged -> classified (written once) ->
contributor trends; classified + latest metadata -> enriched -> language
activity. Each mart is
built in full on its first run and then refreshed over the lookback window
with a keyed merge. The raw read is bounded to the days the run can touch,
so partition pruning keeps an incremental run's scan to a few day folders.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.days import ONE_DAY
from tidewater.functions.columns import bytes_of_rows
from tidewater.operators import intermediate, marts, staging
from tidewater.operators.marts import DEFAULT_LOOKBACK_DAYS
from tidewater.plans import notes, sinks
from tidewater.plans.marts import refresh_from, run_mart
from tidewater.session import scratch_path
from tidewater.sources import files


def build_marts(spark: SparkSession, raw_root: str, snapshot_root: str, trends_location: str,
                language_location: str, as_of: dt.date, first_day: dt.date,
                batched_at: dt.datetime | None = None,
                lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> dict:
    """Run both marts as of ``as_of``; returns the two commit summaries. A day
    of the run without landed files is refused, as in the load job."""
    last_day = as_of - ONE_DAY
    incremental = (sinks.table_exists(spark, trends_location)
                   and sinks.table_exists(spark, language_location))
    start = first_day
    if incremental:
        start = max(first_day, min(refresh_from(spark, loc, as_of, lookback_days)
                                   for loc in (trends_location, language_location)))
    stg = files.read_staged_events(spark, raw_root, start, last_day)
    files.assert_days_listed(stg, start, last_day)
    stage = scratch_path(spark, "classified")
    classified = stage_classified(spark, intermediate.events_classified(stg), stage)
    meta = stage_metadata(spark, staging.latest_repo_metadata(
        files.read_repo_snapshots(spark, snapshot_root)), f"{stage}-metadata")
    enriched = intermediate.events_enriched(classified, meta)
    built = {
        "contributor_trends": run_mart(spark, marts.TRENDS, classified, trends_location, as_of,
                                       batched_at=batched_at, lookback_days=lookback_days),
        "language_activity": run_mart(spark, marts.LANGUAGE, enriched, language_location, as_of,
                                      batched_at=batched_at, lookback_days=lookback_days),
    }
    notes.remove(spark, [stage, f"{stage}-metadata"])
    return built


#: Metadata up to this size in memory is sent to every task of the enrichment.
BROADCAST_METADATA = 32 << 20


def stage_metadata(spark: SparkSession, meta: DataFrame, loc: str,
                   broadcast_bytes: int = BROADCAST_METADATA) -> DataFrame:
    """Write the latest metadata once, measured, and read it back with the way
    in which events are to be joined to it: it is broadcast if it is small,
    else both sides are shuffled.

    Left to the sizes of files, a join that keeps only events with a language
    (an inner one) may broadcast the events, which files pack very tightly:
    all of them are then joined and added up in the few tasks of the metadata.
    """
    obs = Observation(f"metadata_{uuid.uuid4().hex[:8]}")
    (meta.observe(obs, F.count(F.lit(1)).alias("rows"), bytes_of_rows(meta.schema).alias("bytes"))
         .write.mode("overwrite").parquet(loc))
    staged = spark.read.schema(meta.schema).parquet(loc)
    return staged.hint("broadcast" if obs.get["bytes"] <= broadcast_bytes else "merge")


def stage_classified(spark: SparkSession, classified: DataFrame, loc: str) -> DataFrame:
    """Write the classified push events once, day-partitioned, under the
    shared checkpoint folder, and read them back for both marts.

    Both marts consume the same events; without this each would scan and
    parse the landed JSON itself. The staged table holds only push events and
    the model's ten columns, so the second consumer reads a small columnar
    table instead of the raw text, and lineage is cut before the two
    aggregations (a lost executor recomputes from these files).
    """
    (classified.hint("rebalance", "event_date").write.mode("overwrite")
               .option("compression", "zstd").partitionBy("event_date").parquet(loc))
    schema = StructType([f for f in classified.schema.fields if f.name != "event_date"]
                        + [classified.schema["event_date"]])
    return spark.read.schema(schema).parquet(loc).select(*classified.columns)


def register_views(spark: SparkSession, raw_root: str, snapshot_root: str,
                   trends_location: str | None = None,
                   language_location: str | None = None) -> list[str]:
    """Register the staging and intermediate models (and the marts, when
    built) as temporary views, for SQL users. Views are logical: each query
    on them is planned (and pruned) from the files again."""
    from tidewater import schemas
    from tidewater.plans.marts import read_mart

    stg = files.read_staged_events(spark, raw_root)
    classified = intermediate.events_classified(stg)
    meta = staging.latest_repo_metadata(files.read_repo_snapshots(spark, snapshot_root))
    views = {
        "stg_events": stg,
        "stg_repo_metadata": meta,
        "events_classified": classified,
        "events_enriched": intermediate.events_enriched(classified, meta),
    }
    if trends_location:
        views["mart_contributor_trends"] = read_mart(
            spark, trends_location, schemas.TRENDS_KEYS + ["event_count", "unique_contributors",
                                                          "_sdc_batched_at"])
    if language_location:
        views["mart_language_activity"] = read_mart(
            spark, language_location, schemas.LANGUAGE_KEYS + [
                "event_count", "unique_contributors", "unique_repos", "_sdc_batched_at"])
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
