"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver tables (through the adaptations in
:mod:`tidewater.sources.fixtures`) and runs over them whole. Parameters that a
scheduler would supply (``as_of``, ``batched_at``) are fixed here so results
are deterministic.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidewater.functions import landing_key, previous_full_hour, repo_name_parts
from tidewater.functions.sql import register_sql_functions
from tidewater.operators import (distinct_sets, intermediate, lake, marts, quality, serving,
                                 staging)
from tidewater.plans import lake_load, sinks
from tidewater.plans.marts import backfill_mart, read_mart, run_mart, run_mart_from_commits
from tidewater.plans.model_build import stage_metadata
from tidewater.session import ensure_conventions, scratch_path
from tidewater.sources import files, fixtures
from tidewater.streaming import file_ingest, notified

AS_OF = dt.date(2024, 1, 30)
BATCHED_AT = dt.datetime(2024, 1, 30, 6, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_conventions(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        return run
    return deco


# -- shared model builders ---------------------------------------------------

def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_events(fixtures.raw_events(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.events_classified(stg(spark, sf_dir))


def latest_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.latest_repo_metadata(fixtures.raw_repo_snapshots(spark, sf_dir))


def staged_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metadata(spark, latest_meta(spark, sf_dir), scratch_path(spark, "metadata"))


def enriched(spark: SparkSession, sf_dir: str, with_match_flag: bool = False) -> DataFrame:
    return intermediate.events_enriched(classified(spark, sf_dir), staged_meta(spark, sf_dir),
                                        with_match_flag=with_match_flag)


def trends_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.contributor_trends(classified(spark, sf_dir), AS_OF, batched_at=BATCHED_AT)


def language_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.language_activity(enriched(spark, sf_dir), AS_OF, batched_at=BATCHED_AT)


def lake_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized lake events straight from the fixture lines (no write)."""
    return lake.normalize_events(fixtures.raw_lake_lines(spark, sf_dir))


def data_days(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last UTC day present in the driver events (whole table)."""
    r = fixtures.driver_events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    return r[0].date(), r[1].date()


_LAKE_TABLES: dict[tuple[str, str], str] = {}


def lake_table(spark: SparkSession, sf_dir: str) -> str:
    """Location of the loaded lake table for ``sf_dir`` (loaded once per
    application into the shared scratch folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    loc = _LAKE_TABLES.get(key)
    if loc is None or not sinks.table_exists(spark, loc):
        loc = scratch_path(spark, "lake-events")
        start, end = data_days(spark, sf_dir)
        lake_load.write_events(spark, lake_events(spark, sf_dir), loc, start, end)
        _LAKE_TABLES[key] = loc
    return loc


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df



# The serving time range (half-open) and the scan range.
SERVE_START, SERVE_END = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 15)
SCAN_START, SCAN_END = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 10)
RANGE_START, RANGE_END = dt.date(2024, 1, 5), dt.date(2024, 1, 11)
GUARD_START, GUARD_END = dt.date(2023, 12, 30), dt.date(2024, 2, 2)


# -- sources and staging -----------------------------------------------------

@query("raw_event_scan")
def q_raw_event_scan(spark, sf_dir):
    """OP-S1: one value per line of the landed files, with its path partitions."""
    return files.read_raw_events(spark, fixtures.landed_event_files(spark, sf_dir))


@query("raw_event_variant")
def q_raw_event_variant(spark, sf_dir):
    """OP-S1/P1: the landed lines as VARIANT, staged by typed paths; a line
    that is no JSON is kept beside."""
    raw = files.read_raw_variant(spark, fixtures.landed_files_with_broken_lines(spark, sf_dir))
    return staging.stg_from_variant(raw)


@query("path_partitions")
def q_path_partitions(spark, sf_dir):
    """OP-S2: rows per landed file; date and hour parsed from the scan's file
    path, none for a folder that isn't named by them."""
    per_file = files.rows_per_file(files.read_with_file_metadata(
        spark, fixtures.landed_mixed_files(spark, sf_dir)))
    return per_file.select("folder", "event_date", "event_hour", "n_events",
                           F.col("file_modified").isNotNull().alias("has_time"))


@query("repo_snapshot_scan")
def q_repo_snapshot_scan(spark, sf_dir):
    """OP-S3: typed repo snapshot columns with the path date."""
    t = staging.stg_repo_metadata_typed(fixtures.raw_repo_snapshots(spark, sf_dir))
    return t.select("enriched_date", F.col("repo_full_name").alias("full_name"), "language",
                    "topics", "stargazers_count", "forks_count", "is_fork",
                    F.col("repo_created_at").alias("created_at"), "description")


@query("date_range_scan")
def q_date_range_scan(spark, sf_dir):
    """OP-S4: inclusive day-range scan: only those day folders are listed."""
    return files.read_raw_events(spark, fixtures.landed_event_files(spark, sf_dir),
                                 RANGE_START, RANGE_END)


@query("normalize_nested_events")
def q_normalize_nested_events(spark, sf_dir):
    """OP-S5/P12: nested events normalized by field name, flattened."""
    return _ntz(lake.flatten(lake_events(spark, sf_dir)), "created_at")


@query("missing_dates")
def q_missing_dates(spark, sf_dir):
    """OP-S6: requested days without a landed file (folder listing)."""
    landed = files.landed_dates(spark, fixtures.landed_event_files(spark, sf_dir),
                                GUARD_START, GUARD_END)
    return files.missing_dates(spark, landed, GUARD_START, GUARD_END)


@query("time_range_scan")
def q_time_range_scan(spark, sf_dir):
    """OP-S8/F5: half-open created_at range on the lake table, day-pruned."""
    t = lake_load.read_days(spark, lake_table(spark, sf_dir), SCAN_START.date(), SCAN_END.date())
    return _ntz(lake.time_range(t, SCAN_START, SCAN_END).select("id", "type", "created_at"),
                "created_at")


@query("stg_events")
def q_stg_events(spark, sf_dir):
    """OP-P1: typed JSON path extraction of the staged events."""
    return stg(spark, sf_dir)


@query("stg_repo_metadata_typed")
def q_stg_repo_metadata_typed(spark, sf_dir):
    """OP-P2: typed extraction of every repo snapshot record."""
    return staging.stg_repo_metadata_typed(fixtures.raw_repo_snapshots(spark, sf_dir))


@query("stg_repo_metadata")
def q_stg_repo_metadata(spark, sf_dir):
    """OP-W1: latest record per repository."""
    return latest_meta(spark, sf_dir)


# -- projections and scalar functions -----------------------------------------

@query("payload_extract")
def q_payload_extract(spark, sf_dir):
    """OP-P7: payload kept as JSON text, parsed on demand."""
    t = lake_load.read_events(spark, lake_table(spark, sf_dir))
    return t.select("id", lake.payload_field(F.col("payload"), "$.k", "int").alias("payload_k"))


@query("repo_name_split")
def q_repo_name_split(spark, sf_dir):
    """OP-P9/F8: request list of the top bot repos split into owner/repo."""
    top = serving.top_bot_repos(classified(spark, sf_dir), 100)
    owner, repo, ok = repo_name_parts(F.col("repo_name"))
    return top.filter(ok).select("repo_name", owner.alias("owner"), repo.alias("repo"))


@query("repo_record_projection")
def q_repo_record_projection(spark, sf_dir):
    """OP-P10: API record projection with renames and default topics."""
    return staging.repo_record_projection(fixtures.api_repo_records(spark, sf_dir))


@query("previous_hour")
def q_previous_hour(spark, sf_dir):
    """Most recently completed hour before each event time."""
    ev = fixtures.driver_events(spark, sf_dir)
    return ev.select("event_id", previous_full_hour(F.col("ts")).alias("target_hour"))


@query("landing_key")
def q_landing_key(spark, sf_dir):
    """Object key of the hourly file to fetch for each event time."""
    ev = fixtures.driver_events(spark, sf_dir)
    return ev.select("event_id", landing_key(previous_full_hour(F.col("ts"))).alias("landing_key"))


# -- filters, intermediate, joins ---------------------------------------------

@query("push_events")
def q_push_events(spark, sf_dir):
    """OP-F1: keep one event type."""
    return intermediate.push_events(stg(spark, sf_dir))


@query("events_classified")
def q_events_classified(spark, sf_dir):
    """OP-P3/P4/F6: bot flag and contributor label over push events."""
    return classified(spark, sf_dir)


@query("events_enriched")
def q_events_enriched(spark, sf_dir):
    """OP-J1: left join of classified events to the latest repo metadata."""
    return enriched(spark, sf_dir)


@query("enrichment_coverage")
def q_enrichment_coverage(spark, sf_dir):
    """OP-J3: matched versus unmatched rows of the enrichment join."""
    return intermediate.enrichment_coverage(enriched(spark, sf_dir, with_match_flag=True))


# -- marts -------------------------------------------------------------------

@query("contributor_trends")
def q_contributor_trends(spark, sf_dir):
    """OP-A1/F2: daily contributor trends, full build as of 2024-01-30."""
    return trends_mart(spark, sf_dir)


@query("language_activity")
def q_language_activity(spark, sf_dir):
    """OP-A2/P5/F4: daily language activity, full build as of 2024-01-30."""
    return language_mart(spark, sf_dir)


def _language_sets(spark, sf_dir):
    """Counts and sets of the two halves of every day, as two partial loads
    would store them."""
    base = scratch_path(spark, "sets")
    e = marts.mart_window(enriched(spark, sf_dir), AS_OF, incremental=False)
    stored: dict[str, list[DataFrame]] = {}
    for name, part in (("am", e.where(F.col("event_hour") < 12)),
                       ("pm", e.where(F.col("event_hour") >= 12))):
        actors, repos = (distinct_sets.number_values(spark, f"{base}/{c}", part.select(c))
                         for c in ("actor_login", "repo_name"))
        counts, sets = marts.language_sets(part, actors, repos)
        for what, df in {"counts": counts, **sets}.items():
            df.write.parquet(f"{base}/{name}/{what}")
            stored.setdefault(what, []).append(spark.read.parquet(f"{base}/{name}/{what}"))
    merged = {what: am.unionByName(pm) for what, (am, pm) in stored.items()}
    return merged.pop("counts"), merged


@query("language_activity_sets")
def q_language_activity_sets(spark, sf_dir):
    """OP-A2: the language mart merged from two parts of each day by bitmaps."""
    counts, sets = _language_sets(spark, sf_dir)
    return marts.language_from_sets(counts, sets, marts.LANGUAGE.keys,
                                    batched_at=BATCHED_AT).select(*LANGUAGE_COLUMNS)


@query("distinct_over_range")
def q_distinct_over_range(spark, sf_dir):
    """OP-A5: per language over a range of days the true distinct actors and
    repositories, beside the documented sums of daily counts."""
    counts, sets = _language_sets(spark, sf_dir)
    in_range = F.col("event_date").between(RANGE_START, RANGE_END)
    counts = counts.where(in_range)
    sets = {name: s.where(in_range) for name, s in sets.items()}
    daily = marts.language_from_sets(counts, sets, marts.LANGUAGE.keys, batched_at=BATCHED_AT)
    summed = daily.groupBy(F.col("language").alias("_language")).agg(
        F.sum("unique_repos").alias("summed_repos"))
    true = marts.language_from_sets(counts, sets, ["language"], batched_at=BATCHED_AT)
    return true.join(summed, true["language"] == summed["_language"]).select(
        "language", "event_count", "unique_contributors", "unique_repos", "summed_repos")


@query("trends_lookback_batch")
def q_trends_lookback_batch(spark, sf_dir):
    """OP-F3: the batch an incremental run as of 2024-01-30 recomputes."""
    return marts.contributor_trends(classified(spark, sf_dir), AS_OF, incremental=True,
                                    batched_at=BATCHED_AT)


@query("language_lookback_batch")
def q_language_lookback_batch(spark, sf_dir):
    """OP-F3: the language batch of an incremental run as of 2024-01-30."""
    return marts.language_activity(enriched(spark, sf_dir), AS_OF, incremental=True,
                                   batched_at=BATCHED_AT)


# The late-data scenario (first build over hours < 22 as of
# 01-27, then an incremental run over all hours as of 01-28).
LATE_FIRST_AS_OF, LATE_SECOND_AS_OF = dt.date(2024, 1, 27), dt.date(2024, 1, 28)
LATE_FIRST_AT = dt.datetime(2024, 1, 27, 6, 0, 0)
LATE_SECOND_AT = dt.datetime(2024, 1, 28, 6, 0, 0)
VANISHED_DAY = dt.date(2024, 1, 26)


def _two_runs(spark, spec, first_source, second_source, columns, first_as_of=LATE_FIRST_AS_OF,
              second_as_of=LATE_SECOND_AS_OF, first_at=LATE_FIRST_AT, second_at=LATE_SECOND_AT):
    loc = scratch_path(spark, spec.name)
    run_mart(spark, spec, first_source, loc, first_as_of, batched_at=first_at)
    run_mart(spark, spec, second_source, loc, second_as_of, batched_at=second_at)
    return read_mart(spark, loc, columns)


TRENDS_COLUMNS = ["event_date", "contributor_type", "event_count", "unique_contributors",
                  "_sdc_batched_at"]
LANGUAGE_COLUMNS = ["event_date", "language", "contributor_type", "event_count",
                    "unique_contributors", "unique_repos", "_sdc_batched_at"]


@query("trends_late_data_repair")
def q_trends_late_data_repair(spark, sf_dir):
    """OP-M2/K3: late rows of the last three days repaired by the rerun."""
    c = classified(spark, sf_dir)
    return _two_runs(spark, marts.TRENDS, c.filter(F.col("event_hour") < 22), c, TRENDS_COLUMNS)


@query("trends_delete_insert")
def q_trends_delete_insert(spark, sf_dir):
    """OP-K3/J2: keyed delete+insert; a key vanished from the rerun stays."""
    c = classified(spark, sf_dir)
    second = c.filter(~((F.col("event_date") == F.lit(VANISHED_DAY))
                        & (F.col("contributor_type") == "bot")))
    return _two_runs(spark, marts.TRENDS, c.filter(F.col("event_hour") < 22), second,
                     TRENDS_COLUMNS)


@query("trends_full_then_incremental")
def q_trends_full_then_incremental(spark, sf_dir):
    """OP-M3: the first run builds everything, the next only its lookback."""
    c = classified(spark, sf_dir)
    return _two_runs(spark, marts.TRENDS, c, c, TRENDS_COLUMNS,
                     first_as_of=dt.date(2024, 1, 20), second_as_of=AS_OF,
                     first_at=dt.datetime(2024, 1, 20, 6, 0, 0), second_at=BATCHED_AT)


@query("trends_after_outage")
def q_trends_after_outage(spark, sf_dir):
    """OP-M3: runs missed between 01-04 and 01-11; the next one fills the gap."""
    c = classified(spark, sf_dir)
    return _two_runs(spark, marts.TRENDS, c, c, TRENDS_COLUMNS,
                     first_as_of=dt.date(2024, 1, 4), second_as_of=dt.date(2024, 1, 11),
                     first_at=BATCHED_AT, second_at=BATCHED_AT)


# The afternoon of one day lands eleven days late.
LATE_DAY, LATE_HOUR, COMMITS_AS_OF = dt.date(2024, 1, 10), 12, dt.date(2024, 1, 21)
COMMITS_FIRST_AT, COMMITS_SECOND_AT = (dt.datetime(2024, 1, 21, 6), dt.datetime(2024, 1, 21, 18))


def _marts_by_commits(spark, sf_dir, spec, from_staged):
    """Load all days but the late afternoon, build the mart from the commits;
    land the late day whole, build again."""
    base = scratch_path(spark, "by-commits")
    table, mart = f"{base}/events", f"{base}/{spec.name}"
    events = lake.normalize_events(fixtures.raw_events(spark, sf_dir), "raw_event",
                                   keep=("event_date", "event_hour"))
    late = (F.col("event_date") == F.lit(LATE_DAY)) & (F.col("event_hour") >= LATE_HOUR)
    start, _ = data_days(spark, sf_dir)
    runs = [(events.where(~late), start, COMMITS_AS_OF - dt.timedelta(days=1), COMMITS_FIRST_AT),
            (events, LATE_DAY, LATE_DAY, COMMITS_SECOND_AT)]

    def read(days):
        return from_staged(staging.stg_from_lake(lake_load.read_day_list(spark, table, days)))
    for rows, first, last, at in runs:
        lake_load.write_events(spark, rows.drop("event_hour"), table, first, last,
                               landing_column="event_date")
        run_mart_from_commits(spark, spec, table, read, mart, COMMITS_AS_OF, batched_at=at)
    return mart


@query("marts_after_late_commit")
def q_marts_after_late_commit(spark, sf_dir):
    """OP-M2: the write history says what to rebuild: a day that landed late
    is repaired, eleven days on, and no other day is rewritten."""
    mart = _marts_by_commits(spark, sf_dir, marts.TRENDS, intermediate.events_classified)
    return read_mart(spark, mart, TRENDS_COLUMNS)


@query("language_after_late_commit")
def q_language_after_late_commit(spark, sf_dir):
    """OP-M2: the same for the language mart."""
    meta = staged_meta(spark, sf_dir)
    mart = _marts_by_commits(spark, sf_dir, marts.LANGUAGE, lambda stg: (
        intermediate.events_enriched(intermediate.events_classified(stg), meta)))
    return read_mart(spark, mart, LANGUAGE_COLUMNS)


@query("mart_backfill_range")
def q_mart_backfill_range(spark, sf_dir):
    """OP-M4: a range of days of a mart is built again, the rest stays."""
    c = classified(spark, sf_dir)
    loc = scratch_path(spark, "backfill")
    run_mart(spark, marts.TRENDS, c.filter(F.col("event_hour") < 22), loc, AS_OF,
             batched_at=LATE_FIRST_AT)
    backfill_mart(spark, marts.TRENDS, lambda days: c.filter(F.col("event_date").isin(list(days))),
                  loc, RANGE_START, RANGE_END, AS_OF, batched_at=BATCHED_AT, days_per_write=3)
    return read_mart(spark, loc, TRENDS_COLUMNS)


@query("language_delete_insert")
def q_language_delete_insert(spark, sf_dir):
    """OP-K4: keyed merge of the language mart (late-data scenario)."""
    e = enriched(spark, sf_dir)
    return _two_runs(spark, marts.LANGUAGE, e.filter(F.col("event_hour") < 22), e,
                     LANGUAGE_COLUMNS)


@query("schema_sync")
def q_schema_sync(spark, sf_dir):
    """OP-K7: target missing a column and carrying an extra one is synced
    to the batch's columns on the incremental merge."""
    c = classified(spark, sf_dir)
    loc = scratch_path(spark, "trends-sync")
    old = (marts.contributor_trends(c.filter(F.col("event_hour") < 22), LATE_FIRST_AS_OF,
                                    batched_at=LATE_FIRST_AT)
           .drop("unique_contributors").withColumn("old", F.lit("x")))
    sinks.write_full(spark, loc, old, "event_date", operation="create")
    run_mart(spark, marts.TRENDS, c, loc, LATE_SECOND_AS_OF, batched_at=LATE_SECOND_AT)
    return read_mart(spark, loc, TRENDS_COLUMNS)


# -- serving: every tile reads the marts that the scheduled build stored ---------

def stored_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_mart(spark, scheduled_build(spark, sf_dir)[0], TRENDS_COLUMNS)


def stored_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_mart(spark, scheduled_build(spark, sf_dir)[1], LANGUAGE_COLUMNS)


@query("summary_metrics")
def q_summary_metrics(spark, sf_dir):
    """OP-A3/A4: totals, range and percent split over the trends mart."""
    return serving.summary_metrics(stored_trends(spark, sf_dir))


@query("total_repos")
def q_total_repos(spark, sf_dir):
    """OP-A5: sum of daily distinct repos, NULL -> 0."""
    return serving.total_repos(stored_language(spark, sf_dir))


@query("top_languages")
def q_top_languages(spark, sf_dir):
    """OP-L3: top 5 languages by push events."""
    return serving.top_languages(stored_language(spark, sf_dir))


@query("top_languages_by_repos")
def q_top_languages_by_repos(spark, sf_dir):
    """OP-L4: top 5 languages by summed distinct repos."""
    return serving.top_languages_by_repos(stored_language(spark, sf_dir))


@query("top_bot_repos")
def q_top_bot_repos(spark, sf_dir):
    """OP-L1/F7: top 100 repos by bot pushes."""
    return serving.top_bot_repos(classified(spark, sf_dir), 100)


def _language_day_metric(spark, sf_dir) -> DataFrame:
    return serving.metric_query(stored_language(spark, sf_dir), ["event_date", "language"],
                                ["total_events"], [serving.Sort("event_date", True)], 500)


@query("metric_query_language_day")
def q_metric_query_language_day(spark, sf_dir):
    """OP-A9/L5: total_events by day and language, date desc, limit 500."""
    return _language_day_metric(spark, sf_dir)


# A chart narrowed to two languages' human pushes.
CHOSEN = (serving.Filter("language", ("Go", "Python")),
          serving.Filter("contributor_type", ("bot",), exclude=True))


@query("metric_query_filtered")
def q_metric_query_filtered(spark, sf_dir):
    """OP-A9: the same metric narrowed by filters on dimensions."""
    return serving.metric_query(stored_language(spark, sf_dir), ["event_date", "language"],
                                ["total_events", "total_unique_repos"],
                                [serving.Sort("event_date", True)], filters=CHOSEN)


@query("language_day_pivot")
def q_language_day_pivot(spark, sf_dir):
    """OP-A10: one series per language over the metric query rows."""
    return serving.pivot_series(_language_day_metric(spark, sf_dir), "event_date", "language",
                                "total_events")


@query("contributor_trends_chart")
def q_contributor_trends_chart(spark, sf_dir):
    """OP-A11: SUM(event_count) per day, one series per contributor type."""
    return serving.contributor_trends_series(stored_trends(spark, sf_dir))


@query("contributor_trends_select")
def q_contributor_trends_select(spark, sf_dir):
    """OP-P11/L6: star projection of the mart, the newest 500 rows."""
    return serving.select_all_limited(stored_trends(spark, sf_dir),
                                      [F.desc("event_date"), "contributor_type"], 500)


@query("events_per_day")
def q_events_per_day(spark, sf_dir):
    """OP-A6/P6: rows per day over a half-open range of the lake table."""
    t = lake_load.read_days(spark, lake_table(spark, sf_dir), SERVE_START.date(),
                            SERVE_END.date())
    return lake.events_per_day(lake.time_range(t, SERVE_START, SERVE_END))


@query("top_event_types")
def q_top_event_types(spark, sf_dir):
    """OP-L2: top 10 event types over the range."""
    t = lake_load.read_days(spark, lake_table(spark, sf_dir), SERVE_START.date(),
                            SERVE_END.date())
    return lake.top_event_types(lake.time_range(t, SERVE_START, SERVE_END), 10)


@query("row_count")
def q_row_count(spark, sf_dir):
    """OP-A7: total rows of the lake table."""
    return lake.row_count(lake_load.read_events(spark, lake_table(spark, sf_dir)))


_CLUSTERED: dict[tuple[str, str], str] = {}


def clustered_table(spark: SparkSession, sf_dir: str) -> str:
    """A lake table of its own whose days are clustered by time."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CLUSTERED:
        loc = scratch_path(spark, "lake-clustered")
        start, end = data_days(spark, sf_dir)
        lake_load.write_events(spark, lake_events(spark, sf_dir), loc, start, end)
        lake_load.cluster_events(spark, loc, start, end)
        _CLUSTERED[key] = loc
    return _CLUSTERED[key]


# Three hours of one day, and a repository looked up by its name.
NARROW_START, NARROW_END = dt.datetime(2024, 1, 9, 14), dt.datetime(2024, 1, 9, 17)
LOOKED_UP = "org/repo42"


@query("clustered_time_lookup")
def q_clustered_time_lookup(spark, sf_dir):
    """OP-K1/S8: a narrow time range of a clustered day."""
    t = lake_load.read_days(spark, clustered_table(spark, sf_dir), NARROW_START.date(),
                            NARROW_END.date())
    return _ntz(lake.time_range(t, NARROW_START, NARROW_END)
                .select("id", F.col("repo.name").alias("repo_name"), "created_at"), "created_at")


@query("clustered_point_lookup")
def q_clustered_point_lookup(spark, sf_dir):
    """OP-K1/S8: all events of one repository, by Bloom filters."""
    t = lake_load.read_events(spark, clustered_table(spark, sf_dir))
    return t.where(F.col("repo.name") == LOOKED_UP).select("id", "type", "created_date")


@query("sql_functions")
def q_sql_functions(spark, sf_dir):
    """2.9: the scalar functions in SQL, over the model views."""
    from tidewater.plans.model_build import register_views

    register_views(spark, fixtures.landed_event_files(spark, sf_dir),
                   fixtures.landed_snapshot_files(spark, sf_dir))
    register_sql_functions(spark)
    return spark.sql("""
        SELECT event_date, file_before, COUNT(*) AS pushes, COUNT_IF(bot) AS bot_pushes,
               percent_of(COUNT_IF(bot), COUNT(*)) AS pct_bot
        FROM (SELECT event_date, is_bot(actor_type, actor_login) AS bot,
                     landing_key(previous_hour(created_at)) AS file_before
              FROM stg_events WHERE event_type = 'PushEvent')
        GROUP BY event_date, file_before""")


# -- loads and sinks -----------------------------------------------------------

@query("load_events_overwrite")
def q_load_events_overwrite(spark, sf_dir):
    """OP-K1/K2: load into a day-partitioned Parquet table; read back."""
    loc = scratch_path(spark, "lake-load")
    start, end = data_days(spark, sf_dir)
    lake_load.write_events(spark, lake_events(spark, sf_dir), loc, start, end)
    t = lake_load.read_events(spark, loc)
    return t.select("id", "type", F.col("actor.login").alias("actor_login"),
                    F.col("repo.name").alias("repo_name"), "payload", "public",
                    F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                    F.col("org.id").alias("org_id"), "created_date")


RELOAD_START, RELOAD_END = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def _rerun_scenario(spark, sf_dir) -> str:
    loc = scratch_path(spark, "lake-rerun")
    start, end = data_days(spark, sf_dir)
    lake_load.write_events(spark, lake_events(spark, sf_dir), loc, start, end)
    even = lake.normalize_events(
        fixtures.raw_lake_lines(spark, sf_dir, RELOAD_START, RELOAD_END)
        .filter(F.get_json_object("line", "$.id").cast("bigint") % 2 == 0))
    for _ in range(2):  # the second identical rerun must change nothing
        lake_load.write_events(spark, even, loc, RELOAD_START, RELOAD_END)
    return loc


@query("load_rerun_idempotent")
def q_load_rerun_idempotent(spark, sf_dir):
    """OP-K2/M4: rerun of two days replaces exactly those days; repeatable."""
    t = lake_load.read_events(spark, _rerun_scenario(spark, sf_dir))
    return t.groupBy("created_date").agg(F.count(F.lit(1)).alias("event_count"))


@query("load_reconciliation")
def q_load_reconciliation(spark, sf_dir):
    """OP-A8: per-day source counts (observed in the write) vs read-back."""
    loc = scratch_path(spark, "lake-recon")
    start, end = data_days(spark, sf_dir)
    summary = lake_load.write_events(spark, lake_events(spark, sf_dir), loc, start, end)
    return lake_load.reconciliation_from_summary(spark, summary, loc)


@query("load_history")
def q_load_history(spark, sf_dir):
    """OP-K6: write history of the rerun scenario, newest first."""
    h = sinks.load_history(spark, _rerun_scenario(spark, sf_dir))
    return h.select("committed_at", "snapshot_id", "operation",
                    F.to_json("summary").alias("summary"))


@query("load_history_counts")
def q_load_history_counts(spark, sf_dir):
    """OP-K6: the same write history reduced to its deterministic fields
    (counts per commit and the number of days each commit wrote)."""
    h = sinks.load_history(spark, _rerun_scenario(spark, sf_dir))
    summary = F.col("summary")
    per_day = F.from_json(summary["per-day"], "map<string,bigint>")
    return h.select(
        "operation",
        summary["source-records"].cast("bigint").alias("source_records"),
        summary["added-records"].cast("bigint").alias("added_records"),
        summary["straggler-records"].cast("bigint").alias("straggler_records"),
        summary["undated-records"].cast("bigint").alias("undated_records"),
        F.size(F.map_filter(per_day, lambda _, n: n > 0)).cast("bigint").alias("days_written"))


@query("load_job_from_files")
def q_load_job_from_files(spark, sf_dir):
    """OP-S5/K1/K2/A8: the whole load job over landed gzip JSON files: guard,
    read, normalise, write into a named table, count round trip."""
    loc = scratch_path(spark, "lake-job")
    start, end = data_days(spark, sf_dir)
    return lake_load.run_load(spark, fixtures.landed_lake_files(spark, sf_dir), loc, start, end)


@query("named_table_read")
def q_named_table_read(spark, sf_dir):
    """OP-K1: the table is created under a name if absent and read by SQL."""
    loc = scratch_path(spark, "lake-named")
    name = "tw_" + loc.rsplit("-", 1)[1]
    start, end = data_days(spark, sf_dir)
    for _ in range(2):  # the second load finds the table and replaces its days
        lake_load.load_events(spark, fixtures.landed_lake_files(spark, sf_dir), loc, start, end,
                              table_name=name)
    return spark.sql(f"SELECT type, COUNT(*) AS event_count FROM {name} "
                     "WHERE created_date >= DATE '2024-01-05' GROUP BY type")


@query("load_stragglers")
def q_load_stragglers(spark, sf_dir):
    """OP-K2/M4: rows that landed a day late are stored under their true day,
    broken lines without one; rerunning one landing day changes nothing."""
    loc = scratch_path(spark, "lake-late")
    events = lake.normalize_events(fixtures.lines_with_stragglers(spark, sf_dir),
                                   keep=("event_date",))
    start, end = data_days(spark, sf_dir)
    for first, last in ((start, end + dt.timedelta(days=1)), (RELOAD_START, RELOAD_START)):
        lake_load.write_events(spark, events, loc, first, last, landing_column="event_date")
    return (lake_load.read_events(spark, loc).groupBy("created_date", "landed_date")
            .agg(F.count(F.lit(1)).alias("event_count")))


@query("load_repaired_rerun")
def q_load_repaired_rerun(spark, sf_dir):
    """OP-K2/M4: files with stragglers and broken lines are loaded, landed
    again whole and loaded again: what the repaired files no longer hold is
    gone, the rows without a day included, and the counts agree."""
    base = scratch_path(spark, "lake-repaired")
    start, end = data_days(spark, sf_dir)
    last = end
    for name, lines in (("broken", fixtures.lines_with_stragglers(spark, sf_dir)),
                        ("whole", fixtures.raw_lake_lines(spark, sf_dir))):
        files.write_landing_text(lines, f"{base}/{name}")
        landed_to = lines.agg(F.max("event_date")).first()[0]
        lake_load.run_load(spark, f"{base}/{name}", f"{base}/events", start, landed_to)
        last = max(last, landed_to)
    if last > end:  # a day that has no file any more is a load of its own, of nothing
        lake_load.write_events(spark, lake_events(spark, sf_dir).limit(0), f"{base}/events",
                               last, last)
    return (lake_load.read_events(spark, f"{base}/events").groupBy("created_date", "landed_date")
            .agg(F.count(F.lit(1)).alias("event_count")))


SNAPSHOT_RERUN_DAY = dt.date(2024, 1, 28)


@query("repo_snapshot_write")
def q_repo_snapshot_write(spark, sf_dir):
    """OP-K5: NDJSON snapshot per run date; a rerun replaces its date only."""
    root = scratch_path(spark, "repo-snapshots")
    records = staging.repo_record_projection(fixtures.api_repo_records(spark, sf_dir))
    days = [r[0] for r in records.select("enriched_date").distinct().collect()]
    for day in sorted(days):
        sinks.write_repo_snapshot(records, root, day)
    sinks.write_repo_snapshot(records.filter(F.col("stargazers_count") >= 2500), root,
                              SNAPSHOT_RERUN_DAY)
    if min(days) != SNAPSHOT_RERUN_DAY:  # a rerun without records empties its day
        sinks.write_repo_snapshot(records.limit(0), root, min(days))
    return staging.stg_repo_metadata_typed(files.read_repo_snapshots(spark, root))


# -- streaming -------------------------------------------------------------------

@query("stream_file_ingest")
def q_stream_file_ingest(spark, sf_dir):
    """OP-S7/M1: landed files picked up once by a restartable file stream."""
    base = scratch_path(spark, "stream")
    landing = fixtures.landed_event_files(spark, sf_dir)
    staged, ckpt = f"{base}/staged", f"{base}/checkpoint"
    file_ingest.ingest_available(spark, landing, staged, ckpt)
    file_ingest.ingest_available(spark, landing, staged, ckpt)  # nothing new: adds nothing
    return file_ingest.read_staged(spark, staged)


@query("stream_notified_files")
def q_stream_notified_files(spark, sf_dir):
    """OP-S7/M1: files named by notifications, each staged once though some are
    named again and some out of order."""
    base = scratch_path(spark, "notified")
    root = fixtures.landed_event_files(spark, sf_dir)
    for drop in fixtures.notification_drops(spark, root):
        drop.repartition(4).write.mode("append").text(f"{base}/queue")
        notified.ingest_notified(spark, f"{base}/queue", root, f"{base}/staged",
                                 f"{base}/checkpoint")
    return file_ingest.read_staged(spark, f"{base}/staged")


@query("stream_trends_refresh")
def q_stream_trends_refresh(spark, sf_dir):
    """OP-M1/M2: each micro-batch of landed files refreshes the days it
    touched in the contributor-trends mart (several batches, exact)."""
    base = scratch_path(spark, "stream-trends")
    landing = fixtures.landed_event_files(spark, sf_dir)
    trends = f"{base}/trends"
    file_ingest.ingest_and_refresh_trends(spark, landing, f"{base}/staged", f"{base}/checkpoint",
                                          trends, AS_OF, batched_at=BATCHED_AT,
                                          max_files_per_trigger=250)
    return read_mart(spark, trends, TRENDS_COLUMNS)


@query("stream_as_of_advance")
def q_stream_as_of_advance(spark, sf_dir):
    """OP-M1: all files come while 01-15 is the incomplete day; a later run
    without new files adds the days that have become complete."""
    base = scratch_path(spark, "stream-advance")
    landing = fixtures.landed_event_files(spark, sf_dir)
    for as_of in (dt.date(2024, 1, 15), AS_OF):
        file_ingest.ingest_and_refresh_trends(spark, landing, f"{base}/staged",
                                              f"{base}/checkpoint", f"{base}/trends", as_of,
                                              batched_at=BATCHED_AT)
    return read_mart(spark, f"{base}/trends", TRENDS_COLUMNS)


@query("model_views")
def q_model_views(spark, sf_dir):
    """OP-K8: the models as named views, queried by SQL."""
    from tidewater.plans.model_build import register_views

    register_views(spark, fixtures.landed_event_files(spark, sf_dir),
                   fixtures.landed_snapshot_files(spark, sf_dir))
    return spark.sql("SELECT contributor_type, language, COUNT(*) AS event_count "
                     "FROM events_enriched GROUP BY contributor_type, language")


@query("catalog_models")
def q_catalog_models(spark, sf_dir):
    """OP-K8/S2: external tables over the landed files and views on them in
    the catalog; a range of days is pruned there."""
    from tidewater.plans import catalog

    place = scratch_path(spark, "catalog")
    database = "tw_" + place.rsplit("-", 1)[1]
    events = fixtures.landed_event_files(spark, sf_dir)
    snapshots = fixtures.landed_snapshot_files(spark, sf_dir)
    catalog.create_models(spark, database, place, events, snapshots)
    catalog.refresh_events(spark, database, events)
    catalog.refresh_snapshots(spark, database, snapshots)
    return spark.sql(
        f"SELECT event_date, contributor_type, language, COUNT(*) AS event_count "
        f"FROM {database}.events_enriched WHERE event_date BETWEEN DATE '{RANGE_START}' "
        f"AND DATE '{RANGE_END}' GROUP BY event_date, contributor_type, language")


# -- scheduled build from landed files ------------------------------------------

_BUILDS: dict[tuple[str, str], tuple[str, str]] = {}


def scheduled_build(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Both marts built by one scheduled run over the landed hourly files and
    snapshot files (once per application; both keys read the result)."""
    from tidewater.plans.model_build import build_marts

    key = (spark.sparkContext.applicationId, sf_dir)
    locs = _BUILDS.get(key)
    if locs is None or not all(sinks.table_exists(spark, loc) for loc in locs):
        locs = (scratch_path(spark, "build-trends"), scratch_path(spark, "build-language"))
        start, _ = data_days(spark, sf_dir)
        build_marts(spark, fixtures.landed_event_files(spark, sf_dir),
                    fixtures.landed_snapshot_files(spark, sf_dir), locs[0], locs[1], AS_OF,
                    start, batched_at=BATCHED_AT)
        _BUILDS[key] = locs
    return locs


@query("scheduled_build_trends")
def q_scheduled_build_trends(spark, sf_dir):
    """Contributor trends as built by the scheduled run from landed files
    (JSON parsed once by the scan, classified events staged once)."""
    return read_mart(spark, scheduled_build(spark, sf_dir)[0], TRENDS_COLUMNS)


@query("scheduled_build_language")
def q_scheduled_build_language(spark, sf_dir):
    """Language activity as built by the same scheduled run."""
    return read_mart(spark, scheduled_build(spark, sf_dir)[1], LANGUAGE_COLUMNS)


def shared_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Build what several queries read and an application builds once."""
    ensure_conventions(spark)
    fixtures.raw_events(spark, sf_dir)
    fixtures.raw_lake_lines(spark, sf_dir)
    for landed in (fixtures.landed_event_files, fixtures.landed_files_with_broken_lines,
                   fixtures.landed_mixed_files, fixtures.landed_snapshot_files,
                   fixtures.landed_lake_files, lake_table, clustered_table, scheduled_build):
        landed(spark, sf_dir)


# -- data quality ------------------------------------------------------------------

@query("dq_stg_events")
def q_dq_stg_events(spark, sf_dir):
    """OP-D1."""
    return quality.dq_check(stg(spark, sf_dir), "stg_events")


@query("dq_repo_metadata")
def q_dq_repo_metadata(spark, sf_dir):
    """OP-D2."""
    return quality.dq_check(latest_meta(spark, sf_dir), "stg_repo_metadata")


@query("dq_classified")
def q_dq_classified(spark, sf_dir):
    """OP-D3."""
    return quality.dq_check(classified(spark, sf_dir), "events_classified")


@query("dq_enriched")
def q_dq_enriched(spark, sf_dir):
    """OP-D4."""
    return quality.dq_check(enriched(spark, sf_dir), "events_enriched")


@query("dq_trends")
def q_dq_trends(spark, sf_dir):
    """OP-D5."""
    return quality.dq_check(stored_trends(spark, sf_dir), "contributor_trends")


@query("dq_language")
def q_dq_language(spark, sf_dir):
    """OP-D6."""
    return quality.dq_check(stored_language(spark, sf_dir), "language_activity")


@query("dq_broken_events")
def q_dq_broken_events(spark, sf_dir):
    """OP-D3 over rows that break its rules: every kind of row rule fires."""
    return quality.dq_check(broken_events(spark, sf_dir), "events_classified")


def broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified events some of which break the declared rules."""
    n = F.col("event_id").cast("bigint")
    return (classified(spark, sf_dir)
            .withColumn("event_type", F.when(n % 11 == 0, F.lit(None)).when(n % 7 == 0, "Forged")
                        .otherwise(F.col("event_type")))
            .withColumn("contributor_type", F.when(n % 13 == 0, "alien")
                        .otherwise(F.col("contributor_type"))))


@query("dq_violations_events")
def q_dq_violations_events(spark, sf_dir):
    """OP-D3: the rows that break a rule, once per broken rule."""
    return quality.dq_violations(broken_events(spark, sf_dir), "events_classified")


@query("dq_violations_repos")
def q_dq_violations_repos(spark, sf_dir):
    """OP-D2 over all snapshots: every row of a repeated repository."""
    return quality.dq_violations(
        staging.stg_repo_metadata_typed(fixtures.raw_repo_snapshots(spark, sf_dir)),
        "stg_repo_metadata")


@query("mart_refused_publish")
def q_mart_refused_publish(spark, sf_dir):
    """OP-D5/K2: a batch that breaks declared rules is refused by the write
    itself; the mart stays as the run before left it."""
    loc = scratch_path(spark, "checked")
    c = classified(spark, sf_dir)
    alien = F.when(F.col("event_id").cast("bigint") % 13 == 0, "alien").otherwise(
        F.col("contributor_type"))
    broken = c.withColumn("contributor_type", alien)
    run_mart(spark, marts.TRENDS, c, loc, dt.date(2024, 1, 20), batched_at=BATCHED_AT,
             checks=quality.RULES["contributor_trends"])
    for full_refresh in (False, True):
        try:
            run_mart(spark, marts.TRENDS, broken, loc, AS_OF, batched_at=BATCHED_AT,
                     full_refresh=full_refresh, checks=quality.RULES["contributor_trends"])
        except sinks.ChecksFailed:
            continue
        raise AssertionError("a broken batch was published")
    return read_mart(spark, loc, TRENDS_COLUMNS)


@query("schema_sync_nested")
def q_schema_sync_nested(spark, sf_dir):
    """OP-K7: struct fields, array elements and decimals of a table follow
    those of an incremental batch."""
    loc = scratch_path(spark, "nested-sync")
    day = F.col("ts").cast("date")
    ev = fixtures.driver_events(spark, sf_dir)
    old = ev.select(
        "event_id", day.alias("event_date"), F.col("value").cast("decimal(9,2)").alias("amount"),
        F.struct(F.col("user_id").cast("int").alias("Id"), F.lit("x").alias("old")).alias("actor"),
        F.array(F.struct(F.col("event_type").alias("tag"))).alias("tags"))
    new = ev.where(day == F.lit(LATE_DAY)).select(
        "event_id", day.alias("event_date"), F.col("value").cast("decimal(12,4)").alias("amount"),
        F.struct("user_id", F.col("user_id").alias("id"), F.col("event_type").alias("kind"))
        .alias("actor"),
        F.array(F.struct(F.col("event_type").alias("tag"), F.lit(1).alias("weight"))).alias("tags"))
    sinks.write_full(spark, loc, old, "event_date", operation="create")
    sinks.delete_insert(spark, loc, new, ["event_id"], "event_date")
    t = sinks.read_table(spark, loc)
    return t.select("event_id", "event_date", F.col("amount").cast("double").alias("amount"),
                    F.col("actor.user_id").alias("user_id"), F.col("actor.id").alias("actor_id"),
                    F.col("actor.kind").alias("kind"), F.col("tags")[0]["tag"].alias("tag"),
                    F.col("tags")[0]["weight"].alias("weight"),
                    F.lit(",".join(t.schema["actor"].dataType.names)).alias("actor_fields"))


@query("dq_repeated_repos")
def q_dq_repeated_repos(spark, sf_dir):
    """OP-D2 over all snapshots: repositories repeat, so the unique rule fires."""
    return quality.dq_check(
        staging.stg_repo_metadata_typed(fixtures.raw_repo_snapshots(spark, sf_dir)),
        "stg_repo_metadata")
