"""Physical-plan properties that matter at scale."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F
from tidewater import registry
from tidewater.sources import fixtures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_range_reaches_parquet_scan(spark):
    # The landed raw events are day-partitioned: a range prunes folders.
    p = plan(fixtures.raw_events(spark, SF_SMALL, dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "(event_date" in p and "2024-01-05" in p and "2024-01-06" in p
    # Building them from the driver table pushes the same range into its scan.
    p = plan(fixtures.build_raw_events(spark, SF_SMALL, dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(registry.QUERIES["contributor_trends"](spark, SF_SMALL))
    assert "ReadSchema: struct<raw_event:string>" in p  # no event_hour: unused
    p = plan(fixtures.build_raw_events(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p


def test_metadata_side_broadcast(spark):
    p = plan(registry.QUERIES["events_enriched"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_language_filter_turns_join_inner(spark):
    p = plan(registry.QUERIES["language_activity"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftOuter" not in p


def test_topk_is_bounded(spark):
    p = plan(registry.QUERIES["top_bot_repos"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_lake_range_prunes_partitions(spark):
    q = registry.QUERIES["time_range_scan"](spark, SF_SMALL)
    p = plan(q)
    assert "PartitionFilters: [isnotnull(created_date" in p


def test_file_based_staging_parses_once_and_prunes(spark, scratch):
    from tidewater import schemas
    from tidewater.operators import intermediate, marts
    from tidewater.sources import files

    landing = scratch("landing")
    files.write_landing_files(fixtures.raw_events(spark, SF_SMALL), landing, "raw_event",
                              schemas.STG_EVENT_JSON)
    stg = files.read_staged_events(spark, landing, dt.date(2024, 1, 27), dt.date(2024, 1, 29))
    t = marts.contributor_trends(intermediate.events_classified(stg), dt.date(2024, 1, 30),
                                 incremental=True)
    p = plan(t)
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,PushEvent)]" in p
    assert "ReadSchema: struct<type:string,actor:struct<login:string,type:string>>" in p
    assert "(event_date" in p and "PartitionFilters" in p
    assert "from_json" not in p  # parsed once, by the scan


def test_load_write_is_rebalanced_by_day(spark, scratch):
    import glob

    from tidewater.operators import lake
    from tidewater.plans import lake_load

    loc = scratch("lake")
    ev = lake.normalize_events(fixtures.raw_lake_lines(spark, SF_SMALL))
    lake_load.write_events(spark, ev, loc, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    per_day = [len(glob.glob(d + "/landed_date=*/*.parquet"))
               for d in glob.glob(loc.replace("file:", "") + "/created_date=*")]
    assert per_day and max(per_day) == 1  # small days: one file each


def test_building_the_enrichment_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    c, m = registry.classified(spark, SF_SMALL), registry.latest_meta(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("building", "")
    try:
        from tidewater.operators import intermediate

        intermediate.events_enriched(c, m)
        assert tracker.getJobIdsForGroup("building") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_events_are_never_the_broadcast_side(spark, scratch):
    from tidewater.operators import intermediate, marts
    from tidewater.plans.model_build import stage_classified, stage_metadata

    # Events pack into smaller files than the metadata's own texts do.
    events = stage_classified(spark, spark.range(20_000).select(
        F.lit(dt.date(2024, 1, 9)).alias("event_date"), F.lit(3).alias("event_hour"),
        F.col("id").cast("string").alias("event_id"), F.lit("PushEvent").alias("event_type"),
        F.lit("u").alias("actor_login"), F.lit("User").alias("actor_type"),
        F.lit("o/r1").alias("repo_name"), F.lit(dt.datetime(2024, 1, 9, 3)).alias("created_at"),
        F.lit(False).alias("is_bot"), F.lit("human").alias("contributor_type")), scratch("events"))
    meta = registry.latest_meta(spark, SF_SMALL).limit(0).unionByName(spark.range(200).select(
        F.concat(F.lit("o/r"), "id").alias("repo_full_name"), F.lit("Go").alias("language"),
        *[F.lit(None).cast(t).alias(c) for c, t in registry.latest_meta(spark, SF_SMALL).dtypes
          if c not in ("repo_full_name", "language")]).select(
              registry.latest_meta(spark, SF_SMALL).columns))
    for most, joined in ((1 << 20, "BroadcastHashJoin"), (100, "SortMergeJoin")):
        m = stage_metadata(spark, meta, scratch("meta"), most)
        mart = marts.language_activity(intermediate.events_enriched(events, m), registry.AS_OF)
        assert [(r["language"], r["event_count"]) for r in mart.collect()] == [("Go", 20_000)]
        p = plan(mart)
        assert joined in p and "BuildLeft" not in p
    p = plan(registry.QUERIES["language_activity"](spark, SF_SMALL))
    assert "BuildRight" in p and "BuildLeft" not in p


def test_serving_reads_stored_marts(spark):
    for key in ("summary_metrics", "top_languages", "metric_query_language_day", "dq_trends",
                "contributor_trends_select"):
        p = plan(registry.QUERIES[key](spark, SF_SMALL))
        assert "Format: Parquet" in p and "from_json" not in p and "raw_event" not in p, key


def test_listing_parallelism_filled_only_when_unset(spark):
    from tidewater.session import LISTING_PARALLELISM, ensure_listing_parallelism

    before = spark.conf.get(LISTING_PARALLELISM)
    try:
        spark.conf.set(LISTING_PARALLELISM, "10000")  # Spark's default: replaced
        ensure_listing_parallelism(spark)
        assert int(spark.conf.get(LISTING_PARALLELISM)) == max(
            8, spark.sparkContext.defaultParallelism)
        spark.conf.set(LISTING_PARALLELISM, "123")  # a deployment's own value stays
        ensure_listing_parallelism(spark)
        assert spark.conf.get(LISTING_PARALLELISM) == "123"
    finally:
        spark.conf.set(LISTING_PARALLELISM, before)


def test_scheduled_build_parses_json_once(spark, scratch):
    """Both marts of a scheduled run read the staged classified events: a
    Parquet scan with no JSON parsing, holding exactly the classified rows."""
    from tidewater.plans.model_build import stage_classified

    c = registry.classified(spark, SF_SMALL)
    assert "from_json" in plan(c)
    staged = stage_classified(spark, c, scratch("classified"))
    p = plan(staged)
    assert "Format: Parquet" in p and "from_json" not in p
    assert staged.columns == c.columns
    assert staged.exceptAll(c).count() == 0 and c.exceptAll(staged).count() == 0
