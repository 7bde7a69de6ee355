"""Mart scenarios (FIXTURES.md section 4/5) on the driver tables."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_MID
from tidewater import registry
from tidewater.operators import marts
from tidewater.plans import sinks
from tidewater.plans.marts import read_mart, run_mart

D = dt.date


def test_contributor_trends_values(spark):
    t = registry.QUERIES["contributor_trends"](spark, SF_MID)
    rows = {(r["event_date"], r["contributor_type"]): (r["event_count"], r["unique_contributors"])
            for r in t.collect()}
    assert len(rows) == 58
    assert rows[(D(2024, 1, 1), "bot")] == (41, 34)
    assert rows[(D(2024, 1, 1), "human")] == (37, 26)
    assert max(d for d, _ in rows) == D(2024, 1, 29)


def test_late_data_and_vanished_key(spark, scratch):
    c = registry.classified(spark, SF_MID)
    loc = scratch("trends")
    s1 = run_mart(spark, marts.TRENDS, c.filter(F.col("event_hour") < 22), loc, D(2024, 1, 27))
    assert s1["incremental"] is False and s1["added-records"] == 52
    second = c.filter(~((F.col("event_date") == F.lit(D(2024, 1, 26)))
                        & (F.col("contributor_type") == "bot")))
    s2 = run_mart(spark, marts.TRENDS, second, loc, D(2024, 1, 28))
    assert s2["incremental"] is True and s2["batch-records"] == 5
    out = {(r["event_date"], r["contributor_type"]): (r["event_count"], r["unique_contributors"])
           for r in read_mart(spark, loc, registry.TRENDS_COLUMNS).collect()}
    assert len(out) == 54
    assert out[(D(2024, 1, 26), "bot")] == (24, 20)  # vanished key kept from run 1
    full = {(r["event_date"], r["contributor_type"]): r["event_count"]
            for r in marts.contributor_trends(c, D(2024, 1, 28)).collect()}
    for k, v in out.items():
        if D(2024, 1, 25) <= k[0] <= D(2024, 1, 27) and k != (D(2024, 1, 26), "bot"):
            assert v[0] == full[k]  # repaired
    differing = {k[0] for k, v in out.items() if k[0] <= D(2024, 1, 24) and v[0] != full[k]}
    assert len(differing) == 24  # outside the lookback the truncated counts remain


def test_schema_sync_adds_and_drops(spark):
    out = registry.QUERIES["schema_sync"](spark, SF_MID)
    assert out.columns == registry.TRENDS_COLUMNS
    nulls = out.filter(F.col("unique_contributors").isNull()).select("event_date").distinct()
    assert {r[0] for r in nulls.collect()} == {D(2024, 1, 1) + dt.timedelta(days=i)
                                               for i in range(24)}


def test_history_records_each_commit(spark, scratch):
    c = registry.classified(spark, SF_MID)
    loc = scratch("trends")
    run_mart(spark, marts.TRENDS, c, loc, D(2024, 1, 20))
    run_mart(spark, marts.TRENDS, c, loc, D(2024, 1, 21))
    ops = [r["operation"] for r in sinks.load_history(spark, loc).collect()]
    assert ops == ["delete+insert", "create"]


def test_build_marts_from_landed_files(spark, scratch):
    from tidewater.plans.model_build import build_marts
    from tidewater.sources import files, fixtures
    from tidewater import schemas

    landing, snaps = scratch("landing"), scratch("snapshots")
    files.write_landing_files(fixtures.raw_events(spark, SF_MID), landing, "raw_event",
                              schemas.STG_EVENT_JSON)
    (fixtures.raw_repo_snapshots(spark, SF_MID).repartition("enriched_date")
        .write.partitionBy("enriched_date").text(snaps))
    tl, ll = scratch("trends"), scratch("language")
    build_marts(spark, landing, snaps, tl, ll, D(2024, 1, 30), D(2024, 1, 1),
                batched_at=registry.BATCHED_AT)
    got_t = read_mart(spark, tl, registry.TRENDS_COLUMNS)
    want_t = registry.QUERIES["contributor_trends"](spark, SF_MID)
    assert sorted(got_t.collect()) == sorted(want_t.collect())
    got_l = read_mart(spark, ll, registry.LANGUAGE_COLUMNS)
    want_l = registry.QUERIES["language_activity"](spark, SF_MID)
    assert sorted(got_l.collect()) == sorted(want_l.collect())
    from tidewater.plans.model_build import register_views
    register_views(spark, landing, snaps, tl, ll)
    n = spark.sql("SELECT count(*) FROM mart_contributor_trends WHERE contributor_type = 'bot'")
    assert n.first()[0] == 29
    assert spark.sql("SELECT count(*) FROM events_enriched").first()[0] == 2006
    s = build_marts(spark, landing, snaps, tl, ll, D(2024, 1, 30), D(2024, 1, 1),
                    batched_at=registry.BATCHED_AT)
    assert s["contributor_trends"]["incremental"] is True
    assert sorted(read_mart(spark, tl, registry.TRENDS_COLUMNS).collect()) == sorted(want_t.collect())


def test_stream_refresh_is_exact_across_batches(spark, scratch):
    from conftest import SF_SMALL
    from tidewater import schemas
    from tidewater.sources import files, fixtures
    from tidewater.streaming import file_ingest

    base = scratch("stream")
    files.write_landing_files(fixtures.raw_events(spark, SF_SMALL), f"{base}/landing",
                              "raw_event", schemas.STG_EVENT_JSON)
    n = file_ingest.ingest_and_refresh_trends(
        spark, f"{base}/landing", f"{base}/staged", f"{base}/ck", f"{base}/trends",
        registry.AS_OF, batched_at=registry.BATCHED_AT, max_files_per_trigger=100)
    assert n > 1
    got = read_mart(spark, f"{base}/trends", registry.TRENDS_COLUMNS).collect()
    want = registry.QUERIES["contributor_trends"](spark, SF_SMALL).collect()
    assert sorted(got) == sorted(want)
    again = file_ingest.ingest_and_refresh_trends(
        spark, f"{base}/landing", f"{base}/staged", f"{base}/ck", f"{base}/trends",
        registry.AS_OF, batched_at=registry.BATCHED_AT)
    assert again == 0  # nothing new landed


def test_staged_batch_replay_replaces_only_its_output(spark, scratch):
    """A micro-batch written again (replay after a failure) replaces exactly
    its own (day, batch) folders; other batches and days stay; a day-scoped
    read lists only the requested day folders."""
    from conftest import SF_SMALL
    from tidewater.operators import staging
    from tidewater.sources import fixtures
    from tidewater.streaming import file_ingest

    stg = staging.stg_events(fixtures.raw_events(spark, SF_SMALL))
    first = stg.filter(F.col("event_date") <= F.lit(dt.date(2024, 1, 10)))
    second = stg.filter(F.col("event_date") > F.lit(dt.date(2024, 1, 10)))
    loc = scratch("staged")
    file_ingest.write_staged_batch(first, loc, 0)
    file_ingest.write_staged_batch(second, loc, 1)
    file_ingest.write_staged_batch(second, loc, 1)  # replay of batch 1
    got = file_ingest.read_staged(spark, loc)
    assert got.count() == stg.count()
    assert got.exceptAll(stg).count() == 0 and stg.exceptAll(got).count() == 0

    days = [dt.date(2024, 1, 3), dt.date(2024, 1, 12)]
    some = file_ingest.read_staged(spark, loc, days)
    listed = {p.split("event_date=")[1][:10] for p in some.inputFiles()}
    assert listed == {d.isoformat() for d in days}
    assert some.count() == stg.filter(F.col("event_date").isin(days)).count()


def test_stream_refresh_repairs_a_late_file_after_as_of_went_back(spark, scratch):
    """A late file of 01-12 staged by a run as of 01-10 reaches the mart, which
    already holds 01-12, in the next run as of 01-17."""
    from test_loads import _land_lines
    from tidewater.streaming import file_ingest

    base = scratch("stream-back")
    line = '{"id":"%d","type":"PushEvent","actor":{"login":"u%d"},"created_at":"%sT03:00:00Z"}'

    def land(day, hour, ids):
        date = D(2024, 1, day).isoformat()
        _land_lines(f"{base}/landing", date, hour, [line % (k, k, date) for k in ids])

    def run(as_of):
        file_ingest.ingest_and_refresh_trends(
            spark, f"{base}/landing", f"{base}/staged", f"{base}/ck", f"{base}/trends",
            as_of, batched_at=registry.BATCHED_AT)
        return {r["event_date"].day: r["event_count"] for r in
                read_mart(spark, f"{base}/trends", registry.TRENDS_COLUMNS).collect()}

    land(9, 3, [1])
    land(12, 3, [2, 3])
    assert run(D(2024, 1, 16)) == {9: 1, 12: 2}
    land(12, 4, [4])
    assert run(D(2024, 1, 10)) == {9: 1, 12: 2}  # 01-12 is not complete as of 01-10
    assert run(D(2024, 1, 17)) == {9: 1, 12: 3}
    before = sinks.load_history(spark, f"{base}/trends").count()
    assert run(D(2024, 1, 17)) == {9: 1, 12: 3}
    assert sinks.load_history(spark, f"{base}/trends").count() == before  # nothing is behind
