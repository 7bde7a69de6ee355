"""Lake load job over real landed gzip JSON files and the day overwrite."""

import datetime as dt
import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.days import DaySpan
from tidewater.operators import lake
from tidewater.plans import lake_load, sinks
from tidewater.sources import files, fixtures

D = dt.date


@pytest.fixture(scope="module")
def landed(spark):
    from tidewater.session import scratch_path

    root = scratch_path(spark, "landing")
    files.write_landing_files(fixtures.raw_lake_lines(spark, SF_SMALL), root)
    return root


def _day_counts(spark, loc):
    return {r[0]: r[1] for r in spark.read.parquet(loc).groupBy("created_date").count().collect()}


def test_landing_layout(landed):
    hours = glob.glob(os.path.join(landed.replace("file:", ""), "event_date=*", "event_hour=*"))
    assert hours and all(os.path.basename(h).split("=")[1].isdigit() for h in hours)
    assert any(h.endswith("event_hour=5") for h in hours)  # unpadded hour
    assert glob.glob(os.path.join(landed, "event_date=*", "event_hour=*", "*.json.gz"))


def test_day_spans():
    span = DaySpan(D(2024, 1, 30), D(2024, 2, 1))
    assert list(span) == [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1)] and len(span) == 3
    assert [len(c) for c in DaySpan(D(2024, 1, 1), D(2024, 3, 10)).chunks(31)] == [31, 31, 8]
    assert span.absentees({"2024-01-31"}) == ["2024-01-30", "2024-02-01"]
    assert span.folders("/r/", "d") == "/r/d={2024-01-30,2024-01-31,2024-02-01}"
    with pytest.raises(ValueError):
        DaySpan(D(2024, 1, 2), D(2024, 1, 1))


def test_missing_date_refuses_load(spark, landed, scratch):
    landed_days = files.landed_dates(spark, landed)
    missing = [r[0] for r in files.missing_dates(spark, landed_days, D(2024, 1, 29),
                                                 D(2024, 1, 31)).collect()]
    assert missing == [D(2024, 1, 31)]
    with pytest.raises(FileNotFoundError):
        lake_load.load_events(spark, landed, scratch("lake"), D(2024, 1, 29), D(2024, 1, 31))


def test_load_reconciles_and_reruns_idempotently(spark, landed, scratch):
    loc = scratch("lake")
    s1 = lake_load.load_events(spark, landed, loc, D(2024, 1, 1), D(2024, 1, 30))
    total = fixtures.driver_events(spark, SF_SMALL).count()
    assert s1["added-records"] == total and s1["straggler-records"] == s1["undated-records"] == 0
    assert s1["corrupt-records"] == 0
    rec = lake_load.reconciliation_from_summary(spark, s1, loc)
    assert rec.filter(F.col("delta") != 0).count() == 0
    before = _day_counts(spark, loc)
    lake_load.load_events(spark, landed, loc, D(2024, 1, 5), D(2024, 1, 6))
    assert _day_counts(spark, loc) == before
    hist = sinks.load_history(spark, loc).collect()
    assert len(hist) == 2 and hist[0]["operation"] == "overwrite"
    assert hist[0]["committed_at"] >= hist[1]["committed_at"]


def test_nested_structs_resolved_by_name(spark, landed, scratch):
    loc = scratch("lake")
    lake_load.load_events(spark, landed, loc, D(2024, 1, 3), D(2024, 1, 3))
    t = spark.read.parquet(loc)
    r = t.select("actor.*", "payload", "org").first()
    assert r["login"].startswith("user") and r["display_login"].startswith("D")
    assert r["id"] == int(r["login"][4:])
    assert r["payload"].startswith('{"k":')
    assert "zzz_extra" not in t.schema["actor"].dataType.fieldNames()


def test_stragglers_are_stored_beside_their_day(spark, scratch):
    loc = scratch("lake")
    ev = lake.normalize_events(fixtures.raw_lake_lines(spark, SF_SMALL))
    lake_load.write_events(spark, ev, loc, D(2024, 1, 1), D(2024, 1, 30))
    before = _day_counts(spark, loc)
    day5 = ev.filter(F.to_date("created_at") == F.lit(D(2024, 1, 5)))
    late = ev.filter(F.to_date("created_at") == F.lit(D(2024, 1, 4))).limit(1)
    for _ in range(2):  # a rerun of the landing day replaces the straggler's folder only
        s = lake_load.write_events(spark, day5.unionByName(late), loc, D(2024, 1, 5),
                                   D(2024, 1, 5))
        assert s["straggler-records"] == 1
        assert _day_counts(spark, loc) == before | {D(2024, 1, 4): before[D(2024, 1, 4)] + 1}


def _land_lines(root, day, hour, lines):
    folder = f"{root.replace('file:', '')}/event_date={day}/event_hour={hour}"
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{day}-{hour}.json.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_broken_lines_are_kept_and_counted(spark, scratch):
    """An unreadable line becomes a row without a day whose payload is its
    text; a line with one wrong field keeps its day."""
    root, loc = scratch("landing-bad"), scratch("lake")
    good = '{"id":"%d","type":"PushEvent","created_at":"2024-01-%02dT03:00:00Z","payload":{"k":1}}'
    _land_lines(root, "2024-01-02", 3, [
        good % (1, 2), "{broken", good % (2, 1), good.replace('"payload"', '"public":7,"payload"')
        % (3, 2), '{"id":"4"}'])
    s = lake_load.load_events(spark, root, loc, D(2024, 1, 2), D(2024, 1, 2))
    rows = {r["id"]: r for r in lake_load.read_events(spark, loc).collect()}
    assert s["source-records"] == s["added-records"] == len(rows) == 5
    assert s["straggler-records"] == 1 and s["undated-records"] == 2
    assert rows[None]["payload"] == "{broken" and rows[None]["created_date"] is None
    assert rows["2"]["created_date"] == D(2024, 1, 1)
    assert rows["2"]["landed_date"] == rows["1"]["landed_date"] == D(2024, 1, 2)
    assert s["corrupt-records"] >= 1
    report = lake_load.run_load(spark, root, loc, D(2024, 1, 2), D(2024, 1, 2)).collect()
    assert [(r["source_count"], r["delta"]) for r in report] == [(5, 0)]


def test_read_raw_events_partitions(spark, landed):
    raw = files.read_raw_events(spark, landed, D(2024, 1, 2), D(2024, 1, 3))
    days = {r[0] for r in raw.select("event_date").distinct().collect()}
    assert days == {D(2024, 1, 2), D(2024, 1, 3)}
    assert dict(raw.dtypes)["event_hour"] == "int"


def test_named_table_is_queryable_and_pruned(spark, landed, scratch):
    loc = scratch("lake")
    lake_load.load_events(spark, landed, loc, D(2024, 1, 1), D(2024, 1, 30),
                          table_name="tw_lake_events")
    total = fixtures.driver_events(spark, SF_SMALL).count()
    assert spark.sql("SELECT count(*) FROM tw_lake_events").first()[0] == total
    q = spark.sql("SELECT count(*) FROM tw_lake_events WHERE created_date = DATE '2024-01-05'")
    assert q.first()[0] > 0
    assert "InMemoryFileIndex(1 paths)" in q._jdf.queryExecution().executedPlan().toString()
    lake_load.load_events(spark, landed, loc, D(2024, 1, 5), D(2024, 1, 5),
                          table_name="tw_lake_events")  # rerun: idempotent
    assert spark.sql("SELECT count(*) FROM tw_lake_events").first()[0] == total


def test_a_long_range_is_written_in_chunks_in_one_pass(spark, scratch):
    ev = lake.with_created_date(lake.normalize_events(fixtures.raw_lake_lines(spark, SF_SMALL)))
    start, end = D(2024, 1, 1), D(2024, 1, 30)
    a, b = scratch("one"), scratch("chunks")
    s1 = sinks.overwrite_days(spark, ev, a, "created_date", start, end)
    s2 = sinks.overwrite_days(spark, ev, b, "created_date", start, end, days_per_write=7)
    for k in s1:
        assert s1[k] == s2[k], k
    assert len(s1["per-day"]) == 30
    assert lake_load.read_events(spark, a).exceptAll(lake_load.read_events(spark, b)).count() == 0


def test_absent_means_path_not_found_only(spark, scratch):
    loc = scratch("probe")
    assert not sinks.table_exists(spark, loc)
    spark.range(3).write.parquet(loc)
    assert sinks.table_exists(spark, loc)
    with pytest.raises(Exception):
        sinks.table_exists(spark, "nosuchscheme://x/y")


def _merge(spark, loc, rows, schema, keys=("k",)):
    return sinks.delete_insert(spark, loc, spark.createDataFrame(rows, schema), keys, "d")


def test_merge_matches_columns_without_case_and_widens(spark, scratch):
    loc = scratch("merge")
    first = spark.createDataFrame([("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))],
                                  "k string, Event_Count int, d date")
    sinks.write_full(spark, loc, first, "d")
    s = _merge(spark, loc, [("a", 5_000_000_000, D(2024, 1, 1))],
               "k string, event_count bigint, d date")
    assert s["schema-changed"]
    rows = {r["k"]: r["event_count"] for r in sinks.read_table(spark, loc).collect()}
    assert rows == {"a": 5_000_000_000, "b": 2}  # the row outside the batch keeps its value
    s = _merge(spark, loc, [("b", 7, D(2024, 1, 2))], "k string, event_count int, d date")
    assert not s["schema-changed"]  # a narrower batch takes the table's type
    with pytest.raises(ValueError):
        _merge(spark, loc, [("b", "x", D(2024, 1, 2))], "k string, event_count string, d date")
    assert dict(sinks.read_table(spark, loc).dtypes)["event_count"] == "bigint"


def test_an_unfinished_swap_is_completed(spark, scratch, monkeypatch):
    loc = scratch("swap")
    schema = "k string, n int, d date"
    sinks.write_full(spark, loc, spark.createDataFrame([("a", 1, D(2024, 1, 1))], schema), "d")

    def fails(*a):
        raise OSError("the cluster went away")

    with monkeypatch.context() as m:
        m.setattr(sinks.Swap, "copy_in", fails)
        with pytest.raises(OSError):
            _merge(spark, loc, [("a", 2, D(2024, 1, 1))], schema)
    _merge(spark, loc, [("b", 3, D(2024, 1, 3))], schema)
    rows = {r["k"]: r["n"] for r in sinks.read_table(spark, loc).collect()}
    assert rows == {"a": 2, "b": 3}
    assert sinks.recover(spark, loc) == 0


def test_an_empty_snapshot_rerun_empties_its_date(spark, scratch):
    root = scratch("snapshots")
    rows = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 2))],
                                 "full_name string, enriched_date date")
    for day in (D(2024, 1, 1), D(2024, 1, 2)):
        sinks.write_repo_snapshot(rows, root, day)
    sinks.write_repo_snapshot(rows.limit(0), root, D(2024, 1, 1))
    assert [r["enriched_date"] for r in files.read_repo_snapshots(spark, root).collect()] \
        == [D(2024, 1, 2)]


def test_a_late_file_with_an_old_time_is_still_read(spark, scratch):
    from tidewater.streaming import file_ingest

    root, base = scratch("landing-old"), scratch("stream-old")
    line = '{"id":"%d","type":"PushEvent","created_at":"2024-01-02T03:00:00Z"}'
    _land_lines(root, "2024-01-02", 3, [line % 1])
    file_ingest.ingest_available(spark, root, f"{base}/staged", f"{base}/checkpoint")
    _land_lines(root, "2024-01-02", 4, [line % 2])
    path = f"{root.replace('file:', '')}/event_date=2024-01-02/event_hour=4/2024-01-02-4.json.gz"
    old = os.path.getmtime(path) - 10 * 86_400
    os.utime(path, (old, old))
    file_ingest.ingest_available(spark, root, f"{base}/staged", f"{base}/checkpoint")
    ids = {r["event_id"] for r in file_ingest.read_staged(spark, f"{base}/staged").collect()}
    assert ids == {"1", "2"}


def test_a_build_refuses_days_without_files(spark, landed, scratch):
    from tidewater.plans.model_build import build_marts

    with pytest.raises(FileNotFoundError):
        build_marts(spark, landed, fixtures.landed_snapshot_files(spark, SF_SMALL),
                    scratch("t"), scratch("l"), D(2024, 2, 3), D(2024, 1, 1))
