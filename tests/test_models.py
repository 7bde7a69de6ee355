"""Staging, classification and metadata models on literal rows (traps)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import bot_flag, repo_name_parts
from tidewater.operators import intermediate, staging


def test_bot_flag_truth_table(spark):
    rows = [
        ("Bot", "plain"), ("User", "dependabot[bot]"), (None, "x[BOT]y"), ("User", "a-bot"),
        ("User", "a-BOT"), ("User", "a-ci"), ("User", "b-Automation"), ("User", "a-bots"),
        ("User", "ci-user"), (None, None), ("User", None), (None, "b"), ("User", "[bo]t"),
        ("User", "bot"), ("bot", "x"),
    ]
    df = spark.createDataFrame(rows, "actor_type string, actor_login string")
    got = [r[0] for r in df.select(bot_flag(F.col("actor_type"), F.col("actor_login"))).collect()]
    assert got == [True, True, True, True, True, True, True, False, False, False, False, False,
                   False, False, False]
    assert None not in got  # three-valued logic never leaks NULL


def test_stg_events_by_name_and_types(spark):
    raw = spark.createDataFrame(
        [(dt.date(2024, 1, 2), 3,
          '{"created_at":"2024-01-02T03:04:05Z","repo":{"name":"o/r","id":1},'
          '"actor":{"type":null,"login":"L","id":9},"type":"PushEvent","id":"17"}'),
         (dt.date(2024, 1, 2), 3, '{"id":"18","type":"PushEvent","actor":{"login":"M"}}'),
         (dt.date(2024, 1, 2), 3, 'not json')],
        "event_date date, event_hour int, raw_event string")
    out = staging.stg_events(raw).collect()
    assert out[0]["event_id"] == "17" and out[0]["actor_login"] == "L"
    assert out[0]["actor_type"] is None and out[0]["repo_name"] == "o/r"
    assert out[0]["created_at"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert out[1]["created_at"] is None and out[1]["repo_name"] is None
    assert out[2]["event_id"] is None  # malformed line: NULLs, counted by DQ


def test_classified_columns_and_filter(spark):
    raw = spark.createDataFrame(
        [(dt.date(2024, 1, 2), 1, '{"id":"1","type":"PushEvent","actor":{"login":"a-ci"}}'),
         (dt.date(2024, 1, 2), 1, '{"id":"2","type":"WatchEvent","actor":{"login":"a"}}')],
        "event_date date, event_hour int, raw_event string")
    c = intermediate.events_classified(staging.stg_events(raw))
    rows = c.collect()
    assert len(rows) == 1 and rows[0]["contributor_type"] == "bot" and rows[0]["is_bot"] is True
    assert c.columns[-2:] == ["is_bot", "contributor_type"]


def _snap(spark, rows):
    return spark.createDataFrame(rows, "enriched_date date, value string")


def test_latest_metadata_newest_then_smallest_text(spark):
    d1, d2 = dt.date(2024, 1, 7), dt.date(2024, 1, 14)
    rows = [(d1, '{"full_name":"o/a","language":"Go"}'),
            (d2, '{"full_name":"o/a","language":"Rust"}'),
            (d2, '{"full_name":"o/a","language":"C"}'),
            (d1, '{"full_name":"o/b","language":"Go"}'),
            (None, '{"full_name":"o/b","language":"Zig"}')]
    got = {r["repo_full_name"]: (r["language"], r["enriched_date"])
           for r in staging.latest_repo_metadata(_snap(spark, rows)).collect()}
    assert got["o/a"] == ("C", d2)          # tie on date: smallest record text
    assert got["o/b"] == ("Zig", None)      # NULL date ranks first (DESC NULLS FIRST)


def test_repo_record_projection_topics_default(spark):
    rows = [(dt.date(2024, 1, 7), '{"full_name":"o/a","fork":true,"topics":["x"]}'),
            (dt.date(2024, 1, 7), '{"full_name":"o/b","fork":false}'),
            (dt.date(2024, 1, 7), '{"full_name":"o/c","topics":null}')]
    got = {r["full_name"]: (r["topics"], r["is_fork"])
           for r in staging.repo_record_projection(_snap(spark, rows)).collect()}
    assert got == {"o/a": (["x"], True), "o/b": ([], False), "o/c": (None, None)}


def test_repo_name_parts(spark):
    df = spark.createDataFrame([("a/b",), ("a/b/c",), ("nos",), ("",), (None,)], "n string")
    o, r, ok = repo_name_parts(F.col("n"))
    got = [tuple(x) for x in df.select(o, r, ok).collect()]
    assert got[0] == ("a", "b", True) and got[1] == ("a", "b/c", True)
    assert [g[2] for g in got[2:]] == [False, False, False]


def test_enrichment_is_case_sensitive_left_join(spark):
    ev = spark.createDataFrame(
        [(dt.date(2024, 1, 2), 1, "1", "PushEvent", None, "a", None, "O/A", False, "human"),
         (dt.date(2024, 1, 2), 1, "2", "PushEvent", None, "a", None, "o/a", False, "human")],
        "event_date date, event_hour int, event_id string, event_type string, "
        "created_at timestamp_ntz, actor_login string, actor_type string, repo_name string, "
        "is_bot boolean, contributor_type string")
    meta = spark.createDataFrame([("o/a", "Go", ["t"])],
                                 "repo_full_name string, language string, topics array<string>")
    out = {r["event_id"]: r["language"]
           for r in intermediate.events_enriched(ev, meta).collect()}
    assert out == {"1": None, "2": "Go"}


def test_pivot_refuses_too_many_values(spark):
    from tidewater.operators import serving

    long = spark.createDataFrame([(k % 3, f"s{k}", k) for k in range(30)], "d int, s string, v int")
    assert len(serving.pivot_series(long, "d", "s", "v").columns) == 31
    before = spark.conf.get("spark.sql.pivotMaxValues")
    try:
        spark.conf.set("spark.sql.pivotMaxValues", "20")
        with pytest.raises(ValueError):
            serving.pivot_series(long, "d", "s", "v")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)
