"""Writes that follow what landed: repaired reloads, marts by commits, checks
inside the write, notes, nested schemas, clustered files, notifications."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from conftest import SF_SMALL
from test_loads import _land_lines
from tidewater import registry
from tidewater.days import DaySpan
from tidewater.operators import distinct_sets, intermediate, marts, quality, serving, staging
from tidewater.plans import lake_load, notes, sinks
from tidewater.plans.marts import (backfill_mart, marks_path, read_mart, run_mart,
                                   run_mart_from_commits)
from tidewater.sources import fixtures
from tidewater.streaming import file_ingest, notified

D = dt.date
LINE = ('{"id":"%d","type":"PushEvent","actor":{"login":"u%d"},"repo":{"name":"o/r"},'
        '"created_at":"2024-01-%02dT03:00:00Z"}')


def stored(spark, loc):
    return sorted((str(r["id"]), r["created_date"], r["landed_date"])
                  for r in lake_load.read_events(spark, loc).collect())


def test_a_repaired_upload_takes_its_leftovers_with_it(spark, scratch):
    root, loc, name = scratch("landing"), scratch("lake"), "tw_repaired"
    _land_lines(root, "2024-01-05", 3, [LINE % (1, 1, 5), LINE % (2, 2, 4), '{"id":"3","ty'])
    first = lake_load.load_events(spark, root, loc, D(2024, 1, 5), D(2024, 1, 5), table_name=name)
    assert first["straggler-records"] == first["undated-records"] == 1
    _land_lines(root, "2024-01-05", 3, [LINE % (1, 1, 5), LINE % (3, 3, 5)])
    for _ in range(2):  # and again: nothing more to do
        report = lake_load.run_load(spark, root, loc, D(2024, 1, 5), D(2024, 1, 5), name).collect()
        assert [(r["source_count"], r["delta"]) for r in report] == [(2, 0)]
        assert stored(spark, loc) == [("1", D(2024, 1, 5), D(2024, 1, 5)),
                                      ("3", D(2024, 1, 5), D(2024, 1, 5))]
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 2
    gone = [json.loads(r["summary"]["emptied-folders"])
            for r in sinks.load_history(spark, loc).collect()]
    assert gone == [[], [["2024-01-04", "2024-01-05"], [None, "2024-01-05"]], []]


def test_folders_of_a_load_that_died_are_found(spark, scratch, monkeypatch):
    """It wrote its rows but no commit: the next load lists what is there."""
    root, loc = scratch("landing"), scratch("lake")
    _land_lines(root, "2024-01-05", 3, [LINE % (1, 1, 5), LINE % (2, 2, 3), "{"])
    with monkeypatch.context() as m:
        m.setattr(sinks, "record_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            lake_load.load_events(spark, root, loc, D(2024, 1, 5), D(2024, 1, 5))
    assert len(stored(spark, loc)) == 3
    _land_lines(root, "2024-01-05", 3, [LINE % (1, 1, 5)])
    listed = []
    matching = notes.matching
    monkeypatch.setattr(notes, "matching", lambda *a: listed.append(a[1]) or matching(*a))
    lake_load.run_load(spark, root, loc, D(2024, 1, 5), D(2024, 1, 5))
    assert stored(spark, loc) == [("1", D(2024, 1, 5), D(2024, 1, 5))] and len(listed) == 1
    lake_load.run_load(spark, root, loc, D(2024, 1, 5), D(2024, 1, 5))
    assert len(listed) == 1  # the load that died has been replaced


def test_other_landing_days_keep_their_stragglers(spark, scratch):
    root, loc = scratch("landing"), scratch("lake")
    _land_lines(root, "2024-01-05", 3, [LINE % (1, 1, 4), LINE % (2, 2, 5)])
    _land_lines(root, "2024-01-06", 3, [LINE % (3, 3, 4), LINE % (4, 4, 6)])
    lake_load.run_load(spark, root, loc, D(2024, 1, 5), D(2024, 1, 6))
    _land_lines(root, "2024-01-06", 3, [LINE % (4, 4, 6)])
    lake_load.run_load(spark, root, loc, D(2024, 1, 6), D(2024, 1, 6))
    assert [r[0] for r in stored(spark, loc)] == ["1", "2", "4"]


def test_notes_are_joined_when_they_are_many(spark, scratch):
    path = scratch("notes")
    for k in range(12):
        notes.append(spark, path, spark.range(k, k + 1), max_files=5)
    files = spark.read.schema("id long").parquet(path).inputFiles()
    assert len(files) <= 6
    assert sorted(r["id"] for r in notes.read(spark, path, "id long").collect()) == list(range(12))
    spark.range(12).coalesce(1).write.mode("append").parquet(path)  # a join that was cut short
    assert notes.read(spark, path, "id long").count() == 12
    assert notes.read(spark, path + "-none", "id long").count() == 0


def test_stages_go_and_a_lost_stage_is_told(spark, scratch, monkeypatch):
    loc = scratch("swap")
    schema = "k string, n int, d date"

    def merge(n):
        sinks.delete_insert(spark, loc, spark.createDataFrame([("a", n, D(2024, 1, 1))], schema),
                            ["k"], "d")
    sinks.write_full(spark, loc, spark.createDataFrame([("a", 1, D(2024, 1, 1))], schema), "d")
    used = []
    path_of = sinks.scratch_path
    monkeypatch.setattr(sinks, "scratch_path", lambda s, label: used.append(
        path_of(s, label)) or used[-1])
    merge(2)
    assert used and not any(notes.exists(spark, p) for p in used)
    with monkeypatch.context() as m:
        m.setattr(sinks.Swap, "copy_in", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            merge(3)
    notes.remove(spark, used)
    with pytest.raises(RuntimeError, match="abandon_swaps"):
        merge(4)
    assert sinks.abandon_swaps(spark, loc) == 1
    merge(5)
    assert [r["n"] for r in spark.read.parquet(loc).collect()] == [5]


def by_commits(spark, table, mart, as_of, seen):
    def read(days):
        source = lake_load.read_day_list(spark, table, days)
        seen.append({f.split("created_date=")[1][:10] for f in source.inputFiles()})
        return intermediate.events_classified(staging.stg_from_lake(source))
    told = run_mart_from_commits(spark, marts.TRENDS, table, read, mart, as_of,
                                 batched_at=registry.BATCHED_AT)
    counts = {} if not notes.exists(spark, mart) else {
        r["event_date"].day: r["event_count"]
        for r in read_mart(spark, mart, registry.TRENDS_COLUMNS).collect()}
    return [d[-2:] for d in told["days"]], counts


def test_commits_say_which_days_a_mart_rebuilds(spark, scratch):
    root, table, mart, seen = scratch("landing"), scratch("lake"), scratch("mart"), []

    def land(day, ids):
        _land_lines(root, f"2024-01-{day:02d}", 3, [LINE % (k, k, d) for k, d in ids])
        lake_load.run_load(spark, root, table, D(2024, 1, day), D(2024, 1, day))
    land(2, [(1, 2)])
    land(3, [(2, 3), (3, 3)])
    land(15, [(4, 15)])
    assert by_commits(spark, table, mart, D(2024, 1, 15), seen) == (["02", "03"], {2: 1, 3: 2})
    assert by_commits(spark, table, mart, D(2024, 1, 15), seen)[0] == []   # nothing new
    land(3, [(2, 3), (3, 3), (5, 3), (6, 2)])             # late, and a straggler of another day
    assert by_commits(spark, table, mart, D(2024, 1, 15), seen) == (["02", "03"], {2: 2, 3: 3})
    # 01-15 was written before it was complete: its commit is still unused.
    assert by_commits(spark, table, mart, D(2024, 1, 16), seen) == (["15"], {2: 2, 3: 3, 15: 1})
    assert seen == [{"2024-01-02", "2024-01-03"}] * 2 + [{"2024-01-15"}]  # no other day is read
    days = [json.loads(r["summary"]["partitions"]) for r in
            sinks.load_history(spark, mart).collect() if r["operation"] == "delete+insert"]
    assert days == [["2024-01-15"], ["2024-01-02", "2024-01-03"]]


def test_days_are_marked_only_after_they_are_merged(spark, scratch, monkeypatch):
    root, table, mart = scratch("landing"), scratch("lake"), scratch("mart")
    _land_lines(root, "2024-01-02", 3, [LINE % (1, 1, 2)])
    lake_load.run_load(spark, root, table, D(2024, 1, 2), D(2024, 1, 2))
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_full", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            by_commits(spark, table, mart, D(2024, 1, 9), [])
    assert not notes.exists(spark, marks_path(mart))
    assert by_commits(spark, table, mart, D(2024, 1, 9), []) == (["02"], {2: 1})


def test_backfill_refuses_an_incomplete_day(spark, scratch):
    with pytest.raises(ValueError):
        backfill_mart(spark, marts.TRENDS, lambda days: None, scratch("m"), D(2024, 1, 1),
                      D(2024, 1, 9), D(2024, 1, 9))


def test_language_mart_from_sets_has_no_expand(spark, scratch):
    counts, sets = registry._language_sets(spark, SF_SMALL)
    df = marts.language_from_sets(counts, sets, marts.LANGUAGE.keys)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "bitmap_or_agg" in plan
    raw = marts.language_activity(registry.enriched(spark, SF_SMALL), registry.AS_OF)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    # The events are added up before they are copied per distinct column.
    assert plan.index("Expand") < plan.index("partial_count(1)")


def test_numbers_stay_and_sets_merge(spark, scratch):
    loc = scratch("numbers")
    first = distinct_sets.number_values(spark, loc, spark.createDataFrame(
        [("a",), ("b",), (None,), ("a",)], "v string"))
    before = {r["value"]: r["number"] for r in first.collect()}
    rows = [(k % 3, f"v{k % 50_000}") for k in range(70_000)] + [(9, None), (1, "a")]
    values = spark.createDataFrame(rows, "g int, v string").repartition(5)
    numbers = distinct_sets.number_values(spark, loc, values.select("v"))
    held = {r["value"]: r["number"] for r in numbers.collect()}
    assert held.items() >= before.items() and len(set(held.values())) == len(held) == 50_002
    given = distinct_sets.numbered(values, "v", numbers, "n")
    parts = [distinct_sets.distinct_sets(given.where(F.col("n") % 2 == k), ["g"], "n")
             for k in (0, 1)]
    both = parts[0].unionByName(parts[1])
    got = {r["g"]: r["size"] for r in distinct_sets.sizes(
        distinct_sets.merged(both, ["g"]), ["g"], "size").collect()}
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, set()).add(v)
    assert got == {g: len(v) for g, v in want.items()}


def test_violations_of_each_rule(spark):
    rows = [(1, "a", "human"), (1, None, "alien"), (2, "c", None), (None, "c", "bot")]
    df = spark.createDataFrame(rows, "id int, name string, who string")
    rules = [*quality.not_null("id", "name"), quality.accepted("who", "human", "bot"),
             quality.Rule("id", "unique"), quality.Rule("name", "unique")]
    got = quality.dq_violations(df, "m", rules).collect()
    assert sorted((r["column_name"], r["rule"], str(r["id"]), str(r["name"])) for r in got) == [
        ("id", "not_null", "None", "c"), ("id", "unique", "1", "None"), ("id", "unique", "1", "a"),
        ("name", "not_null", "1", "None"), ("name", "unique", "2", "c"),
        ("name", "unique", "None", "c"), ("who", "accepted_values", "1", "None")]
    counts = {(r["column_name"], r["rule"]): r["failures"]
              for r in quality.dq_check(df, "m", rules).collect()}
    assert counts["who", "accepted_values"] == 1 and counts["id", "not_null"] == 1
    assert quality.dq_violations(df, "m", rules[3:4]).count() == 2  # a unique rule alone


def test_a_broken_batch_is_refused_inside_the_write(spark, scratch):
    loc = scratch("mart")
    c = registry.classified(spark, SF_SMALL)
    rules = quality.RULES["contributor_trends"]
    broken = c.withColumn("contributor_type", F.lit("alien"))
    with pytest.raises(sinks.ChecksFailed) as e:
        run_mart(spark, marts.TRENDS, broken, loc, registry.AS_OF, checks=rules)
    assert e.value.failures == {"accepted_values(contributor_type)": 29}
    assert not notes.exists(spark, loc)
    run_mart(spark, marts.TRENDS, c, loc, registry.AS_OF, checks=rules)
    repeated = [quality.Rule("contributor_type", "unique")]
    with pytest.raises(sinks.ChecksFailed, match="unique"):
        run_mart(spark, marts.TRENDS, c, loc, registry.AS_OF, checks=repeated)
    assert sinks.load_history(spark, loc).count() == 1


def test_common_types():
    def common(spark_type_a, spark_type_b):
        from pyspark.sql.types import StructType
        a, b = (StructType.fromDDL(f"c {t}")["c"].dataType
                for t in (spark_type_a, spark_type_b))
        return sinks.common_type(a, b, "c").simpleString()
    assert common("decimal(9,2)", "decimal(12,4)") == "decimal(12,4)"
    assert common("decimal(9,0)", "decimal(5,4)") == "decimal(13,4)"
    assert common("int", "decimal(5,2)") == "decimal(12,2)"
    assert common("struct<a:int,b:string>", "struct<B:string,A:bigint,c:date>") == \
        "struct<B:string,A:bigint,c:date>"
    assert common("array<struct<a:int>>", "array<struct<a:bigint>>") == "array<struct<a:bigint>>"
    assert common("map<string,int>", "map<string,bigint>") == "map<string,bigint>"
    for a, b in (("decimal(38,0)", "decimal(38,10)"), ("struct<a:int>", "struct<a:string>"),
                 ("array<int>", "int"), ("string", "int")):
        with pytest.raises(ValueError):
            common(a, b)
    assert isinstance(DecimalType(12, 2), DecimalType)


def test_nested_fields_follow_the_batch(spark, scratch):
    loc = scratch("nested")
    old = "k string, d date, s struct<A:int,gone:string>, l array<struct<x:int>>, m map<string,int>"
    sinks.write_full(spark, loc, spark.createDataFrame(
        [("a", D(2024, 1, 1), (1, "z"), [(1,), None], {"p": 1}), ("n", D(2024, 1, 1), None, None,
                                                                 None)], old), "d")
    new = ("k string, d date, s struct<a:bigint,more:struct<q:int>>, "
           "l array<struct<x:bigint,y:string>>, m map<string,bigint>")
    sinks.delete_insert(spark, loc, spark.createDataFrame(
        [("b", D(2024, 1, 2), (5, (6,)), [(7, "y")], {"p": 8})], new), ["k"], "d")
    t = sinks.read_table(spark, loc)
    assert t.schema["s"].dataType.simpleString() == "struct<a:bigint,more:struct<q:int>>"
    rows = {r["k"]: r.asDict(True) for r in t.collect()}
    assert rows["a"]["s"] == {"a": 1, "more": None} and rows["a"]["m"] == {"p": 1}
    assert rows["a"]["l"] == [{"x": 1, "y": None}, None]
    assert rows["n"]["s"] is None and rows["n"]["l"] is None
    assert rows["b"]["s"] == {"a": 5, "more": {"q": 6}}


def rows_scanned(df):
    """Rows that the file scan handed on: those of the row groups it read."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size() or node.nodeName() == "AdaptiveSparkPlan":
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else \
            node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_clustered_days_are_read_in_part(spark, scratch):
    loc, day = scratch("lake"), D(2024, 1, 9)
    n = 40_000
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-09 00:00:00")) + F.col("i") % 86_400)
    events = spark.range(n).select(((F.col("id") * 7919) % n).alias("i")).select(
        F.md5(F.col("i").cast("string")).alias("id"), F.lit("PushEvent").alias("type"),
        F.struct(F.col("i").alias("id"), *[F.lit("x").alias(c) for c in (
            "login", "display_login", "gravatar_id", "url", "avatar_url")]).alias("actor"),
        F.struct(F.col("i").alias("id"), F.concat(F.lit("o/r"), F.md5(F.col("i").cast("string")))
                 .alias("name"), F.lit("u").alias("url")).alias("repo"),
        F.lit("{}").alias("payload"), F.lit(True).alias("public"), at.alias("created_at"),
        F.lit(None).cast("struct<id:bigint,login:string,gravatar_id:string,url:string,"
                         "avatar_url:string>").alias("org"))
    lake_load.write_events(spark, events, loc, day, day)
    before = sorted(r["id"] for r in lake_load.read_events(spark, loc).select("id").collect())
    lake_load.cluster_events(spark, loc, day, day, rows_per_file=10_000, row_group_bytes=200_000)
    t = lake_load.read_events(spark, loc)
    assert sorted(r["id"] for r in t.select("id").collect()) == before
    narrow = t.where((F.col("created_at") >= dt.datetime(2024, 1, 9, 5))
                     & (F.col("created_at") < dt.datetime(2024, 1, 9, 5, 10))).select("id")
    assert narrow.count() == 600 and rows_scanned(narrow) < n / 4
    wanted = t.select("id", "repo.name").first()
    for found in (t.where(F.col("id") == wanted["id"]).select("id"),
                  t.where(F.col("repo.name") == wanted["name"]).select("id")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(" in plan and "EqualTo(" in plan
        assert found.count() == 1 and rows_scanned(found) < n / 4
    assert notes.matching(spark, f"{loc}/created_date=*") == notes.matching(
        spark, f"{loc}/created_date=2024-01-09")


def moments(spark, n, payload="{}"):
    """Lake events of one day, all of the same second."""
    person = "struct<id:bigint,login:string,gravatar_id:string,url:string,avatar_url:string>"
    names = ("login", "display_login", "gravatar_id", "url", "avatar_url")
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("id"), F.lit("PushEvent").alias("type"),
        F.struct("id", *[F.lit("x").alias(c) for c in names]).alias("actor"),
        F.struct("id", F.lit("o/r").alias("name"), F.lit("u").alias("url")).alias("repo"),
        F.lit(payload).alias("payload"), F.lit(True).alias("public"),
        F.lit(dt.datetime(2024, 1, 9, 5)).cast("timestamp").alias("created_at"),
        F.lit(None).cast(person).alias("org"))


def rows_of_files(spark, loc):
    t = lake_load.read_events(spark, loc).groupBy(F.input_file_name().alias("f")).count()
    return sorted(r["count"] for r in t.collect())


def test_no_task_of_clustering_holds_more_than_a_file(spark, scratch):
    loc, day, n = scratch("lake"), D(2024, 1, 9), 40_000
    lake_load.write_events(spark, moments(spark, n), loc, day, day)
    lake_load.cluster_events(spark, loc, day, day, rows_per_file=5_000)
    files = rows_of_files(spark, loc)  # one moment is cut by the ids
    assert sum(files) == n and len(files) >= 8 and files[-1] < 8_000
    lake_load.write_events(spark, moments(spark, 4_000, "w" * 2_000), loc, day, day)
    lake_load.cluster_events(spark, loc, day, day, bytes_per_file=1_000_000)
    files = rows_of_files(spark, loc)  # wide rows: about 450 a file
    assert sum(files) == 4_000 and len(files) >= 8 and files[-1] < 900


def test_sql_functions_are_expressions(spark):
    from tidewater.functions.sql import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql("SELECT is_bot(NULL, 'X-CI'), is_bot('Bot', NULL), is_bot(NULL, NULL), "
                  "percent_of(1, 3), percent_of(NULL, 3), percent_of(1, 0), "
                  "landing_key(previous_hour(TIMESTAMP_NTZ '2024-01-05 00:30:00'))").first()
    assert tuple(r) == (True, True, False, 33.3, 0.0, 0.0,
                        "raw/events/event_date=2024-01-04/event_hour=23/2024-01-04-23.json.gz")
    p = registry.QUERIES["sql_functions"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    assert "Python" not in p.toString() and "BatchEval" not in p.toString()


def notify(spark, queue, *keys, name="ObjectCreated:Put"):
    rows = [(json.dumps({"Records": [{"eventName": name, "s3": {"object": {
        "key": k.replace("=", "%3D")}}}]}),) for k in keys]
    spark.createDataFrame(rows + [("no json",), ('{"Event":"s3:TestEvent"}',)], "value string") \
        .coalesce(1).write.mode("append").text(queue)


def test_notified_files_are_staged_once(spark, scratch, monkeypatch):
    base = scratch("notified")
    root, queue, staged = f"{base}/landing", f"{base}/queue", f"{base}/staged"
    key = "event_date=2024-01-%02d/event_hour=3/2024-01-%02d-3.json.gz"
    for day in (2, 3, 4):
        _land_lines(root, f"2024-01-{day:02d}", 3, [LINE % (day, day, day)])

    def run():
        return notified.ingest_notified(spark, queue, root, staged, f"{base}/ck")

    def ids():
        return sorted(r["event_id"] for r in file_ingest.read_staged(spark, staged).collect())
    notify(spark, queue, key % (3, 3), key % (3, 3))
    assert run() == [key % (3, 3)] and ids() == ["3"]     # 2 and 4 have landed, unannounced
    notify(spark, queue, key % (4, 4), name="ObjectRemoved:Delete")
    notify(spark, queue, key % (3, 3), key % (2, 2))
    # The first attempt fails after its files are staged, before they are noted.
    append = notes.append
    with monkeypatch.context() as m:
        m.setattr(notes, "append", lambda s, path, *a: (_ for _ in ()).throw(OSError("gone"))
                  if path.endswith("_files") else append(s, path, *a))
        with pytest.raises(Exception):
            run()
    assert run() == [key % (2, 2)] and ids() == ["2", "3"]
    assert run() == [] and ids() == ["2", "3"]


def test_newest_rows_of_a_long_mart(spark):
    days = [D(2023, 1, 1) + dt.timedelta(days=k) for k in range(300)]
    df = spark.createDataFrame([(d, t, 1) for d in days for t in ("bot", "human")],
                               "event_date date, contributor_type string, n int")
    got = serving.select_all_limited(df, [F.desc("event_date"), "contributor_type"], 500).collect()
    assert len(got) == 500 and {r["event_date"] for r in got} == set(days[-250:])
    assert len(DaySpan(days[0], days[-1])) == 300


def test_catalog_views_prune_and_know_only_what_they_were_told(spark, scratch):
    from tidewater.plans import catalog

    place, root, snaps = scratch("catalog"), scratch("landing"), scratch("snapshots")
    db = "tw_" + place.rsplit("-", 1)[1]
    for day in (2, 3):
        _land_lines(root, f"2024-01-{day:02d}", 3, [LINE % (day, day, day), "no json"])
    spark.createDataFrame([('{"full_name":"o/r","language":"Go"}', D(2024, 1, 1)),
                           ('{"full_name":"o/r","language":"Rust"}', D(2024, 1, 7))],
                          "value string, enriched_date date") \
        .write.partitionBy("enriched_date").text(snaps)
    assert catalog.create_models(spark, db, place, root, snaps)[-1] == "events_enriched"
    assert spark.table(f"{db}.stg_events").count() == 0        # nothing is known yet
    assert catalog.refresh_events(spark, db, root, [D(2024, 1, 2)]) == 1
    assert catalog.refresh_snapshots(spark, db, snaps) == 2
    for _ in range(2):
        assert [(r["event_id"], r["language"]) for r in
                spark.table(f"{db}.events_enriched").collect()] == [("2", "Rust")]
    assert catalog.refresh_events(spark, db, root) == 2        # one of them anew
    found = spark.sql(f"SELECT event_id, is_bot FROM {db}.events_classified "
                      "WHERE event_date = DATE '2024-01-03'")
    assert [tuple(r) for r in found.collect()] == [("3", False)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "PartitionFilters" in plan
    wanted = registry.QUERIES["events_classified"](spark, SF_SMALL)
    assert spark.table(f"{db}.events_classified").schema.simpleString() \
        == wanted.schema.simpleString()
