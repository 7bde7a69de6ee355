"""Adaptation of the driver tables into the pipeline's native input shapes.

The pipeline's real inputs are hourly JSON event files and weekly NDJSON
repository snapshots. The driver ships ``events`` and ``part`` parquet tables
instead, so these builders derive, row for row and entirely on Spark, the same
JSON texts those files would hold. Each builder is a narrow projection of one
parquet scan (column pruning and, for a date range, a pushed ``ts`` filter
that plays the role of partition pruning); nothing is collected.

The exact derivation rules are fixed values shared with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_if_narrow(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a scan that yields fewer splits than the cluster has cores.

    A single-row-group file gives one task, which would run all per-row JSON
    work single-threaded. A scan that already has enough splits (any large
    input) is left alone: no shuffle is added where it buys nothing.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target, key)
    return df


def _k(props: Column) -> Column:
    """The integer ``k`` carried in the ``props`` JSON of a driver event."""
    return F.get_json_object(props, "$.k").cast("int")


def _s(c: Column) -> Column:
    return c.cast("string")


def _iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def driver_events(spark: SparkSession, sf_dir: str,
                  start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The driver ``events`` table, optionally pruned to whole UTC days.

    The bound is expressed on the raw ``ts`` column so it reaches the parquet
    scan as a pushed filter (the fixture's stand-in for path pruning).
    """
    ev = _table(spark, sf_dir, "events")
    if start is not None:
        ev = ev.filter(F.col("ts") >= F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz"))
    if end is not None:
        upper = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
        ev = ev.filter(F.col("ts") < F.lit(upper).cast("timestamp_ntz"))
    return spread_if_narrow(ev, "event_id")


# Driver event type -> event type of the raw feed.
EVENT_TYPE_MAP = [("click", "PushEvent"), ("purchase", "PullRequestEvent"),
                  ("error", "IssuesEvent"), ("signup", "CreateEvent")]
OTHER_EVENT_TYPE = "WatchEvent"


def _mapped_event_type(et: Column) -> Column:
    out = None
    for src, dst in EVENT_TYPE_MAP:
        out = F.when(et == src, F.lit(dst)) if out is None else out.when(et == src, F.lit(dst))
    return out.otherwise(F.lit(OTHER_EVENT_TYPE))


def _actor_login(user_id: Column) -> Column:
    u = _s(user_id)
    m = user_id % 10
    # Login shapes by user_id % 10 (patterns, near misses).
    return (F.when(m == 0, F.concat(F.lit("user"), u, F.lit("[bot]")))
            .when(m == 1, F.concat(F.lit("user"), u, F.lit("-bot")))
            .when(m == 2, F.concat(F.lit("User"), u, F.lit("-CI")))
            .when(m == 3, F.concat(F.lit("user"), u, F.lit("-automation")))
            .when(m == 4, F.concat(F.lit("user"), u, F.lit("-bots")))
            .when(m == 5, F.concat(F.lit("ci-user"), u))
            .otherwise(F.concat(F.lit("user"), u)))


def _actor_type_member(user_id: Column) -> Column:
    m = user_id % 10
    # Actor type Bot / null / missing / User by user_id % 10.
    return (F.when(m == 6, F.lit(',"type":"Bot"'))
            .when(m == 7, F.lit(',"type":null'))
            .when(m == 8, F.lit(""))
            .otherwise(F.lit(',"type":"User"')))


def _repo_name(k: Column) -> Column:
    # k = 13 gives a name without a slash.
    return (F.when(k == 13, F.lit("repo13"))
            .otherwise(F.concat(F.lit("org"), _s(k % 7), F.lit("/repo"), _s(k))))


def build_raw_events(spark: SparkSession, sf_dir: str,
                     start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Raw event table: ``event_date DATE, event_hour INT, raw_event STRING``."""
    ev = driver_events(spark, sf_dir, start, end)
    k = _k(F.col("props"))
    raw = F.concat(
        F.lit('{"id":"'), _s(F.col("event_id")),
        F.lit('","type":"'), _mapped_event_type(F.col("event_type")),
        F.lit('","actor":{"login":"'), _actor_login(F.col("user_id")), F.lit('"'),
        _actor_type_member(F.col("user_id")),
        F.lit('},"repo":{"name":"'), _repo_name(k),
        F.lit('"},"created_at":"'), _iso_seconds(F.col("ts")), F.lit('Z"}'),
    )
    return ev.select(
        F.col("ts").cast("date").alias("event_date"),
        F.hour("ts").cast("int").alias("event_hour"),
        raw.alias("raw_event"),
    )


def build_raw_lake_lines(spark: SparkSession, sf_dir: str,
                         start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Full nested event lines (every declared field, actor keys out of order,
    one unknown key, ``org`` absent for a third of users), plus the landing
    partition columns ``event_date``/``event_hour`` and ``line``."""
    ev = driver_events(spark, sf_dir, start, end)
    k = _k(F.col("props"))
    uid = _s(F.col("user_id"))
    org = (F.when(F.col("user_id") % 3 == 0, F.lit(""))
           .otherwise(F.concat(F.lit(',"org":{"id":'), _s(F.col("user_id") % 3),
                               F.lit(',"login":"o","gravatar_id":"","url":"ou","avatar_url":"oa"}'))))
    line = F.concat(
        F.lit('{"id":"'), _s(F.col("event_id")), F.lit('","type":"'), F.col("event_type"),
        F.lit('","actor":{"url":"u'), uid,
        F.lit('","login":"user'), uid,
        F.lit('","display_login":"D'), uid,
        F.lit('","gravatar_id":"","zzz_extra":1,"avatar_url":"a'), uid,
        F.lit('","id":'), uid,
        F.lit('},"repo":{"id":'), _s(k), F.lit(',"name":"org/repo'), _s(k),
        F.lit('","url":"r"},"payload":'), F.col("props"),
        F.lit(',"public":'),
        F.when(F.col("event_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"created_at":"'), _iso_seconds(F.col("ts")), F.lit('Z"'),
        org, F.lit("}"),
    )
    return ev.select(
        F.col("ts").cast("date").alias("event_date"),
        F.hour("ts").cast("int").alias("event_hour"),
        line.alias("line"),
    )


# Snapshot dates by p_size % 4 and languages by p_type.
SNAPSHOT_DATES = ["2024-01-07", "2024-01-14", "2024-01-21", "2024-01-28"]
LANGUAGE_BY_TYPE = [("ECONOMY", "Python"), ("LARGE", "JavaScript"), ("MEDIUM", "Go"),
                    ("SMALL", "Rust"), ("STANDARD", "TypeScript")]
REPOS_WITH_METADATA = 90


def raw_repo_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repo snapshot table: ``enriched_date DATE, value STRING`` (one record)."""
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    r = F.col("p_partkey") % REPOS_WITH_METADATA
    snap = None
    for i, d in enumerate(SNAPSHOT_DATES):
        cond = (F.col("p_size") % 4) == i
        snap = F.when(cond, F.lit(d)) if snap is None else snap.when(cond, F.lit(d))
    lang = F.when(r == 17, F.lit('"unknown"'))
    for ptype, name in LANGUAGE_BY_TYPE:
        lang = lang.when(F.col("p_type") == ptype, F.lit(f'"{name}"'))
    lang = lang.otherwise(F.lit("null"))
    value = F.concat(
        F.lit('{"full_name":"org'), _s(r % 7), F.lit("/repo"), _s(r),
        F.lit('","language":'), lang,
        F.lit(',"topics":["'), F.lower("p_type"), F.lit('","'), F.col("p_brand"), F.lit('"]'),
        F.lit(',"stargazers_count":'), _s(F.col("p_size") * 100),
        F.lit(',"forks_count":'), _s(F.col("p_size")),
        F.lit(',"is_fork":'),
        F.when(F.col("p_partkey") % 5 == 0, F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"created_at":"2020-01-01T00:00:00Z"'),
        F.lit(',"description":'),
        F.when(F.col("p_partkey") % 11 == 0, F.lit("null"))
         .otherwise(F.concat(F.lit('"'), F.col("p_name"), F.lit('"'))),
        F.lit("}"),
    )
    return p.select(snap.cast("date").alias("enriched_date"), value.alias("value"))


# The topics member removed from one group of API records.
API_DROPPED_TOPICS = ',"topics":["promo","Brand#7"]'


def api_repo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped records: ``fork`` instead of ``is_fork``; one group without
    a ``topics`` key. Columns ``enriched_date, value``."""
    snaps = raw_repo_snapshots(spark, sf_dir)
    v = F.replace(F.col("value"), F.lit('"is_fork":'), F.lit('"fork":'))
    v = F.replace(v, F.lit(API_DROPPED_TOPICS), F.lit(""))
    return snaps.select("enriched_date", v.alias("value"))


# -- landed copies -------------------------------------------------------------
#
# The raw texts stand in for files that are already landed when a query runs.
# They are derived once per application and driver-table folder and written
# as a day-partitioned Parquet table under the shared checkpoint folder:
# durable (lineage cut, survives executor loss), scanned in parallel, and
# pruned by day like the real landing layout. Queries still parse every text.

_LANDED: dict[tuple[str, str, str], str] = {}


def _landed(spark: SparkSession, sf_dir: str, name: str, build, columns: list[str],
            start: dt.date | None, end: dt.date | None) -> DataFrame:
    from tidewater.plans.sinks import table_exists
    from tidewater.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _LANDED.get(key)
    if path is None or not table_exists(spark, path):
        path = scratch_path(spark, f"landed-{name}")
        (build(spark, sf_dir).hint("rebalance", "event_date")
            .write.mode("overwrite").partitionBy("event_date").parquet(path))
        _LANDED[key] = path
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("event_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("event_date") <= F.lit(end))
    return df.select(*columns)


def raw_events(spark: SparkSession, sf_dir: str,
               start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Landed raw event table (``event_date``, ``event_hour``, ``raw_event``);
    a day range prunes partitions."""
    return _landed(spark, sf_dir, "raw-events", build_raw_events,
                   ["event_date", "event_hour", "raw_event"], start, end)


def raw_lake_lines(spark: SparkSession, sf_dir: str,
                   start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Landed nested event lines (``event_date``, ``event_hour``, ``line``)."""
    return _landed(spark, sf_dir, "lake-lines", build_raw_lake_lines,
                   ["event_date", "event_hour", "line"], start, end)


_LANDING: dict[tuple[str, str, str], str] = {}


def _landed_text(spark: SparkSession, sf_dir: str, name: str, lines) -> str:
    """Folder of hourly gzip files that hold the lines of ``lines()`` as they
    are, landed once per application."""
    from tidewater.session import scratch_path
    from tidewater.sources import files

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    root = _LANDING.get(key)
    if root is None or not files.has_files(spark, root, files.RAW_GLOB):
        root = scratch_path(spark, f"landing-{name}")
        files.write_landing_text(lines(), root, "raw_event")
        _LANDING[key] = root
    return root


def landed_event_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of hourly gzip JSON event files for the raw events of ``sf_dir``
    (``event_date=D/event_hour=H/*.gz``).

    Landed once per application, like the other landed copies: the files are
    the stream's input, and every stream run brings its own checkpoint, so
    each run still picks up every file itself.
    """
    return _landed_text(spark, sf_dir, "events", lambda: raw_events(spark, sf_dir))


# Fixed value: a cut copy of the line of every 50th id is landed beside it.
BROKEN_EVERY, BROKEN_LENGTH = 50, 25


def landed_files_with_broken_lines(spark: SparkSession, sf_dir: str) -> str:
    def lines() -> DataFrame:
        raw = raw_events(spark, sf_dir)
        cut = raw.where(F.get_json_object("raw_event", "$.id").cast("bigint") % BROKEN_EVERY == 0)
        return raw.unionByName(cut.withColumn(
            "raw_event", F.substring("raw_event", 1, BROKEN_LENGTH)))
    return _landed_text(spark, sf_dir, "broken", lines)


# The lines of every 97th id come in one file of a hand-made folder.
UPLOADED_EVERY, UPLOAD_FOLDER = 97, "uploads/batch_1"


def landed_mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Hourly files, one an hour, and one file in a folder without a date."""
    from tidewater.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "mixed")
    if key not in _LANDING:
        root = scratch_path(spark, "landing-mixed")
        raw = raw_events(spark, sf_dir).withColumnRenamed("raw_event", "value")
        uploaded = F.get_json_object("value", "$.id").cast("bigint") % UPLOADED_EVERY == 0
        (raw.where(~uploaded).repartition("event_date", "event_hour")
            .write.option("compression", "gzip").partitionBy("event_date", "event_hour").text(root))
        (raw.where(uploaded).select("value").coalesce(1)
            .write.option("compression", "gzip").text(f"{root}/{UPLOAD_FOLDER}"))
        _LANDING[key] = root
    return _LANDING[key]


_SNAPSHOT_FILES: dict[tuple[str, str], str] = {}


def landed_snapshot_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of NDJSON repository snapshots (``enriched_date=D/*.txt``, one
    record per line) for ``sf_dir``, landed once per application."""
    from tidewater.session import scratch_path
    from tidewater.sources import files

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    root = _SNAPSHOT_FILES.get(key)
    if root is None or not files.has_files(spark, root):
        root = scratch_path(spark, "landing-snapshots")
        (raw_repo_snapshots(spark, sf_dir).hint("rebalance", "enriched_date")
            .write.mode("overwrite").partitionBy("enriched_date").text(root))
        _SNAPSHOT_FILES[key] = root
    return root


# Fixed value: of the nested event lines, those of every 50th id land a day late.
LATE_EVERY = 50


def lines_with_stragglers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested event lines (``event_date`` is the landing day) with every
    ``LATE_EVERY``-th id landed a day after it happened and a copy of that
    line cut off in the middle, as a broken upload leaves it."""
    lines = raw_lake_lines(spark, sf_dir)
    late = F.get_json_object("line", "$.id").cast("bigint") % LATE_EVERY == 0
    moved = lines.withColumn("event_date", F.when(late, F.date_add("event_date", 1))
                             .otherwise(F.col("event_date")))
    broken = lines.where(late).withColumn("line", F.substring("line", 1, 25))
    return moved.unionByName(broken)


_LAKE_FILES: dict[tuple[str, str], str] = {}


def landed_lake_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of hourly gzip JSON files of the nested event lines, landed once
    per application."""
    from tidewater.session import scratch_path
    from tidewater.sources import files

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    root = _LAKE_FILES.get(key)
    if root is None or not files.has_files(spark, root, files.RAW_GLOB):
        root = scratch_path(spark, "landing-lake")
        files.write_landing_files(raw_lake_lines(spark, sf_dir), root)
        _LAKE_FILES[key] = root
    return root


def notification_drops(spark: SparkSession, root: str) -> list[DataFrame]:
    """Notifications of the files below ``root`` (column ``value``), in three
    drops: the later half of each day first; then the first half with one half
    of the later files again; then all again, with a deletion, a file of
    another kind and one elsewhere for each."""
    files_of = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.gz").load(root).select("path", "length"))
    key = F.substring_index("path", root.rstrip("/").rsplit("/", 1)[1] + "/", -1)
    named = files_of.select(key.alias("key"), "length").withColumn(
        "hour", F.regexp_extract("key", "event_hour=([0-9]+)", 1).cast("int"))

    def record(name: str, said: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(
            F.lit(name).alias("eventName"), F.lit("2024-01-30T00:00:00.000Z").alias("eventTime"),
            F.struct(F.struct(F.url_encode(said).alias("key"),
                              F.col("length").alias("size")).alias("object"))
            .alias("s3"))).alias("Records")))
    created = record("ObjectCreated:Put", F.col("key"))
    other = (record("ObjectRemoved:Delete", F.col("key")),
             record("ObjectCreated:Put", F.concat(F.col("key"), F.lit(".tmp"))),
             record("ObjectCreated:Put", F.concat(F.lit("other/"), F.col("key"))))
    late = F.col("hour") >= 12
    return [drop.toDF("value") for drop in (
        named.where(late).select(created),
        named.where(~late | (F.col("hour") % 2 == 0)).select(created),
        named.select(F.explode(F.array(created, *other))))]
