"""File sources for the landed data.

Layout of the raw event feed (one gzip JSON-lines file per hour; the hour is
not zero-padded)::

    <root>/event_date=YYYY-MM-DD/event_hour=H/<YYYY-MM-DD>-H.json.gz

Repository metadata snapshots (NDJSON, one folder per run date)::

    <root>/enriched_date=YYYY-MM-DD/*.json

Readers take an explicit schema (no inference pass) and expand a date range
into one glob per day, so only the requested day folders are ever listed.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tidewater import schemas
from tidewater.days import DaySpan
from tidewater.functions.columns import partition_from_path

# Landed files are JSON lines; a writer of plain text lines names them *.txt.gz.
RAW_GLOB = "*.{json,txt}.gz"


def not_landed(days: Sequence[str]) -> FileNotFoundError:
    """The refusal of a run some of whose days have no landed file."""
    return FileNotFoundError("nothing has landed for " + " ".join(days)
                             + f" ({len(days)} of the requested days)")


def _reader(spark: SparkSession, root: str):
    return (spark.read.option("basePath", root.rstrip("/"))
                      .option("pathGlobFilter", RAW_GLOB))


def read_raw_events(spark: SparkSession, root: str,
                    start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Raw event table: ``event_date DATE, event_hour INT, raw_event STRING``.

    Each line is kept as one semi-structured value; ``event_date`` and
    ``event_hour`` come from the path. With a date range only those day
    folders are listed; without one, partition filters on ``event_date``
    still prune at listing time.
    """
    reader = _reader(spark, root)
    if start is not None and end is not None:
        # Named folders, not a pattern: a day that has not landed is an error.
        df = reader.text([f"{root.rstrip('/')}/event_date={d.isoformat()}"
                          for d in DaySpan(start, end)])
    else:
        df = reader.text(root.rstrip("/"))
    return df.select(F.col("event_date").cast("date").alias("event_date"),
                     F.col("event_hour").cast("int").alias("event_hour"),
                     F.col("value").alias("raw_event"))


def read_raw_variant(spark: SparkSession, root: str, start: dt.date | None = None,
                     end: dt.date | None = None) -> DataFrame:
    """The raw event table with a semi-structured column: ``event_date DATE,
    event_hour INT, raw_event VARIANT, broken_line STRING``. A line that is no
    JSON is kept: its variant is NULL and its text stands beside it."""
    raw = read_raw_events(spark, root, start, end)
    value = F.try_parse_json("raw_event")
    return raw.select("event_date", "event_hour", value.alias("raw_event"),
                      F.when(value.isNull(), F.col("raw_event")).alias("broken_line"))


def read_with_file_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Lines of every landed file below ``root``, whatever its folders are
    called: ``file_path`` and ``file_modified`` are the scan's own metadata, and
    the date and hour are parsed from the path (NULL where it names none)."""
    lines = (spark.read.option("recursiveFileLookup", "true")
                       .option("pathGlobFilter", RAW_GLOB).text(root.rstrip("/")))
    day, hour = partition_from_path(F.col("file_path"))
    return (lines.select("value", F.col("_metadata.file_path").alias("file_path"),
                         F.col("_metadata.file_modification_time").alias("file_modified"))
            .select("file_path", "file_modified", day.alias("event_date"),
                    hour.alias("event_hour"), F.col("value").alias("raw_event")))


def rows_per_file(lines: DataFrame) -> DataFrame:
    """Rows, folder (the two innermost names), date, hour and age of each file."""
    parts = F.split("file_path", "/")
    return (lines.groupBy("file_path", "event_date", "event_hour")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.max("file_modified").alias("file_modified"))
            .select("file_path", F.concat_ws("/", F.get(parts, F.size(parts) - 3),
                                             F.get(parts, F.size(parts) - 2)).alias("folder"),
                    "event_date", "event_hour", "n_events", "file_modified"))


def read_lake_source(spark: SparkSession, root: str, start: dt.date, end: dt.date,
                     corrupt_column: str | None = "_corrupt_record") -> DataFrame:
    """Parse the landed JSON of ``[start, end]`` with the declared lake schema.

    One pass: no inference scan. Malformed lines are kept (PERMISSIVE) with
    their text in ``corrupt_column`` so the load can count them.
    """
    fields = list(schemas.LAKE_EVENT_JSON.fields)
    if corrupt_column:
        fields.append(StructField(corrupt_column, StringType()))
    fields += [StructField("event_date", schemas.RAW_EVENTS["event_date"].dataType),
               StructField("event_hour", IntegerType())]
    reader = (_reader(spark, root).schema(StructType(fields)).option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    span = DaySpan(start, end)
    try:
        return reader.json(span.folders(root, "event_date"))
    except AnalysisException as e:  # not one requested day has landed
        raise not_landed(span.absentees(set())) from e


def assert_days_listed(df: DataFrame, start: dt.date, end: dt.date) -> None:
    """Refuse when a requested day has no file in ``df``'s listing.

    Uses the file index the reader built when the DataFrame was created
    (``inputFiles``: listing metadata, no job, nothing read), so the guard
    costs no extra pass and lists nothing outside the requested days.
    """
    present = set()
    for path in df.inputFiles():
        i = path.find("event_date=")
        if i >= 0:
            present.add(path[i + 11:i + 21])
    missing = DaySpan(start, end).absentees(present)
    if missing:
        raise not_landed(missing)


def landed_dates(spark: SparkSession, root: str,
                 start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Distinct ``event_date`` partitions that hold at least one raw file.

    Uses the ``binaryFile`` source without its ``content`` column, so files
    are listed, never read. With a range, only the requested day folders are
    listed (one alternation glob), never the whole archive.
    """
    reader = (spark.read.format("binaryFile").option("basePath", root.rstrip("/"))
                   .option("pathGlobFilter", RAW_GLOB))
    empty = spark.createDataFrame([], "event_date date")
    try:
        if start is not None and end is not None:
            listed = reader.load(DaySpan(start, end).folders(root, "event_date"))
        else:
            listed = reader.load(root.rstrip("/"))
    except AnalysisException:  # nothing matched at all
        return empty
    if "event_date" not in listed.columns:
        return empty
    return listed.select(F.col("event_date").cast("date").alias("event_date")).distinct()


def missing_dates(spark: SparkSession, landed: DataFrame, start: dt.date,
                  end: dt.date) -> DataFrame:
    """Days of ``[start, end]`` with no landed data (``missing_date``)."""
    DaySpan(start, end)  # refuses a reversed range
    expected = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("d"))
    return (expected.join(landed, expected["d"] == landed["event_date"], "left_anti")
                    .select(F.col("d").alias("missing_date")))


def assert_dates_present(spark: SparkSession, landed: DataFrame, start: dt.date,
                         end: dt.date) -> None:
    """Refuse a load when any requested day has no raw data."""
    missing = [r[0].isoformat() for r in missing_dates(spark, landed, start, end)
               .orderBy("missing_date").collect()]  # bounded by the requested range
    if missing:
        raise not_landed(missing)


# Shape of the landed nested event used when writing landing files: the
# actor carries one key outside the declared struct, the payload is written
# inline as JSON.
LANDING_ACTOR = StructType([
    StructField("url", StringType()), StructField("login", StringType()),
    StructField("display_login", StringType()), StructField("gravatar_id", StringType()),
    StructField("zzz_extra", LongType()), StructField("avatar_url", StringType()),
    StructField("id", LongType()),
])
LANDING_EVENT = StructType([
    StructField("id", StringType()), StructField("type", StringType()),
    StructField("actor", LANDING_ACTOR), StructField("repo", schemas.REPO),
    StructField("payload", VariantType()), StructField("public", BooleanType()),
    StructField("created_at", StringType()), StructField("org", schemas.ORG),
])


def write_landing_files(lines: DataFrame, root: str, line_col: str = "line",
                        schema: StructType = LANDING_EVENT) -> None:
    """Write event lines as gzip JSON-lines files in the hourly layout.

    ``lines`` carries ``event_date``, ``event_hour`` and the JSON text, which
    is re-serialised through ``schema``. Rows are rebalanced by (day, hour)
    so each hour folder gets one file (a very large hour is split by AQE).
    """
    parsed = lines.select(F.from_json(F.col(line_col), schema).alias("j"),
                          "event_date", "event_hour").select("j.*", "event_date", "event_hour")
    (parsed.hint("rebalance", "event_date", "event_hour")
           .write.mode("overwrite").option("compression", "gzip")
           .partitionBy("event_date", "event_hour").json(root))


def write_landing_text(lines: DataFrame, root: str, line_col: str = "line") -> None:
    """The same layout with every line as it is, broken ones included."""
    (lines.select(F.col(line_col).alias("value"), "event_date", "event_hour")
          .hint("rebalance", "event_date", "event_hour")
          .write.mode("overwrite").option("compression", "gzip")
          .partitionBy("event_date", "event_hour").text(root))


def has_files(spark: SparkSession, root: str, name_glob: str | None = None) -> bool:
    """Whether ``root`` holds files (matching ``name_glob``): listing only, no job."""
    reader = spark.read
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    try:
        return bool(reader.text(root.rstrip("/")).inputFiles())
    except AnalysisException:
        return False


def read_repo_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot table: ``enriched_date DATE, value STRING`` (one record per
    line, the date from the folder name)."""
    df = spark.read.option("basePath", root.rstrip("/")).text(root.rstrip("/"))
    return df.select(F.col("enriched_date").cast("date").alias("enriched_date"),
                     F.col("value"))


def read_staged_events(spark: SparkSession, root: str, start: dt.date | None = None,
                       end: dt.date | None = None) -> DataFrame:
    """Staged events straight from the landed files, parsed once in the scan.

    The JSON reader applies the narrow staging schema while reading, so a
    later filter on ``event_type`` is evaluated on the parsed column instead
    of re-parsing the line (as a text read + ``from_json`` would after
    predicate pushdown). Same columns as :func:`staging.stg_events`.
    """
    from tidewater.functions import parse_utc_timestamp

    schema = StructType(list(schemas.STG_EVENT_JSON.fields) + [
        StructField("event_date", schemas.RAW_EVENTS["event_date"].dataType),
        StructField("event_hour", IntegerType())])
    reader = _reader(spark, root).schema(schema)
    if start is not None and end is not None:
        df = reader.json(DaySpan(start, end).folders(root, "event_date"))
    else:
        df = reader.json(root.rstrip("/"))
    return df.select(
        "event_date", "event_hour",
        F.col("id").alias("event_id"), F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"), F.col("actor.type").alias("actor_type"),
        F.col("repo.name").alias("repo_name"),
        parse_utc_timestamp(F.col("created_at")).alias("created_at"))
