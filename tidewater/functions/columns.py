"""Scalar column builders shared by the models.

All of these compile to Catalyst expressions and stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

# Login patterns (case-insensitive, brackets literal) that mark
# an automated actor, and the actor type that marks one directly.
BOT_LOGIN_PATTERNS = ["%[bot]%", "%-bot", "%-ci", "%-automation"]
BOT_ACTOR_TYPE = "Bot"

# Contributor labels.
BOT = "bot"
HUMAN = "human"


def bot_flag(actor_type: Column, actor_login: Column) -> Column:
    """TRUE when the actor is declared a bot or the login matches a pattern.

    Written as CASE WHEN ... THEN TRUE ELSE FALSE so that NULL inputs give
    FALSE rather than NULL (three-valued logic).
    """
    cond = actor_type == F.lit(BOT_ACTOR_TYPE)
    for pattern in BOT_LOGIN_PATTERNS:
        cond = cond | actor_login.ilike(pattern)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def contributor_label(is_bot: Column) -> Column:
    return F.when(is_bot, F.lit(BOT)).otherwise(F.lit(HUMAN))


def parse_utc_timestamp(iso_text: Column) -> Column:
    """ISO-8601 text (``...Z``) to a UTC wall-clock TIMESTAMP_NTZ.

    Malformed text gives NULL instead of failing the job (ANSI mode); the
    not-null checks of the quality layer count such rows.
    """
    return F.try_to_timestamp(iso_text).cast("timestamp_ntz")


def previous_full_hour(ts: Column) -> Column:
    """The most recently completed hour before ``ts``: subtract 1 h, truncate."""
    shifted = ts - F.expr("INTERVAL 1 HOUR")
    return F.date_trunc("hour", shifted).cast("timestamp_ntz")


def landing_key(ts_hour: Column, prefix: str = "raw/events") -> Column:
    """Object key of one hourly file; the hour is *not* zero-padded."""
    day = F.date_format(ts_hour, "yyyy-MM-dd")
    hour = F.hour(ts_hour)
    return F.format_string(prefix.rstrip("/") + "/event_date=%s/event_hour=%d/%s-%d.json.gz",
                           day, hour, day, hour)


def repo_name_parts(name: Column) -> tuple[Column, Column, Column]:
    """Split ``owner/repo`` into at most two parts.

    Returns (owner, repo, well_formed); a name without a slash is malformed.
    """
    parts = F.split(name, "/", 2)
    well_formed = F.coalesce(F.size(parts) == 2, F.lit(False))
    # get() yields NULL past the end (indexing would fail under ANSI mode).
    return F.get(parts, 0), F.get(parts, 1), well_formed


def percent_of(part: Column, total: Column) -> Column:
    """``round(part / total * 100, 1)`` with a zero guard; NULLs count as 0."""
    part0 = F.coalesce(part, F.lit(0))
    total0 = F.coalesce(total, F.lit(0))
    return (F.when(total0 > 0, F.round(part0 / total0 * 100, 1))
            .otherwise(F.lit(0.0)))


def partition_from_path(path: Column) -> tuple[Column, Column]:
    """``event_date`` and ``event_hour`` parsed out of a Hive-style file path
    (fallback when a layout is read without partition discovery)."""
    day = F.split_part(F.split_part(path, F.lit("event_date="), F.lit(2)), F.lit("/"), F.lit(1))
    hour = F.split_part(F.split_part(path, F.lit("event_hour="), F.lit(2)), F.lit("/"), F.lit(1))
    return day.try_cast("date"), hour.try_cast("int")


def width(value: Column, kind: DataType) -> Column:
    """About the bytes that a value takes in a row: fields by eight, texts by
    their length, collections by that of their JSON."""
    if isinstance(kind, StructType):
        return sum((width(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, (ArrayType, MapType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)) + 32
    return F.lit(8)


def bytes_of_rows(schema: StructType) -> Column:
    """About the bytes that all rows take in memory, uncompressed."""
    row = sum((width(F.col(f.name), f.dataType) for f in schema.fields), F.lit(0))
    return F.coalesce(F.sum(row.cast("bigint")), F.lit(0))
