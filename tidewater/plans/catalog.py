"""The models in the catalog: external tables over the landed files and views
on them, for SQL users of any session that shares the catalog.

An external table knows the folders it was told of, so a query on the views is
pruned in the catalog before any folder is listed. New landings are made known
by :func:`refresh_events` (the days that landed) or :func:`refresh_snapshots`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidewater import schemas
from tidewater.functions.columns import BOT, HUMAN
from tidewater.functions.sql import SQL_FUNCTIONS
from tidewater.operators.intermediate import PUSH_EVENT
from tidewater.plans import notes
from tidewater.sources.files import RAW_GLOB

PARTITIONS_PER_STATEMENT = 500


def columns_of(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def add_partitions(spark: SparkSession, table: str, folders: Sequence[str],
                   types: dict[str, str]) -> int:
    """Make partition folders (``.../name=value/...``) known to a table."""
    found = []
    for f in folders:
        values = dict(part.split("=", 1) for part in f.rstrip("/").split("/") if "=" in part)
        found.append("PARTITION (" + ", ".join(f"{c} = {types[c]}'{values[c]}'"
                                               for c in types) + ")")
    for k in range(0, len(found), PARTITIONS_PER_STATEMENT):
        some = " ".join(found[k:k + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
    return len(found)


def refresh_events(spark: SparkSession, database: str, root: str,
                   days: Sequence[dt.date] | None = None) -> int:
    """Add the hour folders of ``days`` (all, if None) to the event table; only
    those day folders are listed. Returns the number of folders found."""
    names = "*" if days is None else "{" + ",".join(d.isoformat() for d in days) + "}"
    return add_partitions(
        spark, f"{database}.raw_events",
        notes.matching(spark, f"{root.rstrip('/')}/event_date={names}/event_hour=*"),
        {"event_date": "DATE ", "event_hour": ""})


def refresh_snapshots(spark: SparkSession, database: str, root: str) -> int:
    return add_partitions(spark, f"{database}.raw_repo_snapshots",
                          notes.matching(spark, f"{root.rstrip('/')}/enriched_date=*"),
                          {"enriched_date": "DATE "})


def create_models(spark: SparkSession, database: str, database_location: str, raw_root: str,
                  snapshot_root: str) -> list[str]:
    """Create the external tables and the views of the models in ``database``;
    returns the names of the views. They hold nothing: every query is planned
    from the files that the tables know of."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{database_location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.raw_events "
              f"({columns_of(schemas.STG_EVENT_JSON)}, event_date DATE, event_hour INT) "
              f"USING json OPTIONS (pathGlobFilter '{RAW_GLOB}') "
              f"PARTITIONED BY (event_date, event_hour) LOCATION '{raw_root}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.raw_repo_snapshots "
              f"(value STRING, enriched_date DATE) USING text "
              f"PARTITIONED BY (enriched_date) LOCATION '{snapshot_root}'")
    moment = "CAST(try_to_timestamp({}) AS TIMESTAMP_NTZ)"
    kept = [c for c in schemas.STG_REPO_COLUMNS if c != "repo_full_name"]
    record = {"repo_created_at": moment.format("j.created_at"), "enriched_date": "enriched_date"}
    views = {
        "stg_events": f"""
            SELECT event_date, event_hour, id AS event_id, type AS event_type,
                   actor.login AS actor_login, actor.type AS actor_type, repo.name AS repo_name,
                   {moment.format("created_at")} AS created_at
            FROM {database}.raw_events""",
        # The newest record of each repository, as an aggregate: no repository is sorted whole.
        "stg_repo_metadata": f"""
            SELECT repo_full_name, {", ".join(f"r.{c}" for c in kept)}
            FROM (SELECT j.full_name AS repo_full_name, min_by(
                           struct({", ".join(f"{record.get(c, f'j.{c}')} AS {c}" for c in kept)}),
                           struct(-unix_date(enriched_date), value)) AS r
                  FROM (SELECT enriched_date, value,
                               from_json(value, '{columns_of(schemas.REPO_RECORD_JSON)}') AS j
                        FROM {database}.raw_repo_snapshots) parsed
                  GROUP BY j.full_name) newest""",
        "events_classified": f"""
            SELECT {", ".join(schemas.CLASSIFIED_COLUMNS[:-2])}, is_bot,
                   CASE WHEN is_bot THEN '{BOT}' ELSE '{HUMAN}' END AS contributor_type
            FROM (SELECT *, {SQL_FUNCTIONS["is_bot"][2]} AS is_bot
                  FROM {database}.stg_events WHERE event_type = '{PUSH_EVENT}') pushes""",
        "events_enriched": f"""
            SELECT {", ".join(f"c.{c}" for c in schemas.CLASSIFIED_COLUMNS)}, m.language, m.topics
            FROM {database}.events_classified c
            LEFT JOIN {database}.stg_repo_metadata m ON c.repo_name = m.repo_full_name""",
    }
    for name, query in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query}")
    return list(views)
