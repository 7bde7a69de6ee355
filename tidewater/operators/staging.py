"""Staging models: typed, fixed column lists over the semi-structured inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import parse_utc_timestamp


def stg_events(raw: DataFrame) -> DataFrame:
    """JSON path extraction with casts (``raw_event`` -> 8 typed columns).

    ``from_json`` against a narrow declared schema parses only the extracted
    paths (Catalyst prunes the struct further to what downstream reads).
    """
    j = F.from_json(F.col("raw_event"), schemas.STG_EVENT_JSON)
    return (raw.select("event_date", "event_hour", j.alias("j"))
               .select(
                   "event_date",
                   F.col("event_hour").cast("int").alias("event_hour"),
                   F.col("j.id").alias("event_id"),
                   F.col("j.type").alias("event_type"),
                   F.col("j.actor.login").alias("actor_login"),
                   F.col("j.actor.type").alias("actor_type"),
                   F.col("j.repo.name").alias("repo_name"),
                   parse_utc_timestamp(F.col("j.created_at")).alias("created_at"),
               ))


def stg_from_variant(raw: DataFrame) -> DataFrame:
    """The same columns by typed paths into a VARIANT column; a path that is
    absent, null or of another type gives NULL."""
    def at(path: str) -> Column:
        return F.try_variant_get("raw_event", path, "string")
    return raw.select(
        "event_date", "event_hour", at("$.id").alias("event_id"), at("$.type").alias("event_type"),
        at("$.actor.login").alias("actor_login"), at("$.actor.type").alias("actor_type"),
        at("$.repo.name").alias("repo_name"),
        parse_utc_timestamp(at("$.created_at")).alias("created_at"), "broken_line")


def stg_from_lake(events: DataFrame) -> DataFrame:
    """Staged events from the lake events table. The lake's actor struct has no
    type, so ``actor_type`` is NULL and bots are known by their logins."""
    return events.select(
        F.col(schemas.LAKE_PARTITION_COLUMN).alias("event_date"),
        F.hour("created_at").alias("event_hour"),
        F.col("id").alias("event_id"), F.col("type").alias("event_type"),
        F.col("actor.login").alias("actor_login"),
        F.lit(None).cast("string").alias("actor_type"),
        F.col("repo.name").alias("repo_name"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"))


def stg_repo_metadata_typed(raw_repos: DataFrame, keep_value: bool = False) -> DataFrame:
    """Typed extraction of every snapshot record (string, int, boolean,
    timestamp, array). ``keep_value`` carries the record text along for the
    deterministic tie-break of :func:`latest_repo_metadata`."""
    j = F.from_json(F.col("value"), schemas.REPO_RECORD_JSON)
    cols = [
        F.col("j.full_name").alias("repo_full_name"),
        F.col("j.language").alias("language"),
        F.col("j.topics").alias("topics"),
        F.col("j.stargazers_count").alias("stargazers_count"),
        F.col("j.forks_count").alias("forks_count"),
        F.col("j.is_fork").alias("is_fork"),
        parse_utc_timestamp(F.col("j.created_at")).alias("repo_created_at"),
        F.col("j.description").alias("description"),
        F.col("enriched_date"),
    ]
    if keep_value:
        cols.append(F.col("value"))
    return raw_repos.select("enriched_date", "value", j.alias("j")).select(*cols)


def latest_repo_metadata(raw_repos: DataFrame) -> DataFrame:
    """Latest record per repository (newest ``enriched_date``; NULL dates rank
    first as in a DESC sort with NULLs first; ties broken by the smallest
    record text).

    Expressed as one ``min_by`` aggregate instead of ROW_NUMBER over a window:
    the partial aggregate collapses every key map-side, so a repository with a
    huge number of snapshot rows never lands whole in one sort task.
    """
    typed = stg_repo_metadata_typed(raw_repos, keep_value=True)
    # Smallest rank wins: (NULL date first, then newest date, then smallest text).
    rank = F.struct((-F.unix_date("enriched_date")).alias("neg_day"), F.col("value"))
    payload = F.struct(*[F.col(c) for c in schemas.STG_REPO_COLUMNS if c != "repo_full_name"])
    best = (typed.groupBy("repo_full_name")
                 .agg(F.min_by(payload, rank).alias("r")))
    return best.select("repo_full_name", *[F.col(f"r.{c}").alias(c)
                                           for c in schemas.STG_REPO_COLUMNS
                                           if c != "repo_full_name"])


def repo_record_projection(api_records: DataFrame) -> DataFrame:
    """Project API-shaped records onto the snapshot record (``fork`` ->
    ``is_fork``); ``topics`` defaults to an empty array only when the key is
    absent (an explicit JSON null stays NULL)."""
    j = F.from_json(F.col("value"), schemas.API_REPO_JSON)
    has_topics = F.coalesce(
        F.array_contains(F.json_object_keys(F.col("value")), "topics"), F.lit(False))
    topics = F.when(has_topics, F.col("j.topics")).otherwise(F.array().cast("array<string>"))
    return (api_records.select("enriched_date", "value", j.alias("j"))
            .select(
                F.col("j.full_name").alias("full_name"),
                F.col("j.language").alias("language"),
                topics.alias("topics"),
                F.col("j.stargazers_count").alias("stargazers_count"),
                F.col("j.forks_count").alias("forks_count"),
                F.col("j.fork").alias("is_fork"),
                F.col("j.created_at").alias("created_at"),
                F.col("j.description").alias("description"),
                F.col("enriched_date"),
            ))
