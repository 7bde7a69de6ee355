"""Intermediate models: push-event classification and metadata enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.functions import bot_flag, contributor_label

PUSH_EVENT = "PushEvent"


def push_events(stg: DataFrame) -> DataFrame:
    """Keep one event type."""
    return stg.filter(F.col("event_type") == PUSH_EVENT)


def events_classified(stg: DataFrame) -> DataFrame:
    """Push events with ``is_bot`` and the ``bot``/``human`` label."""
    pe = push_events(stg)
    is_bot = bot_flag(F.col("actor_type"), F.col("actor_login"))
    return (pe.withColumn("is_bot", is_bot)
              .withColumn("contributor_type", contributor_label(F.col("is_bot")))
              .select(*schemas.CLASSIFIED_COLUMNS))


def events_enriched(classified: DataFrame, latest_meta: DataFrame,
                    with_match_flag: bool = False) -> DataFrame:
    """Left outer equi-join of events to the latest metadata per repository.

    Unmatched events are kept with NULL language/topics; the key comparison is
    case-sensitive. Building the join runs no job: adaptive execution measures
    the metadata side when it is there and broadcasts it within
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, else shuffles (and
    splits a hot repository).
    """
    meta = latest_meta.select(
        F.col("repo_full_name"), F.col("language"), F.col("topics"),
        F.lit(True).alias("_matched"))
    joined = classified.join(meta, classified["repo_name"] == meta["repo_full_name"], "left")
    cols = [classified[c] for c in schemas.CLASSIFIED_COLUMNS] + [meta["language"], meta["topics"]]
    if with_match_flag:
        cols.append(F.coalesce(meta["_matched"], F.lit(False)).alias("matched"))
    return joined.select(*cols)


def enrichment_coverage(enriched_with_flag: DataFrame) -> DataFrame:
    """Matched versus unmatched rows of the enrichment join, one row."""
    return enriched_with_flag.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("matched")).alias("matched_events"),
        F.count_if(~F.col("matched")).alias("unmatched_events"),
        F.count_if(F.col("language").isNull()).alias("null_language_events"),
    )
