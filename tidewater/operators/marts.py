"""Daily marts: batch computations (what one run of a mart produces).

Writing a batch into its target table (full build or keyed delete+insert) is
in :mod:`tidewater.plans.marts`.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater import schemas
from tidewater.operators import distinct_sets

DEFAULT_LOOKBACK_DAYS = 3
UNKNOWN_LANGUAGE = "unknown"


def _batched_at_col(batched_at: dt.datetime | None) -> Column:
    if batched_at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(batched_at).cast("timestamp_ntz")


def mart_window(events: DataFrame, as_of: dt.date, incremental: bool,
                lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Exclude the incomplete ``as_of`` day; on incremental runs keep only the
    last ``lookback_days`` complete days (late-data repair window).

    Both bounds are literals, so on a date-partitioned source they become
    partition filters.
    """
    out = events.filter(F.col("event_date") <= F.lit(as_of - dt.timedelta(days=1)))
    if incremental:
        out = out.filter(F.col("event_date") >= F.lit(as_of - dt.timedelta(days=lookback_days)))
    return out


def contributor_trends(classified: DataFrame, as_of: dt.date, incremental: bool = False,
                       batched_at: dt.datetime | None = None,
                       lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Per day and contributor type: events and distinct actors."""
    ev = mart_window(classified.select("event_date", "actor_login", "contributor_type"),
                     as_of, incremental, lookback_days)
    return (ev.groupBy("event_date", "contributor_type")
              .agg(F.count(F.lit(1)).alias("event_count"),
                   F.countDistinct("actor_login").alias("unique_contributors"))
              .select("event_date", "contributor_type", "event_count", "unique_contributors",
                      _batched_at_col(batched_at).alias("_sdc_batched_at")))


def language_activity(enriched: DataFrame, as_of: dt.date, incremental: bool = False,
                      batched_at: dt.datetime | None = None,
                      lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Per day, language and contributor type: events, distinct actors and
    distinct repositories. Events without a language (or with the literal
    language ``unknown``) are removed.

    The filter rejects NULL metadata, so Catalyst turns the enrichment's left
    join into an inner join and pushes the language predicate into the
    (broadcast) metadata side. Events are first added up per actor and
    repository, so the two distinct counts double those rows and not the events.
    """
    ev = enriched.select(
        "event_date",
        F.coalesce(F.col("language"), F.lit(UNKNOWN_LANGUAGE)).alias("language"),
        "contributor_type", "actor_login", "repo_name")
    ev = mart_window(ev, as_of, incremental, lookback_days)
    ev = ev.filter(F.col("language") != UNKNOWN_LANGUAGE)
    pairs = ev.groupBy(*ev.columns).agg(F.count(F.lit(1)).alias("n"))
    return (pairs.groupBy("event_date", "language", "contributor_type")
              .agg(F.sum("n").alias("event_count"),
                   F.countDistinct("actor_login").alias("unique_contributors"),
                   F.countDistinct("repo_name").alias("unique_repos"))
              .select("event_date", "language", "contributor_type", "event_count",
                      "unique_contributors", "unique_repos",
                      _batched_at_col(batched_at).alias("_sdc_batched_at")))


def language_sets(enriched: DataFrame, actors: DataFrame,
                  repos: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """What a language mart needs to be merged exactly, from any part of a
    day's events: event counts per day, language and contributor type, and for
    each distinct count the sets of numbered values (``actors`` and ``repos``
    are tables of numbers). See :func:`language_from_sets`."""
    keys = schemas.LANGUAGE_KEYS
    ev = enriched.select(*keys, "actor_login", "repo_name").where(
        F.col("language") != UNKNOWN_LANGUAGE)
    ev = distinct_sets.numbered(ev, "actor_login", actors, "actor")
    ev = distinct_sets.numbered(ev, "repo_name", repos, "repo")
    return (ev.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count")),
            {"unique_contributors": distinct_sets.distinct_sets(ev, keys, "actor"),
             "unique_repos": distinct_sets.distinct_sets(ev, keys, "repo")})


def language_from_sets(counts: DataFrame, sets: dict, keys: Sequence[str],
                       batched_at: dt.datetime | None = None) -> DataFrame:
    """The language mart, or its roll-up to fewer ``keys``: counts are added,
    sets are joined, so distinct counts are true at every level."""
    groups = counts.groupBy(*keys).agg(F.sum("event_count").alias("event_count"))
    return (distinct_sets.with_counts(groups, keys, sets)
            .withColumn("_sdc_batched_at", _batched_at_col(batched_at)))


@dataclass(frozen=True)
class MartSpec:
    """A keyed incremental mart: its batch builder and its unique key."""

    name: str
    keys: tuple[str, ...]
    build: Callable[..., DataFrame]
    partition_column: str = "event_date"


TRENDS = MartSpec("contributor_trends", tuple(schemas.TRENDS_KEYS), contributor_trends)
LANGUAGE = MartSpec("language_activity", tuple(schemas.LANGUAGE_KEYS), language_activity)
