"""Serving queries over the marts: dashboard metrics, top-k lists, the metric
layer and pivoted chart series.

Every top-k adds the group key as a second sort key so results are
deterministic; every limit here is the feature itself (a top-k or a chart's
row cap) and is planned as TakeOrderedAndProject (bounded per-task heaps).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import percent_of
from tidewater.functions.columns import BOT, HUMAN


def summary_metrics(trends: DataFrame) -> DataFrame:
    """Totals, date range, human/bot split in percent, last update (one row)."""
    agg = trends.agg(
        F.sum("event_count").alias("total"),
        F.min("event_date").alias("min_date"),
        F.max("event_date").alias("max_date"),
        F.sum(F.when(F.col("contributor_type") == HUMAN, F.col("event_count")).otherwise(0)).alias("human"),
        F.sum(F.when(F.col("contributor_type") == BOT, F.col("event_count")).otherwise(0)).alias("bot"),
        F.max("_sdc_batched_at").alias("last_updated"),
    )
    return agg.select(
        F.coalesce("total", F.lit(0)).cast("bigint").alias("total_events"),
        "min_date", "max_date",
        F.coalesce("human", F.lit(0)).cast("bigint").alias("human_events"),
        F.coalesce("bot", F.lit(0)).cast("bigint").alias("bot_events"),
        percent_of(F.col("human"), F.col("total")).alias("pct_human"),
        percent_of(F.col("bot"), F.col("total")).alias("pct_bot"),
        "last_updated",
    )


def total_repos(language: DataFrame) -> DataFrame:
    """Sum of per-day, per-language distinct repositories (an over-count of
    distinct repositories by design: the mart no longer holds names)."""
    return language.agg(
        F.coalesce(F.sum("unique_repos"), F.lit(0)).cast("bigint").alias("total_unique_repos"))


def top_by_sum(df: DataFrame, key: str, value: str, alias: str, n: int) -> DataFrame:
    return (df.groupBy(key).agg(F.sum(value).alias(alias))
              .orderBy(F.desc(alias), F.asc(key)).limit(n))


def top_languages(language: DataFrame, n: int = 5) -> DataFrame:
    return top_by_sum(language, "language", "event_count", "total_push_events", n)


def top_languages_by_repos(language: DataFrame, n: int = 5) -> DataFrame:
    return top_by_sum(language, "language", "unique_repos", "total_unique_repos", n)


def top_bot_repos(classified: DataFrame, n: int = 100) -> DataFrame:
    """Repositories with the most bot pushes (the enrichment request list)."""
    return (classified.filter(F.col("contributor_type") == BOT)
                      .groupBy("repo_name").agg(F.count(F.lit(1)).alias("bot_push_count"))
                      .orderBy(F.desc("bot_push_count"), F.asc("repo_name")).limit(n))


# -- metric layer -------------------------------------------------------------

@dataclass(frozen=True)
class Metric:
    name: str
    column: str
    kind: str = "sum"

    def expr(self) -> Column:
        if self.kind != "sum":
            raise ValueError(f"unsupported metric kind {self.kind}")
        return F.sum(self.column).alias(self.name)


# The metrics declared over the language-activity mart.
LANGUAGE_METRICS = {
    "total_events": Metric("total_events", "event_count"),
    "total_unique_contributors": Metric("total_unique_contributors", "unique_contributors"),
    "total_unique_repos": Metric("total_unique_repos", "unique_repos"),
}
LANGUAGE_DIMENSIONS = ("event_date", "language", "contributor_type")


@dataclass(frozen=True)
class Sort:
    field: str
    descending: bool = False


@dataclass(frozen=True)
class Filter:
    """Rows whose dimension is (or, excluded, is not) one of the values."""

    field: str
    values: tuple
    exclude: bool = False

    def condition(self) -> Column:
        chosen = F.coalesce(F.col(self.field).isin(*self.values), F.lit(False))
        return ~chosen if self.exclude else chosen


def metric_query(df: DataFrame, dimensions: Sequence[str], metrics: Sequence[str],
                 sorts: Sequence[Sort] = (), limit: int | None = None,
                 filters: Sequence[Filter] = (),
                 catalog: dict[str, Metric] = LANGUAGE_METRICS,
                 allowed_dimensions: Sequence[str] = LANGUAGE_DIMENSIONS) -> DataFrame:
    """Filter on dimensions, aggregate chosen metrics over chosen dimensions,
    sort, limit.

    Sort keys not named explicitly are appended (dimensions ascending) so that
    a limit always cuts a total order.
    """
    for d in [*dimensions, *(f.field for f in filters)]:
        if d not in allowed_dimensions:
            raise ValueError(f"unknown dimension {d}")
    for f in filters:
        df = df.where(f.condition())
    out = df.groupBy(*dimensions).agg(*[catalog[m].expr() for m in metrics])
    order = [F.desc(s.field) if s.descending else F.asc(s.field) for s in sorts]
    named = {s.field for s in sorts}
    order += [F.asc(d) for d in dimensions if d not in named]
    out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def pivot_series(long: DataFrame, index: str, pivot: str, value: str,
                 values: Sequence[str] | None = None) -> DataFrame:
    """One column per pivot value. Without a list the values are those of the
    rows themselves (a chart's rows, limited by its own query), in order; more
    of them than ``spark.sql.pivotMaxValues`` are refused."""
    if values is None:
        most = int(long.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = long.select(pivot).distinct().orderBy(pivot).limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{pivot} has more than {most} values, too many for columns")
        values = [r[0] for r in found]
    return (long.groupBy(index).pivot(pivot, list(values)).agg(F.sum(value))
                .orderBy(index))


def contributor_trends_series(trends: DataFrame, limit: int | None = None) -> DataFrame:
    """Chart rows: SUM(event_count) per day, one series per contributor type,
    date ascending. A limit keeps the newest rows."""
    rows = trends if limit is None else trends.orderBy(
        F.desc("event_date"), "contributor_type").limit(limit)
    return pivot_series(rows, "event_date", "contributor_type", "event_count", [BOT, HUMAN])


def select_all_limited(df: DataFrame, order: Sequence[Column | str],
                       limit: int | None = None) -> DataFrame:
    """Star projection in a total order, the first ``limit`` rows of it."""
    out = df.select("*").orderBy(*order)
    return out if limit is None else out.limit(limit)
