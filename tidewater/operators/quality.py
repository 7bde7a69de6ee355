"""Declarative data-quality checks.

All rules of one model are evaluated in a single aggregation pass (one
``count_if`` per rule inside one ``agg``); a ``unique`` rule adds one
group-by whose partial aggregation runs map-side. Output: one row per rule
with the number of failures. The rows that fail are had from
:func:`dq_violations`, and :func:`counters` puts the same rules into a write.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    column: str
    rule: str  # not_null | unique | accepted_values
    values: tuple[str, ...] = ()


def not_null(*cols: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in cols]


def accepted(col: str, *values: str) -> Rule:
    return Rule(col, "accepted_values", tuple(values))


# The declared tests per model.
RULES: dict[str, list[Rule]] = {
    "stg_events": not_null("event_date", "event_hour", "event_id", "event_type"),
    "stg_repo_metadata": [Rule("repo_full_name", "not_null"), Rule("repo_full_name", "unique"),
                          Rule("enriched_date", "not_null")],
    "events_classified": not_null("event_date", "event_hour", "event_id", "event_type")
    + [accepted("event_type", "PushEvent")]
    + not_null("is_bot", "contributor_type") + [accepted("contributor_type", "human", "bot")],
    "events_enriched": not_null("event_date", "event_hour", "event_id", "event_type",
                                "is_bot", "contributor_type")
    + [accepted("contributor_type", "human", "bot")],
    "contributor_trends": not_null("event_date", "contributor_type")
    + [accepted("contributor_type", "human", "bot")]
    + not_null("event_count", "unique_contributors"),
    "language_activity": not_null("event_date", "language", "contributor_type")
    + [accepted("contributor_type", "human", "bot")]
    + not_null("event_count", "unique_contributors", "unique_repos"),
}


def breaks(r: Rule) -> Column:
    """Whether a row breaks a row rule (null: it doesn't)."""
    c = F.col(r.column)
    if r.rule == "not_null":
        return c.isNull()
    if r.rule == "accepted_values":
        # NULL passes (NOT IN over NULL is unknown, not a failure).
        return ~c.isin(*r.values)
    raise ValueError(r.rule)


def counters(rules: Sequence[Rule]) -> dict[str, Column]:
    """Failures of each row rule as an aggregate, for ``observe``."""
    return {f"{r.rule}({r.column})": F.count_if(breaks(r)) for r in rules if r.rule != "unique"}


def dq_check(df: DataFrame, model: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """``(model, column_name, rule, failures)`` for every rule of ``model``."""
    rules = list(RULES[model] if rules is None else rules)
    row_rules = [r for r in rules if r.rule != "unique"]
    parts = []
    if row_rules:
        structs = [F.struct(F.lit(model).alias("model"), F.lit(r.column).alias("column_name"),
                            F.lit(r.rule).alias("rule"),
                            F.count_if(breaks(r)).cast("bigint").alias("failures"))
                   for r in row_rules]
        parts.append(df.agg(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    for r in rules:
        if r.rule == "unique":
            dup = (df.filter(F.col(r.column).isNotNull()).groupBy(r.column).count()
                     .filter(F.col("count") > 1))
            parts.append(dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
                F.lit(model).alias("model"), F.lit(r.column).alias("column_name"),
                F.lit("unique").alias("rule"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_violations(df: DataFrame, model: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``df`` that break a rule of ``model``, once per broken rule,
    after ``model``, ``column_name`` and ``rule``.

    Row rules are one pass: an array of the broken ones per row, unnested. A
    ``unique`` rule gives every row whose value is repeated: the repeated
    values, found map-side first, are joined back. Rows without a violation
    are dropped before anything is shuffled.
    """
    rules = list(RULES[model] if rules is None else rules)

    def name(r: Rule) -> Column:
        return F.struct(F.lit(r.column).alias("column_name"), F.lit(r.rule).alias("rule"))
    row_rules = [r for r in rules if r.rule != "unique"]
    broken = F.filter(F.array(*[F.when(breaks(r), name(r)) for r in row_rules]),
                      lambda b: b.isNotNull())
    found = df.select(*df.columns, F.explode(broken).alias("_broken")) if row_rules else \
        df.select(*df.columns, F.lit(None).cast(
            "struct<column_name: string, rule: string>").alias("_broken")).limit(0)
    for r in rules:
        if r.rule == "unique":
            repeated = (df.where(F.col(r.column).isNotNull()).groupBy(F.col(r.column).alias("_value"))
                        .count().where("count > 1").select("_value"))
            found = found.unionByName(
                df.join(repeated, df[r.column] == repeated["_value"], "left_semi")
                .select(*df.columns, name(r).alias("_broken")))
    return found.select(F.lit(model).alias("model"), "_broken.*", *df.columns)
