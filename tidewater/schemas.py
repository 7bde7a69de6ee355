"""Declared shapes. Every read uses one of these; nothing is inferred.

Struct fields are resolved *by name* when JSON is parsed against these
schemas, so key order inside the source objects does not matter and unknown
keys are dropped.
"""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The nested shapes of the lake events table.
ACTOR = StructType([
    StructField("id", LongType()),
    StructField("login", StringType()),
    StructField("display_login", StringType()),
    StructField("gravatar_id", StringType()),
    StructField("url", StringType()),
    StructField("avatar_url", StringType()),
])

REPO = StructType([
    StructField("id", LongType()),
    StructField("name", StringType()),
    StructField("url", StringType()),
])

ORG = StructType([
    StructField("id", LongType()),
    StructField("login", StringType()),
    StructField("gravatar_id", StringType()),
    StructField("url", StringType()),
    StructField("avatar_url", StringType()),
])

# Read schema of one raw event line for the lake load. ``payload`` is declared
# as a string: the parser hands back the object's JSON text, so JSON nulls and
# key order survive and every event type fits one column.
LAKE_EVENT_JSON = StructType([
    StructField("id", StringType()),
    StructField("type", StringType()),
    StructField("actor", ACTOR),
    StructField("repo", REPO),
    StructField("payload", StringType()),
    StructField("public", BooleanType()),
    StructField("created_at", StringType()),
    StructField("org", ORG),
])

# Lake events table (8 columns) plus the derived day partition column.
LAKE_EVENTS = StructType([
    StructField("id", StringType()),
    StructField("type", StringType()),
    StructField("actor", ACTOR),
    StructField("repo", REPO),
    StructField("payload", StringType()),
    StructField("public", BooleanType()),
    StructField("created_at", TimestampType()),
    StructField("org", ORG),
])
LAKE_PARTITION_COLUMN = "created_date"

# Narrow read schema for the staging model: only the paths it extracts.
STG_EVENT_JSON = StructType([
    StructField("id", StringType()),
    StructField("type", StringType()),
    StructField("actor", StructType([
        StructField("login", StringType()),
        StructField("type", StringType()),
    ])),
    StructField("repo", StructType([StructField("name", StringType())])),
    StructField("created_at", StringType()),
])

# One repository metadata record as written to the snapshot files.
REPO_RECORD_JSON = StructType([
    StructField("full_name", StringType()),
    StructField("language", StringType()),
    StructField("topics", ArrayType(StringType())),
    StructField("stargazers_count", IntegerType()),
    StructField("forks_count", IntegerType()),
    StructField("is_fork", BooleanType()),
    StructField("created_at", StringType()),
    StructField("description", StringType()),
])

# The same record as returned by the hosting API (``fork`` instead of
# ``is_fork``; ``topics`` may be absent).
API_REPO_JSON = StructType([
    StructField("full_name", StringType()),
    StructField("language", StringType()),
    StructField("topics", ArrayType(StringType())),
    StructField("stargazers_count", IntegerType()),
    StructField("forks_count", IntegerType()),
    StructField("fork", BooleanType()),
    StructField("created_at", StringType()),
    StructField("description", StringType()),
])

# Raw event table as landed: one JSON text per line plus path partitions.
RAW_EVENTS = StructType([
    StructField("event_date", DateType()),
    StructField("event_hour", IntegerType()),
    StructField("raw_event", StringType()),
])

RAW_REPOS = StructType([
    StructField("enriched_date", DateType()),
    StructField("value", StringType()),
])

# Model column contracts (order matters for the outputs).
STG_EVENTS_COLUMNS = ["event_date", "event_hour", "event_id", "event_type",
                      "actor_login", "actor_type", "repo_name", "created_at"]
STG_REPO_COLUMNS = ["repo_full_name", "language", "topics", "stargazers_count",
                    "forks_count", "is_fork", "repo_created_at", "description",
                    "enriched_date"]
CLASSIFIED_COLUMNS = ["event_date", "event_hour", "event_id", "event_type",
                      "created_at", "actor_login", "actor_type", "repo_name",
                      "is_bot", "contributor_type"]
ENRICHED_COLUMNS = CLASSIFIED_COLUMNS + ["language", "topics"]
TRENDS_KEYS = ["event_date", "contributor_type"]
LANGUAGE_KEYS = ["event_date", "language", "contributor_type"]
