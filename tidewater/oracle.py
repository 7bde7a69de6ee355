"""Independent SQL (DuckDB dialect) for every registered query.

Each statement runs on the driver's pre-registered parquet views and must
return the same rows, column names and values as the Spark job of the same
key. Shared layers are written once as CTEs and pulled in by dependency.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INT)"

# The actor type and the login patterns that mark an automated actor.
BOT_TYPE = "Bot"
BOT_LOGINS = ["%[bot]%", "%-bot", "%-ci", "%-automation"]
BOT_CASE = ("(coalesce(actor_type, '') = '" + BOT_TYPE + "' OR len(list_filter("
            + str(BOT_LOGINS) + ", lambda p: lower(coalesce(actor_login, '')) LIKE p)) > 0)")

AS_OF = "DATE '2024-01-30'"
BATCHED_AT = "2024-01-30 06:00:00"

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (sql.replace("{K}", K).replace("{BOT}", BOT_CASE), deps)


_cte("raw_ev", """
SELECT CAST(ts AS DATE) AS event_date,
       CAST(EXTRACT(hour FROM ts) AS INT) AS event_hour,
       '{"id":"' || CAST(event_id AS VARCHAR)
       || '","type":"' || CASE event_type
            WHEN 'click' THEN 'PushEvent' WHEN 'purchase' THEN 'PullRequestEvent'
            WHEN 'error' THEN 'IssuesEvent' WHEN 'signup' THEN 'CreateEvent'
            ELSE 'WatchEvent' END
       || '","actor":{"login":"' || CASE user_id % 10
            WHEN 0 THEN 'user' || CAST(user_id AS VARCHAR) || '[bot]'
            WHEN 1 THEN 'user' || CAST(user_id AS VARCHAR) || '-bot'
            WHEN 2 THEN 'User' || CAST(user_id AS VARCHAR) || '-CI'
            WHEN 3 THEN 'user' || CAST(user_id AS VARCHAR) || '-automation'
            WHEN 4 THEN 'user' || CAST(user_id AS VARCHAR) || '-bots'
            WHEN 5 THEN 'ci-user' || CAST(user_id AS VARCHAR)
            ELSE 'user' || CAST(user_id AS VARCHAR) END || '"'
       || CASE user_id % 10 WHEN 6 THEN ',"type":"Bot"' WHEN 7 THEN ',"type":null'
            WHEN 8 THEN '' ELSE ',"type":"User"' END
       || '},"repo":{"name":"' || CASE WHEN {K} = 13 THEN 'repo13'
            ELSE 'org' || CAST({K} % 7 AS VARCHAR) || '/repo' || CAST({K} AS VARCHAR) END
       || '"},"created_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z"}' AS raw_event
FROM events""")

_cte("stg", """
SELECT event_date, event_hour,
       json_extract_string(raw_event, '$.id') AS event_id,
       json_extract_string(raw_event, '$.type') AS event_type,
       json_extract_string(raw_event, '$.actor.login') AS actor_login,
       json_extract_string(raw_event, '$.actor.type') AS actor_type,
       json_extract_string(raw_event, '$.repo.name') AS repo_name,
       CAST(json_extract_string(raw_event, '$.created_at') AS TIMESTAMP) AS created_at
FROM raw_ev""", "raw_ev")

_cte("classified", """
SELECT event_date, event_hour, event_id, event_type, created_at, actor_login, actor_type,
       repo_name,
       CASE WHEN {BOT} THEN TRUE ELSE FALSE END AS is_bot,
       CASE WHEN {BOT} THEN 'bot' ELSE 'human' END AS contributor_type
FROM stg WHERE event_type = 'PushEvent'""", "stg")

_cte("raw_repo", """
SELECT CASE p_size % 4 WHEN 0 THEN DATE '2024-01-07' WHEN 1 THEN DATE '2024-01-14'
            WHEN 2 THEN DATE '2024-01-21' ELSE DATE '2024-01-28' END AS enriched_date,
       '{"full_name":"org' || CAST((p_partkey % 90) % 7 AS VARCHAR)
       || '/repo' || CAST(p_partkey % 90 AS VARCHAR)
       || '","language":' || CASE WHEN p_partkey % 90 = 17 THEN '"unknown"'
            WHEN p_type = 'ECONOMY' THEN '"Python"' WHEN p_type = 'LARGE' THEN '"JavaScript"'
            WHEN p_type = 'MEDIUM' THEN '"Go"' WHEN p_type = 'SMALL' THEN '"Rust"'
            WHEN p_type = 'STANDARD' THEN '"TypeScript"' ELSE 'null' END
       || ',"topics":["' || lower(p_type) || '","' || p_brand || '"]'
       || ',"stargazers_count":' || CAST(p_size * 100 AS VARCHAR)
       || ',"forks_count":' || CAST(p_size AS VARCHAR)
       || ',"is_fork":' || CASE WHEN p_partkey % 5 = 0 THEN 'true' ELSE 'false' END
       || ',"created_at":"2020-01-01T00:00:00Z"'
       || ',"description":' || CASE WHEN p_partkey % 11 = 0 THEN 'null'
            ELSE '"' || p_name || '"' END || '}' AS value
FROM part""")

_cte("repo_typed", """
SELECT json_extract_string(value, '$.full_name') AS repo_full_name,
       json_extract_string(value, '$.language') AS language,
       CAST(json_extract(value, '$.topics') AS VARCHAR[]) AS topics,
       CAST(json_extract_string(value, '$.stargazers_count') AS INTEGER) AS stargazers_count,
       CAST(json_extract_string(value, '$.forks_count') AS INTEGER) AS forks_count,
       CAST(json_extract_string(value, '$.is_fork') AS BOOLEAN) AS is_fork,
       CAST(json_extract_string(value, '$.created_at') AS TIMESTAMP) AS repo_created_at,
       json_extract_string(value, '$.description') AS description,
       enriched_date,
       value
FROM raw_repo""", "raw_repo")

_cte("repo_latest", """
SELECT repo_full_name, language, topics, stargazers_count, forks_count, is_fork,
       repo_created_at, description, enriched_date
FROM repo_typed
QUALIFY row_number() OVER (PARTITION BY repo_full_name
                           ORDER BY enriched_date DESC NULLS FIRST, value ASC) = 1""",
     "repo_typed")

_cte("enriched", """
SELECT c.event_date, c.event_hour, c.event_id, c.event_type, c.created_at, c.actor_login,
       c.actor_type, c.repo_name, c.is_bot, c.contributor_type, m.language, m.topics,
       m.repo_full_name IS NOT NULL AS matched
FROM classified c LEFT JOIN repo_latest m ON c.repo_name = m.repo_full_name""",
     "classified", "repo_latest")


def trends_sql(where: str, batched_at: str, source: str = "classified") -> str:
    """Rows per actor first: their sum is the events, their number the actors."""
    return f"""
SELECT event_date, contributor_type, CAST(SUM(pushes) AS BIGINT) AS event_count,
       COUNT(actor_login) AS unique_contributors, TIMESTAMP '{batched_at}' AS _sdc_batched_at
FROM (SELECT event_date, contributor_type, actor_login, COUNT(*) AS pushes
      FROM {source} WHERE {where} GROUP BY ALL) per_actor
GROUP BY event_date, contributor_type"""


def lang_sql(where: str, batched_at: str, source: str = "enriched") -> str:
    """Rows per actor and repository first, then the sizes of both sets."""
    return f"""
SELECT event_date, language, contributor_type, CAST(SUM(pushes) AS BIGINT) AS event_count,
       len(list_distinct(list(actor_login))) AS unique_contributors,
       len(list_distinct(list(repo_name))) AS unique_repos,
       TIMESTAMP '{batched_at}' AS _sdc_batched_at
FROM (SELECT event_date, language, contributor_type, actor_login, repo_name, COUNT(*) AS pushes
      FROM {source} WHERE language <> 'unknown' AND {where} GROUP BY ALL) per_pair
GROUP BY event_date, language, contributor_type"""


_cte("trends", trends_sql(f"event_date < {AS_OF}", BATCHED_AT), "classified")
_cte("lang", lang_sql(f"event_date < {AS_OF}", BATCHED_AT), "enriched")


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the named CTEs and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS ({_CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


ORACLE: dict[str, str] = {}


def register(key: str, body: str, *needed: str) -> None:
    ORACLE[key] = with_ctes(body.replace("{K}", K).replace("{BOT}", BOT_CASE), *needed)


register("raw_event_scan", "SELECT event_date, event_hour, raw_event FROM raw_ev", "raw_ev")
register("stg_events", "SELECT * FROM stg", "stg")
register("push_events", "SELECT * FROM stg WHERE event_type = 'PushEvent'", "stg")
register("events_classified", "SELECT * FROM classified", "classified")
register("contributor_trends", "SELECT * FROM trends", "trends")

_cte("lake_lines", """
SELECT '{"id":"' || CAST(event_id AS VARCHAR) || '","type":"' || event_type
       || '","actor":{"url":"u' || CAST(user_id AS VARCHAR)
       || '","login":"user' || CAST(user_id AS VARCHAR)
       || '","display_login":"D' || CAST(user_id AS VARCHAR)
       || '","gravatar_id":"","zzz_extra":1,"avatar_url":"a' || CAST(user_id AS VARCHAR)
       || '","id":' || CAST(user_id AS VARCHAR)
       || '},"repo":{"id":' || CAST({K} AS VARCHAR) || ',"name":"org/repo'
       || CAST({K} AS VARCHAR) || '","url":"r"},"payload":' || props
       || ',"public":' || CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END
       || ',"created_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z"'
       || CASE WHEN user_id % 3 = 0 THEN ''
            ELSE ',"org":{"id":' || CAST(user_id % 3 AS VARCHAR)
                 || ',"login":"o","gravatar_id":"","url":"ou","avatar_url":"oa"}' END
       || '}' AS line
FROM events""")

_cte("lake", """
SELECT json_extract_string(line, '$.id') AS id,
       json_extract_string(line, '$.type') AS type,
       CAST(json_extract_string(line, '$.actor.id') AS BIGINT) AS actor_id,
       json_extract_string(line, '$.actor.login') AS actor_login,
       json_extract_string(line, '$.actor.display_login') AS actor_display_login,
       json_extract_string(line, '$.actor.gravatar_id') AS actor_gravatar_id,
       json_extract_string(line, '$.actor.url') AS actor_url,
       json_extract_string(line, '$.actor.avatar_url') AS actor_avatar_url,
       CAST(json_extract_string(line, '$.repo.id') AS BIGINT) AS repo_id,
       json_extract_string(line, '$.repo.name') AS repo_name,
       json_extract_string(line, '$.repo.url') AS repo_url,
       CAST(json_extract(line, '$.payload') AS VARCHAR) AS payload,
       CAST(json_extract_string(line, '$.public') AS BOOLEAN) AS public,
       CAST(json_extract_string(line, '$.created_at') AS TIMESTAMP) AS created_at,
       CAST(json_extract_string(line, '$.org.id') AS BIGINT) AS org_id,
       json_extract_string(line, '$.org.login') AS org_login,
       json_extract_string(line, '$.org.gravatar_id') AS org_gravatar_id,
       json_extract_string(line, '$.org.url') AS org_url,
       json_extract_string(line, '$.org.avatar_url') AS org_avatar_url
FROM lake_lines""", "lake_lines")

_cte("api", """
SELECT enriched_date,
       replace(replace(value, '"is_fork":', '"fork":'), ',"topics":["promo","Brand#7"]', '')
         AS value
FROM raw_repo""", "raw_repo")

_cte("api_proj", """
SELECT json_extract_string(value, '$.full_name') AS full_name,
       json_extract_string(value, '$.language') AS language,
       CASE WHEN list_contains(json_keys(value), 'topics')
            THEN CAST(json_extract(value, '$.topics') AS VARCHAR[])
            ELSE CAST([] AS VARCHAR[]) END AS topics,
       CAST(json_extract_string(value, '$.stargazers_count') AS INTEGER) AS stargazers_count,
       CAST(json_extract_string(value, '$.forks_count') AS INTEGER) AS forks_count,
       CAST(json_extract_string(value, '$.fork') AS BOOLEAN) AS is_fork,
       json_extract_string(value, '$.created_at') AS created_at,
       json_extract_string(value, '$.description') AS description,
       enriched_date
FROM api""", "api")

_cte("metric", """
SELECT event_date, language, CAST(SUM(event_count) AS BIGINT) AS total_events
FROM lang GROUP BY event_date, language
ORDER BY event_date DESC, language ASC LIMIT 500""", "lang")


def merge_sql(first: str, batch: str, keys: list[str]) -> str:
    """Keyed delete+insert: first-run rows whose key is absent from the batch,
    plus the batch."""
    cond = " AND ".join(f"b.{k} = f.{k}" for k in keys)
    return (f"SELECT * FROM ({first}) f WHERE NOT EXISTS "
            f"(SELECT 1 FROM ({batch}) b WHERE {cond}) "
            f"UNION ALL SELECT * FROM ({batch}) b2")


LATE_FIRST = "event_hour < 22 AND event_date <= DATE '2024-01-26'"
LATE_BATCH = "event_date BETWEEN DATE '2024-01-25' AND DATE '2024-01-27'"
AT_0127, AT_0128 = "2024-01-27 06:00:00", "2024-01-28 06:00:00"
TKEYS = ["event_date", "contributor_type"]
LKEYS = ["event_date", "language", "contributor_type"]
SERVE_RANGE = ("created_at >= TIMESTAMP '2024-01-01 00:00:00' "
               "AND created_at < TIMESTAMP '2024-01-15 00:00:00'")


def _file_key(day: str, hour: str) -> str:
    return (f"'raw/events/event_date=' || strftime({day}, '%Y-%m-%d') || '/event_hour=' || "
            f"CAST({hour} AS VARCHAR) || '/' || strftime({day}, '%Y-%m-%d') || '-' || "
            f"CAST({hour} AS VARCHAR) || '.json.gz'")


register("path_partitions", """
SELECT CASE WHEN up THEN 'uploads/batch_1' ELSE 'event_date=' || strftime(event_date, '%Y-%m-%d')
            || '/event_hour=' || CAST(event_hour AS VARCHAR) END AS folder,
       CASE WHEN up THEN NULL ELSE event_date END AS event_date,
       CASE WHEN up THEN NULL ELSE event_hour END AS event_hour,
       COUNT(*) AS n_events, TRUE AS has_time
FROM (SELECT event_date, event_hour,
             CAST(json_extract_string(raw_event, '$.id') AS BIGINT) % 97 = 0 AS up FROM raw_ev) f
GROUP BY 1, 2, 3""", "raw_ev")
register("raw_event_variant", """
SELECT *, CAST(NULL AS VARCHAR) AS broken_line FROM stg
UNION ALL
SELECT event_date, event_hour, NULL, NULL, NULL, NULL, NULL, NULL, left(raw_event, 25)
FROM raw_ev WHERE CAST(json_extract_string(raw_event, '$.id') AS BIGINT) % 50 = 0""",
         "stg", "raw_ev")
register("repo_snapshot_scan", """
SELECT enriched_date, repo_full_name AS full_name, language, topics, stargazers_count,
       forks_count, is_fork, repo_created_at AS created_at, description
FROM repo_typed""", "repo_typed")
register("date_range_scan", """
SELECT event_date, event_hour, raw_event FROM raw_ev
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'""", "raw_ev")
register("normalize_nested_events", "SELECT * FROM lake", "lake")
register("missing_dates", """
SELECT CAST(d AS DATE) AS missing_date
FROM generate_series(TIMESTAMP '2023-12-30 00:00:00', TIMESTAMP '2024-02-02 00:00:00',
                     INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events
                              WHERE ts IS NOT NULL)""")
register("time_range_scan", """
SELECT id, type, created_at FROM lake
WHERE created_at >= TIMESTAMP '2024-01-03 00:00:00'
  AND created_at < TIMESTAMP '2024-01-10 00:00:00'""", "lake")
register("stg_repo_metadata_typed", """
SELECT repo_full_name, language, topics, stargazers_count, forks_count, is_fork,
       repo_created_at, description, enriched_date
FROM repo_typed""", "repo_typed")
register("stg_repo_metadata", "SELECT * FROM repo_latest", "repo_latest")
register("payload_extract", """
SELECT id, CAST(json_extract_string(payload, '$.k') AS INTEGER) AS payload_k
FROM lake""", "lake")
register("repo_name_split", """
SELECT repo_name,
       substr(repo_name, 1, strpos(repo_name, '/') - 1) AS owner,
       substr(repo_name, strpos(repo_name, '/') + 1) AS repo
FROM (SELECT repo_name, COUNT(*) AS bot_push_count FROM classified
      WHERE contributor_type = 'bot' GROUP BY repo_name
      ORDER BY bot_push_count DESC, repo_name ASC LIMIT 100) t
WHERE strpos(repo_name, '/') > 0""", "classified")
register("repo_record_projection", "SELECT * FROM api_proj", "api_proj")
register("previous_hour", """
SELECT event_id, date_trunc('hour', ts - INTERVAL 1 HOUR) AS target_hour FROM events""")
register("landing_key", """
SELECT event_id, """ + _file_key("h", "hour(h)") + """ AS landing_key
FROM (SELECT event_id, date_trunc('hour', ts - INTERVAL 1 HOUR) AS h FROM events) t""")
register("events_enriched", """
SELECT event_date, event_hour, event_id, event_type, created_at, actor_login, actor_type,
       repo_name, is_bot, contributor_type, language, topics
FROM enriched""", "enriched")
register("enrichment_coverage", """
SELECT COUNT(*) AS total_events,
       COUNT(*) FILTER (WHERE matched) AS matched_events,
       COUNT(*) FILTER (WHERE NOT matched) AS unmatched_events,
       COUNT(*) FILTER (WHERE language IS NULL) AS null_language_events
FROM enriched""", "enriched")
register("language_activity", "SELECT * FROM lang", "lang")
register("language_activity_sets", "SELECT * FROM lang", "lang")
register("distinct_over_range", """
SELECT language, COUNT(*) AS event_count,
       COUNT(DISTINCT actor_login) AS unique_contributors,
       COUNT(DISTINCT repo_name) AS unique_repos,
       (SELECT CAST(SUM(unique_repos) AS BIGINT) FROM lang l WHERE l.language = e.language
        AND l.event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11') AS summed_repos
FROM enriched e
WHERE language <> 'unknown' AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'
GROUP BY language""", "enriched", "lang")
register("stream_notified_files", "SELECT * FROM stg", "stg")
register("scheduled_build_trends", "SELECT * FROM trends", "trends")
register("scheduled_build_language", "SELECT * FROM lang", "lang")
register("trends_lookback_batch",
         trends_sql("event_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'",
                    "2024-01-30 06:00:00"), "classified")
register("language_lookback_batch",
         lang_sql("event_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'",
                  "2024-01-30 06:00:00"), "enriched")
register("trends_late_data_repair",
         merge_sql(trends_sql(LATE_FIRST, AT_0127), trends_sql(LATE_BATCH, AT_0128), TKEYS),
         "classified")
register("trends_delete_insert",
         merge_sql(trends_sql(LATE_FIRST, AT_0127),
                   trends_sql(LATE_BATCH + " AND NOT (event_date = DATE '2024-01-26' "
                              "AND contributor_type = 'bot')", AT_0128), TKEYS),
         "classified")
register("trends_full_then_incremental",
         merge_sql(trends_sql("event_date <= DATE '2024-01-19'", "2024-01-20 06:00:00"),
                   trends_sql("event_date BETWEEN DATE '2024-01-20' AND DATE '2024-01-29'",
                              "2024-01-30 06:00:00"), TKEYS),
         "classified")
register("language_delete_insert",
         merge_sql(lang_sql(LATE_FIRST, AT_0127), lang_sql(LATE_BATCH, AT_0128), LKEYS),
         "enriched")
register("schema_sync",
         merge_sql("SELECT event_date, contributor_type, event_count, "
                   "CAST(NULL AS BIGINT) AS unique_contributors, _sdc_batched_at FROM ("
                   + trends_sql(LATE_FIRST, AT_0127) + ") s",
                   trends_sql(LATE_BATCH, AT_0128), TKEYS),
         "classified")
register("summary_metrics", """
SELECT CAST(COALESCE(SUM(event_count), 0) AS BIGINT) AS total_events,
       MIN(event_date) AS min_date, MAX(event_date) AS max_date,
       CAST(COALESCE(SUM(CASE WHEN contributor_type = 'human' THEN event_count ELSE 0 END), 0)
            AS BIGINT) AS human_events,
       CAST(COALESCE(SUM(CASE WHEN contributor_type = 'bot' THEN event_count ELSE 0 END), 0)
            AS BIGINT) AS bot_events,
       CASE WHEN COALESCE(SUM(event_count), 0) > 0
            THEN round(COALESCE(SUM(CASE WHEN contributor_type = 'human' THEN event_count
                                         ELSE 0 END), 0) / SUM(event_count) * 100, 1)
            ELSE 0.0 END AS pct_human,
       CASE WHEN COALESCE(SUM(event_count), 0) > 0
            THEN round(COALESCE(SUM(CASE WHEN contributor_type = 'bot' THEN event_count
                                         ELSE 0 END), 0) / SUM(event_count) * 100, 1)
            ELSE 0.0 END AS pct_bot,
       MAX(_sdc_batched_at) AS last_updated
FROM trends""", "trends")
register("total_repos", """
SELECT CAST(COALESCE(SUM(unique_repos), 0) AS BIGINT) AS total_unique_repos FROM lang""",
         "lang")
register("top_languages", """
SELECT language, CAST(SUM(event_count) AS BIGINT) AS total_push_events FROM lang
GROUP BY language ORDER BY total_push_events DESC, language ASC LIMIT 5""", "lang")
register("top_languages_by_repos", """
SELECT language, CAST(SUM(unique_repos) AS BIGINT) AS total_unique_repos FROM lang
GROUP BY language ORDER BY total_unique_repos DESC, language ASC LIMIT 5""", "lang")
register("top_bot_repos", """
SELECT repo_name, COUNT(*) AS bot_push_count FROM classified
WHERE contributor_type = 'bot' GROUP BY repo_name
ORDER BY bot_push_count DESC, repo_name ASC LIMIT 100""", "classified")
register("metric_query_language_day", "SELECT * FROM metric", "metric")
# The languages of the repository snapshots that reach the mart.
SERIES = ["Go", "JavaScript", "Python", "Rust", "TypeScript"]
register("language_day_pivot", "SELECT event_date, " + ", ".join(
    f"CAST(SUM(total_events) FILTER (WHERE language = '{name}') AS BIGINT) AS \"{name}\""
    for name in SERIES) + " FROM metric GROUP BY event_date", "metric")
register("metric_query_filtered", """
SELECT event_date, language, CAST(SUM(event_count) AS BIGINT) AS total_events,
       CAST(SUM(unique_repos) AS BIGINT) AS total_unique_repos
FROM lang WHERE language IN ('Go', 'Python') AND contributor_type <> 'bot'
GROUP BY event_date, language""", "lang")
register("contributor_trends_chart", """
SELECT event_date,
       CAST(SUM(CASE WHEN contributor_type = 'bot' THEN event_count END) AS BIGINT) AS bot,
       CAST(SUM(CASE WHEN contributor_type = 'human' THEN event_count END) AS BIGINT) AS human
FROM trends GROUP BY event_date""", "trends")
register("contributor_trends_select", """
SELECT * FROM trends ORDER BY event_date DESC, contributor_type LIMIT 500""", "trends")
register("events_per_day", """
SELECT CAST(created_at AS DATE) AS event_date, COUNT(*) AS event_count FROM lake
WHERE """ + SERVE_RANGE + """ GROUP BY 1 ORDER BY 1""", "lake")
register("top_event_types", """
SELECT type, COUNT(*) AS event_count FROM lake WHERE """ + SERVE_RANGE + """
GROUP BY type ORDER BY event_count DESC, type ASC LIMIT 10""", "lake")
register("row_count", "SELECT COUNT(*) AS row_count FROM lake", "lake")
register("clustered_time_lookup", """
SELECT id, repo_name, created_at FROM lake
WHERE created_at >= TIMESTAMP '2024-01-09 14:00:00'
  AND created_at < TIMESTAMP '2024-01-09 17:00:00'""", "lake")
register("clustered_point_lookup", """
SELECT id, type, CAST(created_at AS DATE) AS created_date FROM lake
WHERE repo_name = 'org/repo42'""", "lake")
register("sql_functions", """
SELECT event_date, """ + _file_key("h", "hour(h)") + """ AS file_before, COUNT(*) AS pushes,
       COUNT(*) FILTER (WHERE is_bot) AS bot_pushes,
       round(COUNT(*) FILTER (WHERE is_bot) / COUNT(*) * 100, 1) AS pct_bot
FROM (SELECT *, date_trunc('hour', created_at - INTERVAL 1 HOUR) AS h FROM classified) c
GROUP BY 1, 2""", "classified")
register("load_events_overwrite", """
SELECT id, type, actor_login, repo_name, payload, public, created_at, org_id,
       CAST(created_at AS DATE) AS created_date
FROM lake""", "lake")
register("load_rerun_idempotent", """
SELECT CAST(created_at AS DATE) AS created_date, COUNT(*) AS event_count FROM lake
WHERE CAST(created_at AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-06'
   OR CAST(id AS BIGINT) % 2 = 0
GROUP BY 1""", "lake")
register("load_reconciliation", """
SELECT CAST(created_at AS DATE) AS event_date, COUNT(*) AS source_count,
       COUNT(*) AS target_count, CAST(0 AS BIGINT) AS delta
FROM lake GROUP BY 1""", "lake")
register("load_history_counts", """
SELECT 'overwrite' AS operation, n AS source_records, n AS added_records,
       CAST(0 AS BIGINT) AS straggler_records, CAST(0 AS BIGINT) AS undated_records,
       d AS days_written
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
             CAST(COUNT(DISTINCT CAST(created_at AS DATE)) AS BIGINT) AS d FROM lake) full_load
UNION ALL
SELECT 'overwrite', n, n, CAST(0 AS BIGINT), CAST(0 AS BIGINT), d
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
             CAST(COUNT(DISTINCT CAST(created_at AS DATE)) AS BIGINT) AS d FROM lake
      WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-06'
        AND CAST(id AS BIGINT) % 2 = 0) first_rerun
UNION ALL
SELECT 'overwrite', n, n, CAST(0 AS BIGINT), CAST(0 AS BIGINT), d
FROM (SELECT CAST(COUNT(*) AS BIGINT) AS n,
             CAST(COUNT(DISTINCT CAST(created_at AS DATE)) AS BIGINT) AS d FROM lake
      WHERE CAST(created_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-06'
        AND CAST(id AS BIGINT) % 2 = 0) second_rerun""", "lake")
register("repo_snapshot_write", """
SELECT full_name AS repo_full_name, language, topics, stargazers_count, forks_count, is_fork,
       CAST(created_at AS TIMESTAMP) AS repo_created_at, description, enriched_date
FROM api_proj
WHERE (enriched_date <> DATE '2024-01-28' OR stargazers_count >= 2500)
  AND (enriched_date = DATE '2024-01-28'
       OR enriched_date <> (SELECT MIN(enriched_date) FROM api_proj))""", "api_proj")
register("stream_file_ingest", "SELECT * FROM stg", "stg")
register("stream_trends_refresh", "SELECT * FROM trends", "trends")
register("stream_as_of_advance", "SELECT * FROM trends", "trends")
register("trends_after_outage",
         trends_sql("event_date <= DATE '2024-01-10'", "2024-01-30 06:00:00"), "classified")
register("model_views", """
SELECT contributor_type, language, COUNT(*) AS event_count
FROM enriched GROUP BY contributor_type, language""", "enriched")
# The lake's actor struct has no type: bots are known by their logins only.
_cte("lake_classified", """
SELECT event_date, event_hour, actor_login, repo_name,
       CASE WHEN {BOT} THEN 'bot' ELSE 'human' END AS contributor_type
FROM (SELECT * REPLACE (NULL AS actor_type) FROM stg) s WHERE event_type = 'PushEvent'""", "stg")
_cte("lake_enriched", """
SELECT c.*, m.language FROM lake_classified c
LEFT JOIN repo_latest m ON c.repo_name = m.repo_full_name""", "lake_classified", "repo_latest")
for key, sql, source in (("marts_after_late_commit", trends_sql, "lake_classified"),
                         ("language_after_late_commit", lang_sql, "lake_enriched")):
    register(key, sql("event_date <= DATE '2024-01-20' AND event_date <> DATE '2024-01-10'",
                      "2024-01-21 06:00:00", source) + " UNION ALL "
             + sql("event_date = DATE '2024-01-10'", "2024-01-21 18:00:00", source), source)
register("mart_backfill_range",
         merge_sql(trends_sql(f"event_hour < 22 AND event_date < {AS_OF}", AT_0127),
                   trends_sql("event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'",
                              BATCHED_AT), TKEYS), "classified")
register("load_repaired_rerun", """
SELECT CAST(created_at AS DATE) AS created_date, CAST(created_at AS DATE) AS landed_date,
       COUNT(*) AS event_count
FROM lake GROUP BY 1""", "lake")
register("catalog_models", """
SELECT event_date, contributor_type, language, COUNT(*) AS event_count FROM enriched
WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'
GROUP BY event_date, contributor_type, language""", "enriched")
register("load_job_from_files", """
SELECT CAST(created_at AS DATE) AS event_date, COUNT(*) AS source_count,
       COUNT(*) AS target_count, CAST(0 AS BIGINT) AS delta
FROM lake GROUP BY 1""", "lake")
register("named_table_read", """
SELECT type, COUNT(*) AS event_count FROM lake
WHERE CAST(created_at AS DATE) >= DATE '2024-01-05' GROUP BY type""", "lake")
register("load_stragglers", """
SELECT created_date, landed_date, COUNT(*) AS event_count FROM (
  SELECT CAST(created_at AS DATE) AS created_date,
         CAST(created_at AS DATE) + CASE WHEN CAST(id AS BIGINT) % 50 = 0 THEN 1 ELSE 0 END
           AS landed_date
  FROM lake
  UNION ALL
  SELECT NULL, CAST(created_at AS DATE) FROM lake WHERE CAST(id AS BIGINT) % 50 = 0) s
GROUP BY 1, 2""", "lake")


# The declared column tests, stated here a second time so that a
# rule that went missing from the engine shows as a difference.
EVENT_COLUMNS = ["event_date", "event_hour", "event_id", "event_type"]
REQUIRED = {
    "stg_events": EVENT_COLUMNS,
    "stg_repo_metadata": ["repo_full_name", "enriched_date"],
    "events_classified": [*EVENT_COLUMNS, "is_bot", "contributor_type"],
    "events_enriched": [*EVENT_COLUMNS, "is_bot", "contributor_type"],
    "contributor_trends": ["event_date", "contributor_type", "event_count",
                           "unique_contributors"],
    "language_activity": ["event_date", "language", "contributor_type", "event_count",
                          "unique_contributors", "unique_repos"],
}
WHO = ("contributor_type", "('human', 'bot')")
ALLOWED = {"events_classified": [("event_type", "('PushEvent')"), WHO], "events_enriched": [WHO],
           "contributor_trends": [WHO], "language_activity": [WHO]}
UNIQUE = {"stg_repo_metadata": ["repo_full_name"]}


def _dq_sql(model: str, source: str) -> str:
    checks = [(c, "not_null", f"SELECT COUNT(*) FROM {source} WHERE {c} IS NULL")
              for c in REQUIRED[model]]
    checks += [(c, "accepted_values", f"SELECT COUNT(*) FROM {source} WHERE {c} NOT IN {values}")
               for c, values in ALLOWED.get(model, [])]
    checks += [(c, "unique", f"SELECT COUNT(*) FROM (SELECT {c} FROM {source} "
                             f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1) d")
               for c in UNIQUE.get(model, [])]
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, '{rule}' AS rule, "
        f"({count}) AS failures" for c, rule, count in checks)


BROKEN = """(SELECT * REPLACE (
  CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN NULL
       WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN 'Forged' ELSE event_type END AS event_type,
  CASE WHEN CAST(event_id AS BIGINT) % 13 = 0 THEN 'alien' ELSE contributor_type END
    AS contributor_type) FROM classified) b"""
def _violations_sql(model: str, source: str) -> str:
    rows = [(c, "not_null", f"{c} IS NULL") for c in REQUIRED[model]]
    rows += [(c, "accepted_values", f"{c} NOT IN {values}") for c, values in ALLOWED.get(model, [])]
    rows += [(c, "unique", f"{c} IN (SELECT {c} FROM {source} GROUP BY {c} HAVING COUNT(*) > 1)")
             for c in UNIQUE.get(model, [])]
    return "\nUNION ALL\n".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, '{rule}' AS rule, * "
        f"FROM {source} WHERE {broken}" for c, rule, broken in rows)


register("dq_violations_events", _violations_sql("events_classified", BROKEN), "classified")
_cte("snapshots", "SELECT * EXCLUDE (value) FROM repo_typed", "repo_typed")
register("dq_violations_repos", _violations_sql("stg_repo_metadata", "snapshots"), "snapshots")
register("mart_refused_publish",
         trends_sql("event_date < DATE '2024-01-20'", BATCHED_AT), "classified")
register("schema_sync_nested", """
SELECT event_id, CAST(ts AS DATE) AS event_date,
       CASE WHEN late THEN CAST(CAST(value AS DECIMAL(12,4)) AS DOUBLE)
            ELSE CAST(CAST(value AS DECIMAL(9,2)) AS DOUBLE) END AS amount,
       CASE WHEN late THEN user_id END AS user_id, user_id AS actor_id,
       CASE WHEN late THEN event_type END AS kind, event_type AS tag,
       CASE WHEN late THEN 1 END AS weight, 'user_id,id,kind' AS actor_fields
FROM (SELECT *, CAST(ts AS DATE) = DATE '2024-01-10' AS late FROM events) e""")
register("dq_broken_events", _dq_sql("events_classified", BROKEN), "classified")
register("dq_repeated_repos", _dq_sql("stg_repo_metadata", "repo_typed"), "repo_typed")
register("dq_stg_events", _dq_sql("stg_events", "stg"), "stg")
register("dq_repo_metadata", _dq_sql("stg_repo_metadata", "repo_latest"), "repo_latest")
register("dq_classified", _dq_sql("events_classified", "classified"), "classified")
register("dq_enriched", _dq_sql("events_enriched", "enriched"), "enriched")
register("dq_trends", _dq_sql("contributor_trends", "trends"), "trends")
register("dq_language", _dq_sql("language_activity", "lang"), "lang")
