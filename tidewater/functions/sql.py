"""The column builders as Spark SQL functions, for use beside the model views.

They are SQL expressions that Catalyst inlines into the query, not UDFs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewater.functions.columns import BOT_ACTOR_TYPE, BOT_LOGIN_PATTERNS

PATTERNS = ", ".join(f"'{p}'" for p in BOT_LOGIN_PATTERNS)

# Name -> (parameters, result type, body).
SQL_FUNCTIONS = {
    "is_bot": ("actor_type STRING, actor_login STRING", "BOOLEAN",
               f"coalesce(actor_type = '{BOT_ACTOR_TYPE}', FALSE) "
               f"OR coalesce(actor_login ILIKE ANY ({PATTERNS}), FALSE)"),
    "previous_hour": ("at TIMESTAMP_NTZ", "TIMESTAMP_NTZ",
                      "CAST(date_trunc('HOUR', at - INTERVAL 1 HOUR) AS TIMESTAMP_NTZ)"),
    "landing_key": ("hour_start TIMESTAMP_NTZ", "STRING",
                    "format_string('raw/events/event_date=%s/event_hour=%d/%s-%d.json.gz', "
                    "date_format(hour_start, 'yyyy-MM-dd'), hour(hour_start), "
                    "date_format(hour_start, 'yyyy-MM-dd'), hour(hour_start))"),
    "percent_of": ("part BIGINT, total BIGINT", "DOUBLE",
                   "CASE WHEN total > 0 THEN round(coalesce(part, 0) / total * 100, 1) "
                   "ELSE 0.0D END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session; returns their names."""
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
                  f"RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)
