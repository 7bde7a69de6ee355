"""Column builders: JVM-side expressions only, no Python UDFs."""

from tidewater.functions.columns import (  # noqa: F401
    bot_flag,
    contributor_label,
    landing_key,
    parse_utc_timestamp,
    percent_of,
    previous_full_hour,
    repo_name_parts,
)
