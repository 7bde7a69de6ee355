"""Clustering of stored days: files sorted by time, with Bloom filters.

A load writes a day's rows as they come. Once a day is settled its folders
can be rewritten so that narrow reads skip most of them: rows are ranged and
sorted by a time column, so each row group covers a short span of time and
its statistics rule it out, and Bloom filters on identifying columns rule out
the row groups that don't hold the value looked up.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.columns import bytes_of_rows
from tidewater.plans import sinks
from tidewater.session import scratch_path

ROWS_PER_FILE = 4_000_000
#: What one task sorts, in memory: files hold fewer rows if they are wide.
BYTES_PER_FILE = 192 << 20
ROW_GROUP_BYTES = 32 << 20


def cluster_days(spark: SparkSession, location: str, schema: StructType,
                 days: Sequence[dt.date], partitions: Sequence[str], by: str,
                 lookup: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE,
                 row_group_bytes: int = ROW_GROUP_BYTES,
                 bytes_per_file: int = BYTES_PER_FILE) -> dict:
    """Rewrite the folders of ``days`` (first of the ``partitions`` columns)
    clustered by ``by``, with Bloom filters on ``lookup``; the rows stay the
    same. The copy is staged first and swapped in like a merge, so a failure
    leaves the old files or is completed by the next run. Other days' folders
    are neither listed nor touched.

    The stage is a plain copy, counted and measured as it is written. The swap
    deals it over that many ranges of about equal size and sorts each, so a
    task holds one file's rows whatever the length of the days. Rows of one
    moment are told apart by the ``lookup`` columns."""
    sinks.recover(spark, location)
    root = location.rstrip("/")
    names = ",".join(d.isoformat() for d in days)
    rows = (spark.read.schema(schema).option("basePath", root)
            .parquet(f"{root}/{partitions[0]}={{{names}}}"))
    stage = scratch_path(spark, "cluster")
    obs = Observation(f"cluster_{uuid.uuid4().hex[:8]}")
    (rows.observe(obs, F.count(F.lit(1)).alias("rows"),
                  bytes_of_rows(schema).alias("bytes"))
         .write.mode("overwrite").parquet(stage))
    files = max(1, -(-obs.get["rows"] // rows_per_file),
                -(-obs.get["bytes"] // bytes_per_file))
    sinks.swap_in(spark, location, stage, "dynamic", ",".join(partitions),
                  order=",".join([by, *lookup]), lookup=",".join(lookup),
                  row_group_bytes=row_group_bytes, files=files)
    summary = {"days": [d.isoformat() for d in sorted(days)], "clustered-by": by,
               "lookup": list(lookup)}
    sinks.record_commit(spark, location, "cluster", summary)
    return summary
