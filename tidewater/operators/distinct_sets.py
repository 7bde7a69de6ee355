"""Exact distinct counts that can be merged.

A distinct count of a day can't be added to that of another day, but sets can
be joined. Values (actors, repositories) are numbered once; a set of numbers is
held as bitmaps of 32,768 bits, one row per bitmap that isn't empty. Sets of
parts of a day, or of days of a range, merge by bitwise or, and a count is the
number of bits. Every step is an ordinary grouped aggregate over bitmaps: no
row is copied per distinct column, and a hot group is collapsed before any
shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans import notes

NUMBERS_SCHEMA = "value string, number long"
#: Numbers of one append start at a multiple of this, so appends never meet.
STRIDE = 1 << 33


def number_values(spark: SparkSession, location: str, values: DataFrame) -> DataFrame:
    """Add the values (first column of ``values``) that aren't numbered yet to
    the table of numbers at ``location`` and return it: (value, number), null
    left out. Numbers stay for good. They are dense in each task's share, which
    is what keeps bitmaps full; nothing is sorted or counted as a whole."""
    given = values.select(F.col(values.columns[0]).alias("value")).where("value IS NOT NULL")
    top = None
    if notes.exists(spark, location):
        held = spark.read.schema(NUMBERS_SCHEMA).parquet(location)
        top = held.agg(F.max("number")).first()[0]
        given = given.join(held, "value", "left_anti")
    first = 0 if top is None else (top // STRIDE + 1) * STRIDE
    (given.distinct().select("value", (F.monotonically_increasing_id() + first).alias("number"))
          .write.mode("append").parquet(location))
    return spark.read.schema(NUMBERS_SCHEMA).parquet(location)


def numbered(rows: DataFrame, column: str, numbers: DataFrame, out: str) -> DataFrame:
    """``rows`` with the number of ``column``'s value (null for null)."""
    n = numbers.select(F.col("value").alias(column), F.col("number").alias(out))
    return rows.join(n, column, "left")


def distinct_sets(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """(keys, bucket, bits): the set of numbers of each group. A group whose
    numbers are all null has no row."""
    n = F.col(number)
    return (rows.where(n.isNotNull())
            .select(*keys, F.bitmap_bucket_number(n).alias("bucket"),
                    F.bitmap_bit_position(n).alias("bit"))
            .groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets joined over everything but ``keys``."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def sizes(sets: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Number of members of each group's set; its bitmaps must be merged."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(out))


def with_counts(groups: DataFrame, keys: Sequence[str], counts: dict[str, DataFrame]) -> DataFrame:
    """``groups`` with the size of one set each, 0 for a group that has none.
    Groups are equal if their keys are, null or not."""
    for out, sets in counts.items():
        size = sizes(merged(sets, keys), keys, out).select(
            *[F.col(k).alias(f"_{k}") for k in keys], out)
        same = F.lit(True)
        for k in keys:
            same = same & groups[k].eqNullSafe(size[f"_{k}"])
        groups = groups.join(size, same, "left").drop(*[f"_{k}" for k in keys])
        groups = groups.withColumn(out, F.coalesce(out, F.lit(0).cast("long")))
    return groups
