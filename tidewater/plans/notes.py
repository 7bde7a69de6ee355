"""Small append-only tables beside a big one: write history, swap intents,
load intents and the marks of what a mart was built from.

Every append adds a file of its own, so once there are more than ``MAX_FILES``
their distinct rows are written as one more file and the old ones removed.
Readers drop repeated rows, so it does no harm if that is cut short in
between. Rows must therefore be distinct by themselves (each carries an id).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import MapType, StructType

MAX_FILES = 32


def _file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path, as Spark itself would take it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, location: str) -> bool:
    """Whether ``location`` is there. No job runs and nothing below it is
    listed; a failure is raised, since whoever asks goes on to replace a table
    that it believes absent."""
    fs, p = _file_system(spark, location)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Folders and files that match a path pattern."""
    fs, p = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders; an absent one is no fault."""
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)


def read(spark: SparkSession, path: str, schema: str | StructType,
         distinct: bool = True) -> DataFrame:
    """All notes; none if nothing was noted yet. Who doesn't mind a note twice
    saves the shuffle with ``distinct=False``."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    noted = spark.read.schema(schema).parquet(path)
    if not distinct:
        return noted
    maps = [f.name for f in noted.schema.fields if isinstance(f.dataType, MapType)]
    return noted.dropDuplicates([c for c in noted.columns if c not in maps])  # can't compare maps


def append(spark: SparkSession, path: str, rows: DataFrame, max_files: int = MAX_FILES) -> None:
    """Add notes (a few rows), and join the files if they have become many."""
    rows.coalesce(1).write.mode("append").parquet(path)
    noted = spark.read.schema(rows.schema).parquet(path)
    files = noted.inputFiles()
    if len(files) > max_files:
        read(spark, path, rows.schema).coalesce(1).write.mode("append").parquet(path)
        remove(spark, files)
