"""Pickup of landed files by notification.

The object store says which file was created; nothing is listed. Notification
records (JSON lines, in the store's own shape) are a stream of small files. Each
micro-batch names the keys to read: creations below the prefix with the right
suffix that no earlier batch has read. The keys are read as named files and
staged like the batches of the file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tidewater import schemas
from tidewater.functions.columns import partition_from_path
from tidewater.plans import notes
from tidewater.streaming.file_ingest import staged_columns, write_staged_batch

# The fields of a store's notification that are used.
NOTIFICATION = ("Records array<struct<eventName: string, eventTime: string, "
                "s3: struct<object: struct<key: string, size: bigint>>>>")
CREATED = "ObjectCreated:"

SEEN_SCHEMA = "file_key string, event_date date, batch bigint"


def seen_path(staged_location: str) -> str:
    return staged_location.rstrip("/") + "_files"


def created_keys(records: DataFrame, prefix: str, suffix: str) -> DataFrame:
    """(file_key, event_date): the distinct keys of a batch of notifications
    that name a created file; other events, folders and files are left out.
    A record that is no notification names none."""
    keys = (records.select(F.explode("Records").alias("r"))
            .where(F.col("r.eventName").startswith(CREATED))
            # Keys are URL-encoded, blanks as plus signs.
            .select(F.url_decode("r.s3.object.key").alias("file_key"))
            .where(F.col("file_key").startswith(prefix) & F.col("file_key").endswith(suffix))
            .distinct())
    return keys.select("file_key", partition_from_path(F.col("file_key"))[0].alias("event_date"))


def unseen(spark: SparkSession, keys: DataFrame, staged_location: str, batch_id: int) -> DataFrame:
    """Keys that no other batch has read. Keys noted by this same batch belong
    to an attempt that failed before it was over: they are read again, and the
    batch's folders replaced."""
    seen = (notes.read(spark, seen_path(staged_location), SEEN_SCHEMA, distinct=False)
            .where(F.col("batch") != batch_id).select("file_key"))
    return keys.join(seen, "file_key", "left_anti")


def read_keys(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Staged events of these files below ``root``; no folder is listed."""
    schema = StructType(list(schemas.STG_EVENT_JSON.fields) + [
        StructField("event_date", DateType()), StructField("event_hour", IntegerType())])
    base = root.rstrip("/")
    return staged_columns(spark.read.schema(schema).option("basePath", base)
                          .json([f"{base}/{key}" for key in keys]))


def ingest_notified(spark: SparkSession, queue: str, root: str, staged_location: str,
                    checkpoint: str, prefix: str = "event_date=", suffix: str = ".gz",
                    max_files_per_trigger: int | None = None) -> list[str]:
    """Stage every file that the notifications in ``queue`` name and no earlier
    run has staged; returns their keys. A repeated notification adds nothing,
    an old one that comes late adds its file then."""
    added: list[str] = []

    def stage(records: DataFrame, batch_id: int) -> None:
        session = records.sparkSession
        new = unseen(session, created_keys(records, prefix, suffix), staged_location, batch_id)
        rows = new.collect()  # the files of one trigger's notifications
        if not rows:
            return
        keys = sorted(r["file_key"] for r in rows)
        write_staged_batch(read_keys(session, root, keys), staged_location, batch_id)
        notes.append(session, seen_path(staged_location), session.createDataFrame(
            [(r["file_key"], r["event_date"], batch_id) for r in rows], SEEN_SCHEMA))
        added.extend(keys)

    reader = spark.readStream.schema(NOTIFICATION)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.json(queue).writeStream.foreachBatch(stage)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return added
