"""Writes: idempotent day overwrite, keyed delete+insert, schema sync,
snapshot files and the append-only write history.

Tables are folders of Parquet (zstd) partitioned by a date column. A write
never reads and overwrites the same files in one job: merged partitions are
first staged under the shared checkpoint folder, which also cuts lineage, so a
retried task after executor loss recomputes from durable files only.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import astuple, dataclass
from dataclasses import fields as dataclass_fields
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidewater.days import DaySpan
from tidewater.operators.quality import Rule, counters
from tidewater.plans import notes
from tidewater.session import scratch_path

HISTORY_SCHEMA = StructType([
    StructField("committed_at", TimestampType()),
    StructField("snapshot_id", LongType()),
    StructField("operation", StringType()),
    StructField("summary", MapType(StringType(), StringType())),
])


def history_path(location: str) -> str:
    return location.rstrip("/") + "_history"


def table_exists(spark: SparkSession, location: str) -> bool:
    return notes.exists(spark, location)


def read_table(spark: SparkSession, location: str,
               order: Sequence[str] | None = None) -> DataFrame:
    """Read a partitioned table; ``order`` restores the logical column order
    (partition columns come back last from a folder read)."""
    df = spark.read.parquet(location)
    if order:
        by_name = {c.lower(): c for c in df.columns}
        first = [F.col(by_name[c.lower()]).alias(c) for c in order if c.lower() in by_name]
        wanted = {c.lower() for c in order}
        df = df.select(*first, *[c for c in df.columns if c.lower() not in wanted])
    return df


def record_commit(spark: SparkSession, location: str, operation: str,
                  summary: dict[str, object]) -> None:
    """Append one row to the table's write history.

    The row is built from literals on a one-row range (no local data shipped
    from Python), so the append is a single one-task write.
    """
    entries = [x for k, v in summary.items()
               for x in (F.lit(k), F.lit(v if isinstance(v, str) else json.dumps(v, default=str)))]
    row = spark.range(1).select(
        F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
         .alias("committed_at"),
        F.lit(uuid.uuid4().int >> 65).cast("bigint").alias("snapshot_id"),
        F.lit(operation).alias("operation"),
        (F.create_map(*entries) if entries
         else F.create_map().cast("map<string,string>")).alias("summary"))
    notes.append(spark, history_path(location), row)


def load_history(spark: SparkSession, location: str) -> DataFrame:
    """Write history, newest first."""
    return (notes.read(spark, history_path(location), HISTORY_SCHEMA)
            .orderBy(F.desc("committed_at"), F.desc("snapshot_id")))


def ensure_table(spark: SparkSession, name: str, location: str, ddl_columns: str,
                 partition_column: str) -> None:
    """Create the named table over ``location`` if absent (Parquet, zstd)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl_columns}) USING parquet "
              f"PARTITIONED BY ({partition_column}) LOCATION '{location}' "
              f"OPTIONS ('compression' = 'zstd')")


# Days written by one job: a longer range is a sequence of such writes, each
# reading its own day folders only and observing its own counters.
DAYS_PER_WRITE = 31
LANDED = "landed_date"

# -- what landed where -------------------------------------------------------

LOADS_SCHEMA = "load string, first date, last date"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def loads_path(location: str) -> str:
    return location.rstrip("/") + "_loads"


def note_load(spark: SparkSession, location: str, load: str, span: DaySpan) -> None:
    """Note that a load has begun; its commit carries the same id."""
    notes.append(spark, loads_path(location), spark.range(1).select(
        F.lit(load).alias("load"), F.lit(span.first).alias("first"),
        F.lit(span.last).alias("last")))


def folder(location: str, partition_column: str, day: str | None, landed: str) -> str:
    return f"{location.rstrip('/')}/{partition_column}={day or NO_DAY}/{LANDED}={landed}"


Folders = set[tuple[str | None, str]]


def filled_folders(spark: SparkSession, location: str, partition_column: str,
                   span: DaySpan) -> tuple[Folders, list[str]]:
    """(day, landing day) of the folders that hold rows which landed on the
    days of ``span``, by the write history. A load that began in those days
    but never finished may have filled any folder: only then are the folders
    themselves listed, over all days of the table. Such loads that lie in the
    span come second: a load of the span replaces them."""
    began = {r["load"]: r for r in notes.read(spark, loads_path(location), LOADS_SCHEMA, False)
             .where((F.col("first") <= F.lit(span.last)) & (F.col("last") >= F.lit(span.first)))
             .collect()}  # loads of these days
    if not began:
        return set(), []
    history = notes.read(spark, history_path(location), HISTORY_SCHEMA, distinct=False)
    summary = F.col("summary")
    over = F.concat(F.array(summary["load"]), F.coalesce(
        F.from_json(summary["replaced-loads"], "array<string>"), F.array()))
    over = {r[0] for r in history.where(summary["load"].isNotNull())
            .select(F.explode(over).alias("load")).where(F.col("load").isin(list(began))).collect()}
    broken = began.keys() - over
    if broken:
        inside = [k for k in broken
                  if span.first <= began[k]["first"] and began[k]["last"] <= span.last]
        return listed_folders(spark, location, partition_column, span), sorted(inside)
    folders = F.from_json(summary["folders"], "array<array<string>>")
    emptied = F.from_json(summary["emptied-folders"], "array<array<string>>")
    told = (history
            .select("committed_at", F.explode(F.concat(
                F.transform(folders, lambda f: F.struct(F.lit(True).alias("filled"),
                                                        f.alias("folder"))),
                F.transform(F.coalesce(emptied, F.array()), lambda f: F.struct(
                    F.lit(False).alias("filled"), f.alias("folder"))))).alias("f"))
            .select("committed_at", "f.filled", F.col("f.folder")[0].alias("day"),
                    F.col("f.folder")[1].alias("landed"))
            .where(F.col("landed").between(span.first.isoformat(), span.last.isoformat())))
    last = {(r["day"], r["landed"]): r["filled"]
            for r in sorted(told.collect(), key=lambda r: r["committed_at"])}
    return {key for key, filled in last.items() if filled}, []


def listed_folders(spark: SparkSession, location: str, partition_column: str,
                   span: DaySpan) -> Folders:
    pattern = span.folders(f"{location.rstrip('/')}/{partition_column}=*", LANDED)
    values = {tuple(part.split("=")[1] for part in f.rstrip("/").split("/")[-2:])
              for f in notes.matching(spark, pattern)}
    return {(None if day == NO_DAY else day, landed) for day, landed in values}


def overwrite_days(spark: SparkSession, df: DataFrame, location: str, partition_column: str,
                   start: dt.date, end: dt.date, operation: str = "overwrite",
                   extra_metrics: dict | None = None, drop_columns: Sequence[str] = (),
                   landing_column: str | None = None,
                   days_per_write: int = DAYS_PER_WRITE) -> dict:
    """Idempotent overwrite of what landed on the days ``[start, end]``.

    Every row is stored under its true day and, within that, under the day it
    landed on (``<partition_column>=.../landed_date=...``). A straggler of an
    earlier day so gets a folder of its own beside that day's rows, and a
    rerun of its landing day replaces that folder and no other. Rows without
    a day (unreadable lines) are stored as well, under the null day. Nothing
    is dropped and nothing is deduplicated. A folder that an earlier load
    filled from one of these landing days and this one does not is removed:
    a repaired upload takes its broken lines and stragglers with it.

    ``landing_column`` names the day folder a row came from; without it a row
    counts as landed on its own day, or on the nearest day of the range.
    Counts (total, stragglers, undated, per landing day) are observed during
    the writes: one pass over the input for a range of any length.
    """
    span = DaySpan(start, end)
    part = F.col(partition_column)
    landed = F.col(landing_column) if landing_column else F.coalesce(
        F.least(F.greatest(part, F.lit(start)), F.lit(end)), F.lit(start))
    rows = df.withColumn(LANDED, landed).drop(*drop_columns_of(df, landing_column))
    before, replaced = filled_folders(spark, location, partition_column, span)
    load = uuid.uuid4().hex
    note_load(spark, location, load, span)
    total = {"source-records": 0, "straggler-records": 0, "undated-records": 0}
    per_day: dict[str, int] = {}
    folders: Folders = set()
    extra: dict[str, object] = {}
    for days in span.chunks(days_per_write):
        metrics = [F.count(F.lit(1)).alias("source-records"),
                   F.count_if(part != F.col(LANDED)).alias("straggler-records"),
                   F.count_if(part.isNull()).alias("undated-records"),
                   # Bounded by the days of the write and of its stragglers.
                   F.collect_set(F.struct(part.cast("string").alias("day"),
                                          F.col(LANDED).cast("string").alias("landed")))
                   .alias("folders"),
                   F.create_map(*[x for d in days for x in (
                       F.lit(d.isoformat()), F.count_if(F.col(LANDED) == F.lit(d)))])
                   .alias("per_day"),
                   *[expr.alias(name) for name, expr in (extra_metrics or {}).items()]]
        obs = Observation(f"overwrite_{uuid.uuid4().hex[:8]}")
        # REBALANCE: hash-distribute by day, then let AQE merge small days and
        # split a hot day into advisory-sized chunks, so each day gets a few
        # well-sized files and no day lands whole in one task. The metrics are
        # observed after the exchange, in the write (result) stage, where each
        # task's update counts exactly once even if map stages are recomputed
        # after an executor loss.
        observed = (rows.filter(F.col(LANDED).between(F.lit(days.first), F.lit(days.last)))
                    .hint("rebalance", partition_column, LANDED).observe(obs, *metrics))
        (observed.drop(*drop_columns)
                 .write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic")
                 .option("compression", "zstd")
                 .partitionBy(partition_column, LANDED)
                 .parquet(location))
        m = obs.get
        for name in total:
            total[name] += int(m[name])
        per_day |= {k: int(v) for k, v in m["per_day"].items()}
        folders |= {(f["day"], f["landed"]) for f in m["folders"]}
        for name in extra_metrics or {}:
            extra[name] = extra.get(name, 0) + m[name]
    emptied = before - folders
    notes.remove(spark, [folder(location, partition_column, *f) for f in emptied])
    summary = {"requested-range": f"{start.isoformat()}..{end.isoformat()}", **total,
               "added-records": total["source-records"], "per-day": per_day,
               "folders": sorted(map(list, folders), key=str),
               "emptied-folders": sorted(map(list, emptied), key=str), **extra}
    record_commit(spark, location, operation, {**summary, "load": load,
                                                 "replaced-loads": replaced})
    return summary


def drop_columns_of(df: DataFrame, landing_column: str | None) -> list[str]:
    return [c for c in df.columns if c == landing_column and c != LANDED]


# Casts that keep every value of the type on the left.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz", "timestamp"),
}
# Digits of the whole-number types, and the most a decimal has.
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
MOST_DIGITS = 38


def as_decimal(t: DataType) -> tuple[int, int] | None:
    """(digits before, after the point) that hold a number type's values."""
    if isinstance(t, DecimalType):
        return t.precision - t.scale, t.scale
    digits = WHOLE_DIGITS.get(t.simpleString())
    return None if digits is None else (digits, 0)


def common_type(a: DataType, b: DataType, column: str) -> DataType:
    """The type that holds the values of both, or a refusal. Structs are
    matched field by field and take the fields of ``b``, arrays and maps by
    their elements, decimals get the digits of both."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        held = {f.name.lower(): f for f in a.fields}
        return StructType([StructField(f.name, f.dataType if f.name.lower() not in held else
                                       common_type(held[f.name.lower()].dataType, f.dataType,
                                                   f"{column}.{f.name}")) for f in b.fields])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType, f"{column}[]"))
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(common_type(a.keyType, b.keyType, f"{column} key"),
                       common_type(a.valueType, b.valueType, f"{column} value"))
    x, y = a.simpleString(), b.simpleString()
    if x == y or y in WIDER.get(x, ()):
        return b
    if x in WIDER.get(y, ()):
        return a
    whole, other = as_decimal(a), as_decimal(b)
    if whole and other:
        before, after = max(whole[0], other[0]), max(whole[1], other[1])
        if before + after <= MOST_DIGITS:
            return DecimalType(before + after, after)
    raise ValueError(f"column {column!r}: {x} and {y} cannot be merged without loss")


def conformed(value: Column, held: DataType, wanted: DataType) -> Column:
    """A value of type ``held`` as one of type ``wanted``: fields by name
    without regard to case, new ones NULL, others dropped; a null stays null."""
    if isinstance(wanted, StructType) and isinstance(held, StructType):
        fields = {f.name.lower(): f for f in held.fields}
        parts = [(F.lit(None).cast(f.dataType) if f.name.lower() not in fields else
                  conformed(value[fields[f.name.lower()].name], fields[f.name.lower()].dataType,
                            f.dataType)).alias(f.name) for f in wanted.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(wanted, ArrayType) and isinstance(held, ArrayType):
        return F.transform(value, lambda v: conformed(v, held.elementType, wanted.elementType))
    if isinstance(wanted, MapType) and isinstance(held, MapType):
        keys = F.transform_keys(value, lambda k, _: conformed(k, held.keyType, wanted.keyType))
        return F.transform_values(keys, lambda _, v: conformed(v, held.valueType,
                                                               wanted.valueType))
    return value.cast(wanted)


def sync_columns(current: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
    """Align a table and a batch: (table, batch, whether the table's schema
    changes). Columns, and the fields inside them, are matched without regard
    to case and take the batch's names; new ones are NULL in the table,
    removed ones are dropped, and where types differ the wider one is taken
    (narrowing is refused)."""
    held = {f.name.lower(): f for f in current.schema.fields}
    kept, given, changed = [], [], len(current.columns) != len(batch.columns)
    for f in batch.schema.fields:
        old = held.get(f.name.lower())
        kind = f.dataType if old is None else common_type(old.dataType, f.dataType, f.name)
        changed |= old is None or old.name != f.name or old.dataType.simpleString() != kind.simpleString()
        kept.append((F.lit(None).cast(kind) if old is None else
                     conformed(F.col(old.name), old.dataType, kind)).alias(f.name))
        given.append(conformed(F.col(f.name), f.dataType, kind).alias(f.name))
    return current.select(*kept), batch.select(*given), changed


# -- swaps that survive a failure ----------------------------------------------

INTENT_SCHEMA = ("swap string, stage string, mode string, partition_columns string, "
                 "order string, lookup string, row_group_bytes long, files long, done boolean")


@dataclass(frozen=True)
class Swap:
    """A staged copy that replaces a table or its touched partitions. Lists of
    columns are comma-separated; ``order`` sorts the rows of each file, dealt
    over ``files`` ranges of it; ``lookup`` columns get Bloom filters."""

    swap: str
    stage: str
    mode: str
    partition_columns: str
    order: str = ""
    lookup: str = ""
    row_group_bytes: int = 128 << 20
    files: int | None = None

    def note(self, spark: SparkSession, location: str, done: bool) -> None:
        notes.append(spark, intent_path(location), spark.createDataFrame(
            [(*astuple(self), done)], INTENT_SCHEMA))

    def copy_in(self, spark: SparkSession, location: str) -> None:
        partitions = self.partition_columns.split(",")
        rows = spark.read.parquet(self.stage)
        if self.order:
            order = [*partitions, *self.order.split(",")]
            if self.files:  # not the reader's splits: those hold many files of the stage
                rows = rows.repartitionByRange(self.files, *order)
            rows = rows.sortWithinPartitions(*order)
        writer = (rows.write.mode("overwrite").option("partitionOverwriteMode", self.mode)
                  .option("compression", "zstd")
                  .option("parquet.block.size", str(self.row_group_bytes))
                  # Filters are sized by what a row group holds.
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
        for column in filter(None, self.lookup.split(",")):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.partitionBy(*partitions).parquet(location)


def intent_path(location: str) -> str:
    return location.rstrip("/") + "_intent"


def swap_in(spark: SparkSession, location: str, stage: str, mode: str, partition_columns: str,
            **how) -> None:
    """Replace the table (or its touched partitions) by a staged copy. The
    intent is written first: a failure in between leaves the whole new content
    in the stage, and :func:`recover` completes the swap on the next run."""
    swap = Swap(uuid.uuid4().hex, stage, mode, partition_columns, **how)
    swap.note(spark, location, False)
    swap.copy_in(spark, location)
    swap.note(spark, location, True)
    notes.remove(spark, [stage])


def begun_swaps(spark: SparkSession, location: str) -> list[Swap]:
    noted = notes.read(spark, intent_path(location), INTENT_SCHEMA, distinct=False)
    fields = [f.name for f in dataclass_fields(Swap)]
    begun = noted.groupBy(*fields).agg(F.bool_or("done").alias("done")).where("not done")
    return [Swap(*r[:len(fields)]) for r in begun.collect()]  # a failed run each


def recover(spark: SparkSession, location: str) -> int:
    """Complete the swaps that were begun but not finished; their number. If
    the stage of one is gone (scratch was cleared), some of its partitions may
    be old: that is an error until :func:`abandon_swaps` is called and the
    days are built again."""
    begun = begun_swaps(spark, location)
    for swap in begun:
        if not table_exists(spark, swap.stage):
            raise RuntimeError(
                f"a write to {location} was cut off and its staged copy {swap.stage} is gone: "
                "call sinks.abandon_swaps on the table, then build the days concerned again "
                "(marts.backfill_mart, or run_mart with full_refresh=True)")
        swap.copy_in(spark, location)
        swap.note(spark, location, True)
        notes.remove(spark, [swap.stage])
    return len(begun)


def abandon_swaps(spark: SparkSession, location: str) -> int:
    """Give up the unfinished swaps whose staged copy is gone; their number."""
    lost = [s for s in begun_swaps(spark, location) if not table_exists(spark, s.stage)]
    for swap in lost:
        swap.note(spark, location, True)
    return len(lost)


class ChecksFailed(ValueError):
    """A batch broke declared rules, so it was not published."""

    def __init__(self, location: str, failures: dict[str, int]):
        told = ", ".join(f"{name}: {n} row(s)" for name, n in failures.items())
        super().__init__(f"{location} was left as it was; the batch breaks {told}")
        self.failures = failures


def staged_batch(spark: SparkSession, batch: DataFrame, path: str, location: str,
                 partition_column: str, checks: Sequence[Rule]) -> tuple[DataFrame, list, int]:
    """Write a batch to ``path`` and read it back: (batch, its days, its rows).
    Size, days and the failures of the ``checks`` come out of that write; a
    ``unique`` rule is counted on the staged copy. A batch that fails is
    removed and refused."""
    rules = counters(checks)
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    (batch.hint("rebalance", partition_column)
          .observe(obs, F.count(F.lit(1)).alias("rows"),
                   F.collect_set(F.col(partition_column)).alias("days"),  # a batch's partitions
                   *[expr.alias(name) for name, expr in rules.items()])
          .write.mode("overwrite").parquet(path))
    staged = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
    told = obs.get
    failures = {name: int(told[name]) for name in rules if told[name]}
    for r in checks:
        if r.rule == "unique":
            n = (staged.where(F.col(r.column).isNotNull()).groupBy(r.column).count()
                 .where("count > 1").count())
            failures |= {f"unique({r.column})": n} if n else {}
    if failures:
        notes.remove(spark, [path])
        raise ChecksFailed(location, failures)
    return staged, list(told["days"]), int(told["rows"])


def delete_insert(spark: SparkSession, location: str, batch: DataFrame, keys: Sequence[str],
                  partition_column: str, operation: str = "delete+insert",
                  checks: Sequence[Rule] = ()) -> dict:
    """Keyed incremental merge: delete target rows whose key is in the batch,
    insert the batch.

    Keys absent from the batch survive, including on the batch's own days
    (a key that vanished in a rerun keeps its old row). Only the partitions
    the batch touches are rewritten, unless the batch brings other columns or
    wider types, in which case every partition is rewritten with the synced
    schema. A swap that an earlier run left unfinished is completed first. A
    batch that breaks a rule of ``checks`` is refused before the table is
    touched (:class:`ChecksFailed`).
    """
    recover(spark, location)
    stage = scratch_path(spark, "merge")
    b, days, n_batch = staged_batch(spark, batch, f"{stage}/batch", location, partition_column,
                                    checks)
    aligned, b, changed = sync_columns(read_table(spark, location, order=batch.columns), b)
    scope = aligned if changed else aligned.filter(F.col(partition_column).isin(days))
    kept = scope.join(b.select(*keys).distinct(), list(keys), "left_anti").select(*b.columns)
    merged = kept.unionByName(b)
    (merged.hint("rebalance", partition_column).write.mode("overwrite")
           .parquet(f"{stage}/merged"))
    swap_in(spark, location, f"{stage}/merged", "static" if changed else "dynamic",
            partition_column)
    notes.remove(spark, [stage])
    summary = {"keys": list(keys), "batch-records": n_batch,
               "partitions": sorted(str(d) for d in days), "schema-changed": changed}
    record_commit(spark, location, operation, summary)
    return summary


def write_full(spark: SparkSession, location: str, df: DataFrame, partition_column: str,
               operation: str = "overwrite", checks: Sequence[Rule] = ()) -> dict:
    """Replace the whole table (first build or full refresh). With ``checks``
    the rows are staged first and refused there if they break a rule."""
    if checks:
        stage = scratch_path(spark, "full")
        _, _, rows = staged_batch(spark, df, f"{stage}/batch", location, partition_column, checks)
        swap_in(spark, location, f"{stage}/batch", "static", partition_column)
        notes.remove(spark, [stage])
    else:
        obs = Observation(f"full_{uuid.uuid4().hex[:8]}")
        (df.hint("rebalance", partition_column)
           .observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.mode("overwrite").option("partitionOverwriteMode", "static")
           .option("compression", "zstd").partitionBy(partition_column).parquet(location))
        rows = int(obs.get["rows"])
    summary = {"added-records": rows}
    record_commit(spark, location, operation, summary)
    return summary


def write_repo_snapshot(records: DataFrame, root: str, run_date: dt.date,
                        date_column: str = "enriched_date") -> None:
    """NDJSON records of one run date in its folder. A rerun replaces that
    folder and no other, also when it has no records. JSON nulls are written
    out, as a serialiser would."""
    (records.where(F.col(date_column) == F.lit(run_date)).drop(date_column)
            .hint("rebalance").write.mode("overwrite").option("ignoreNullFields", "false")
            .json(f"{root.rstrip('/')}/{date_column}={run_date.isoformat()}"))
