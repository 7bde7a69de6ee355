"""Shared pieces of the operators: words, hashes, scratch tables, links."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import ensure_conventions, scratch_path

U64 = np.uint64
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Every stage ends in a written table, so its shuffle files can go with it.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words as the contracts define them, for Java and DuckDB regular expressions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings of this subpackage: UTC; shuffle files freed at the end
    of each execution; small Arrow batches, since single texts may be very long
    and a batch is held in memory whole."""
    ensure_conventions(spark)
    spark.conf.set(FREE_SHUFFLES, "true")
    if int(spark.conf.get(BATCH_ROWS, "10000")) > 1000:
        spark.conf.set(BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends
    there, and a lost executor costs no recomputation of earlier stages."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_crc(id_col: Column) -> Column:
    """crc32 of an id written as text (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary"))


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """True for ids of the held-out fold; a null id counts as held out, since
    nothing may be learned from a row that cannot be told apart."""
    return F.coalesce(id_crc(id_col) % modulus == remainder, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held: tuple[int, int],
                    max_rows: int, out: str) -> DataFrame:
    """(text, y, part) of at most ``max_rows`` labelled documents outside the
    ``held`` fold (modulus, remainder); part is a stable 0..9 split.

    The ids are those of smallest hash and each gives one row, of repeated ids
    that of the smallest text hash, so the bound on rows is exact and the
    choice does not depend on partitioning. It is one of documents, not of
    bytes: texts are whole. Null labels are skipped; a document with several
    labels takes the largest. The bounded label rows are broadcast; the
    documents are scanned once.
    """
    picked = (labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_y"))
              .where(F.col("_y").isNotNull() & F.col("_id").isNotNull())
              .where(~held_out(F.col("_id"), *held))
              .groupBy("_id").agg(F.max("_y").alias("_y"))
              .orderBy(F.xxhash64("_id", F.lit(17)), "_id").limit(max_rows))
    rows = (docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(picked), "_id")
            .groupBy("_id").agg(F.first("_y").alias("y"),
                                F.min_by("text", F.struct(F.xxhash64("text", F.lit(23)), "text"))
                                .alias("text"))
            .select("text", "y", F.pmod(F.xxhash64("_id", F.lit(29)), F.lit(10)).alias("part")))
    return landed(rows, out)


def words_of(text: str | None) -> list[bytes]:
    """Whole text to words: runs without space, tab, LF, VT, FF, CR. That is
    what ``bytes.split()`` cuts on; a null text has none."""
    return text.encode("utf-8", "replace").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value (wraps around)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return h[:0]
    out = mixed(h[:m])
    for k in range(1, n):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + h[k:k + m])
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a few rows, for work that holds several times the
    text in memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def worker_store(name: str, key: str = "") -> dict:
    """A dict that lives as long as the Python worker, across its tasks, until
    another name or ``key`` (the model it belongs to) is asked for, so that a
    worker holds one operator's cache at a time. It holds only what can be
    recomputed, never results."""
    module = sys.modules.setdefault("_tidewater_worker_store",
                                    types.ModuleType("_tidewater_worker_store"))
    stores = module.__dict__.setdefault("stores", {})
    if (name, key) not in stores:
        stores.clear()
        stores[name, key] = {}
    return stores[name, key]


def drop_stores() -> None:
    """Give up what :func:`worker_store` and Arrow's memory pool hold in this
    worker: called where the tasks of an operator without a cache begin, so
    that they don't run beside the cache of the one before."""
    module = sys.modules.get("_tidewater_worker_store")
    if module is not None and module.__dict__.get("stores"):
        module.stores.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def range_of(key: Column, starts: list[int]) -> Column:
    @F.arrow_udf("long")
    def at(keys: pa.Array) -> pa.Array:
        return pa.array(np.maximum(np.searchsorted(np.array(starts, np.int64),
                                                   keys.to_numpy(), "right") - 1, 0))
    return at(key)


def range_starts(keys: DataFrame, parts: int) -> list[int]:
    """Keys at which ranges of about equally many rows start, ``parts`` at
    most; each is the smallest key of its range."""
    cuts = keys.approxQuantile("key", [k / parts for k in range(parts)], 1 / (4 * parts))
    cuts = sorted({int(c) for c in cuts or []})
    if not cuts:
        return []
    least = keys.groupBy(range_of(F.col("key"), cuts).alias("range")).agg(F.min("key").alias("k"))
    return sorted(r["k"] for r in least.collect())


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b of long); root is
    the smallest node reachable.

    Alternating large-star and small-star steps; each step is one map-side
    combined ``min`` and one join that AQE may split on a hot node. Every
    round is landed in the shared scratch folder and compared with the one
    before by count and hash sum; only those two numbers reach the driver.
    """
    def linked(edges: DataFrame) -> DataFrame:
        return edges.where("a <> b").distinct()

    edges = landed(linked(links.select(F.greatest("a", "b").alias("a"),
                                       F.least("a", "b").alias("b"))), label)
    before = None
    while True:
        stat = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(stat) == before or stat[0] == 0:
            break
        before = tuple(stat)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = linked(both.where("b > a").join(least, "a")
                       .select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = landed(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")),
                       label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = landed(linked(small.union(least.select("a", F.col("m").alias("b")))
                              .select(F.greatest("a", "b").alias("a"),
                                      F.least("a", "b").alias("b"))), label)
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
