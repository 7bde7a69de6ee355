"""Corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
its result is written as Parquet and read back as the next stage's ``docs``.
All but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import minhash, mixing, packing, substring, tokens, toxicity
from tidewater.llm.common import landed, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or higher for toxicity go."""
    prepare(spark)
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), out_col="_toxicity")
    return scored.where("_toxicity < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies (five-word shingles,
    similarity 0.8 or more) stays, that of the smallest id; of repeated rows
    one. Documents without an id cannot be told apart: they stay if one does."""
    prepare(spark)
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id"))
    kept = kept.distinct()
    return (docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")
            .dropDuplicates(["doc_id", "text"]))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a passage of 35 words that starts anywhere else too go
    from their texts; the documents stay."""
    prepare(spark)
    cut = substring.without_repeats(docs, width=35)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, as repeated rows. Rows that
    share an id go by the largest number of copies among them."""
    prepare(spark)
    taken = (mixing.mix_sources(docs).where("copies > 0")
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").alias("_copies")))
    picked = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]))
    return (picked.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
            .select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    prepare(spark)
    return packing.pack_documents(docs, tokens.tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages fit models, hash and sample; tests check each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
