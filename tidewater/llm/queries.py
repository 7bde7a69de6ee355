"""Registered queries of the subpackage: one ``opN_<name>`` per operator, each
over its whole table with production parameters, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (embeddings, fingerprint, language, minhash, mixing, negatives, packing,
                           personal, quality, substring, tokenfile, tokens, toxicity, variants)
from tidewater.llm.common import held_out, table
from tidewater.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def verdict(scored: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return verdict(toxicity.score_toxicity(docs, table(spark, sf_dir, "labels")), 5, 0)


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query
def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = language.identify_language(table(spark, sf_dir, "documents"))
    return got.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"),
                      "lang_pred", "score")


@query
def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring.remove_repeats(table(spark, sf_dir, "documents"), width=35)
    return got.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokens.tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op9_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfile.write_ids(table(spark, sf_dir, "documents"), tokens.tokenizer_file())
    pieces = tokenfile.read_ids(files).select(
        "range", "doc_no", "doc_id", "start", F.length("ids").alias("size"),
        F.struct("piece", F.crc32("ids").alias("crc"), F.length("ids").alias("size")).alias("part"))
    whole = pieces.groupBy("range", "doc_no").agg(
        F.max("doc_id").alias("doc_id"), F.min("start").alias("start"),
        (F.sum("size") / 4).cast("long").alias("n_tokens"),
        tokenfile.crc_of_pieces(F.collect_list("part")).alias("ids_crc32"))
    return whole.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdict(got, 3, 1)


@query
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variant_groups(variants.corpus_words(table(spark, sf_dir, "documents")))


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


@query
def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = personal.find_personal_data(table(spark, sf_dir, "documents"))
    base = personal.listed(F.col("base"))

    def number(kind: int) -> Column:
        of_kind = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{personal.KINDS[kind]}")
    return got.select(F.col("id").alias("doc_id"), *map(number, range(len(personal.KINDS))),
                      F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                      personal.listed(F.concat("base", "found")).alias("spans"),
                      F.size("found").cast("long").alias("n_found"))
