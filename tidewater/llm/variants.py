"""Spelling variant grouping by asymmetric q-chunks.

Two words are near if one code point inserted, deleted or replaced turns one
into the other. The longer of the two (either, at equal length) contributes
two disjoint chunks, its halves; the other contributes positional grams of the
same lengths. One edit leaves one of the chunks whole, and moves it by one
place at most, so near words share a chunk with a gram within that shift; of
all positional grams only those at such a place are written. Pairs that meet
are verified on the whole words.

A chunk that very many words share is not joined as it is: its words still
differ by one edit in the half that is left, so that half is chunked again,
and again, until the groups are small. In the last step words agree in all
places but one, and there are only as many of those as the alphabet has signs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import landed, slices

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
#: Distinct words a task holds before it hands on their counts.
HELD_WORDS = 200_000
#: A key with more pairs than this is chunked again.
PAIRS_PER_KEY = 50_000


def runs_of(text: str | None) -> Counter:
    """Maximal runs of letters of a whole text with their numbers, A-Z lower-cased."""
    if not text:
        return Counter()
    # Lower-casing bytes touches A-Z only.
    return Counter(RUNS.findall(text.encode("utf-8", "replace").lower().decode()))


def altered(run: str, prefix_crc: int, every: int) -> str:
    """The run, less one code point where ``every`` divides the checksum of
    ``<doc_id>:<run>`` (continued here from that of its prefix)."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % every:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_length: int = 5, min_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n) of a table of documents: all runs of letters of whole texts,
    altered as :func:`altered` says, of ``min_length`` code points and
    ``min_count`` occurrences at least. A null text has no word; a null id is
    written as empty text; repeated rows count each."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()),
                                               "k": pa.array(list(held.values()), pa.int64())})
        for batch in slices(batches):
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                crc = zlib.crc32(f"{doc}:".encode())
                for run, k in runs_of(text).items():
                    word = altered(run, crc, every)
                    if len(word) >= min_length:
                        held[word] += k
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    return (rows.mapInArrow(counted, "word string, k long")
            .groupBy("word").agg(F.sum("k").alias("n")).where(F.col("n") >= min_count))


def key_of(first: Column, last: Column) -> Column:
    """Key of what words share if their edit lies in the places [first, last)
    of the longer one, of ``size`` places: all before and all after."""
    return F.xxhash64("size", first, last, F.left("word", first),
                      F.right("word", F.col("size") - last))


def halved(rows: DataFrame) -> DataFrame:
    """Each row twice, its edit in the first or in the second half of the
    places it had."""
    middle = F.col("first") + F.floor((F.col("last") - F.col("first")) / 2).cast("int")
    halves = F.array(F.struct(F.col("first").alias("first"), middle.alias("last")),
                     F.struct(middle.alias("first"), F.col("last").alias("last")))
    return (rows.withColumn("half", F.explode(halves))
            .select("word", "n", "size", F.col("half.first").alias("first"),
                    F.col("half.last").alias("last"))
            .withColumn("key", key_of(F.col("first"), F.col("last"))))


def verified(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """Pairs (word, n, near, near_n) that meet in a key and differ by exactly
    one edit. A pair meets once: its edit counts for the half that holds the
    first place where the two differ."""
    c, g = chunks.alias("c"), grams.alias("g")
    last = F.col("c.last")
    met = c.join(g, "key").where(
        (F.col("c.size") == F.col("g.size")) & (F.col("c.first") == F.col("g.first"))
        & (last == F.col("g.last"))
        & ((F.length("c.word") > F.length("g.word")) | (F.col("c.word") < F.col("g.word")))
        & ((last == F.col("c.size")) | (F.left("c.word", last) != F.left("g.word", last)))
        & (F.levenshtein("c.word", "g.word", 1) == 1))
    return met.select(F.col("c.word").alias("word"), F.col("c.n").alias("n"),
                      F.col("g.word").alias("near"), F.col("g.n").alias("near_n"))


def near_words(words: DataFrame, pairs_per_key: int = PAIRS_PER_KEY) -> DataFrame:
    """(word, n, near, near_n) for every pair of near words of ``words`` (word,
    n; words distinct, of two code points or more), each pair once."""
    length = F.length("word")
    whole = [F.lit(0).alias("first"), F.col("size").alias("last")]
    chunks = halved(words.select("word", "n", length.alias("size")).select("*", *whole))
    grams = halved(words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
                   .select("*", *whole))
    found = None
    while True:
        chunks, grams = landed(chunks, "variant-chunks"), landed(grams, "variant-grams")
        # Rows per key on both sides; a key is hot if its pairs are too many
        # and its places can still be halved.
        hot = (chunks.groupBy("key").agg(F.count("*").alias("c"),
                                         F.max(F.col("last") - F.col("first")).alias("places"))
               .join(grams.groupBy("key").agg(F.count("*").alias("g")), "key")
               .where((F.col("c") * F.col("g") > pairs_per_key) & (F.col("places") > 1))
               .select("key"))
        hot = landed(hot, "variant-hot")
        pairs = verified(chunks.join(hot, "key", "left_anti"), grams.join(hot, "key", "left_anti"))
        found = pairs if found is None else found.unionByName(pairs)
        if hot.isEmpty():
            return found
        chunks = halved(chunks.join(hot, "key", "left_semi"))
        grams = halved(grams.join(hot, "key", "left_semi"))


def followed(links: DataFrame) -> DataFrame:
    """(word, root) of ``links`` (word, form): forms followed to the last one.
    Each round doubles the steps taken; a form has at least twice the
    occurrences of its word, so a chain is short and has no loop."""
    state = landed(links.select("word", F.coalesce("form", "word").alias("root")), "variant-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = landed(state.join(ahead, "root").select("word", F.col("next").alias("root"),
                                                          (F.col("next") != F.col("root"))
                                                          .alias("moved")), "variant-roots")
        if stepped.where("moved").isEmpty():
            return stepped.select("word", "root")
        state = stepped.select("word", "root")


def variant_groups(words: DataFrame, pairs_per_key: int = PAIRS_PER_KEY) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near,
    form_n.

    ``form`` is the near word of largest n (ties: the smallest in code-point
    order) if that is at least twice the word's n, else null; ``root`` is the
    last form reached from the word, itself if it has none. Null words take
    no part and repeated ones are added up; other columns are ignored. An
    empty table gives an empty result.
    """
    words = landed(words.where(F.col("word").isNotNull() & (F.length("word") > 1))
                   .groupBy("word").agg(F.sum("n").cast("long").alias("n")), "variant-words")
    pairs = landed(near_words(words, pairs_per_key), "variant-pairs")
    both = pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
        F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("b"))
    enough = -F.col("b.less") >= 2 * F.col("n")
    formed = landed(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("b.near")).alias("form"),
        F.when(enough, -F.col("b.less")).alias("form_n")), "variant-forms")
    return formed.join(followed(formed), "word").select("word", "form", "root", "n", "n_near",
                                                        "form_n")
