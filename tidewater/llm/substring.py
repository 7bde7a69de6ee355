"""Substring dedup: an FM-index per shard, streamed by backward search.

A window of ``width`` words can only repeat where its minimizer (the word
n-gram of smallest hash inside it) repeats. Consecutive windows with the same
minimizer form a segment; segments whose minimizer occurs once in the corpus
are done. The others are sharded by minimizer, so that all occurrences of a
window meet in one shard and every window of the corpus is in exactly one
segment. A shard keeps each distinct segment once, weighted by its number of
occurrences, in an FM-index (suffix order, Burrows-Wheeler transform, wavelet
matrix of packed bits), and streams its segments through backward search: the
matching statistics say how far a run of words occurs more than once, and runs
of at least ``width`` words are reported as intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (U64, drop_stores, landed, ngram_hashes, slices, word_hashes,
                                  words_of)

#: Words of a minimizer; windows of a segment share one.
ANCHOR = 6
#: Words that a shard's index holds about.
SHARD_WORDS = 400_000
PROBE = 4
#: Minimizers broadcast at most, since each of them has this share of all places.
HOT_SHARE = 1000


# -- segments ----------------------------------------------------------------

def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    m, span = x, 1
    while span * 2 <= width:
        m, span = np.minimum(m[:-span], m[span:]), span * 2
    rest = width - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, number of windows) of each maximal run of
    windows with the same leftmost minimizer."""
    if len(h) < width:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    anchor = min(ANCHOR, width)
    grams = ngram_hashes(h, anchor)
    order = np.argsort(grams, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = order[sliding_min(rank, width - anchor + 1)]
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return grams[at[start]], start, np.diff(np.append(start, len(at)))


# -- index -------------------------------------------------------------------

class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector per bit of the
    alphabet, with running counts per 64-bit word."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        row = symbols
        for level in range(bits - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            padded[:len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(U64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((level, words, counts, len(bit) - int(bit.sum())))
            row = np.concatenate([row[~bit], row[bit]])
        # Where each symbol's run starts at the bottom.
        present, first = np.unique(row, return_index=True)
        self.bottom = np.zeros(1 << bits, np.int64)
        self.bottom[present] = first

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        for level, words, counts, zeros in self.levels:
            word = at >> 6
            below = (U64(1) << (at & 63).astype(U64)) - U64(1)
            ones = counts[word] + np.bitwise_count(words[word] & below)
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at - self.bottom[symbol]


class FMIndex:
    """Backward search over weighted sequences of 64-bit words."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, depth: int):
        ends = np.cumsum([len(s) + 1 for s in sequences])
        owner = np.repeat(np.arange(len(sequences)), np.diff(ends, prepend=0))
        self.alphabet, codes = np.unique(np.concatenate(sequences), return_inverse=True)
        text = np.zeros(int(ends[-1]), np.int64)
        mark = np.ones(len(text), bool)
        mark[ends - 1] = False
        text[mark] = codes + 1
        order = self.suffix_order(text, depth)
        self.size = len(text)
        self.bits = max(1, int(len(self.alphabet)).bit_length())
        bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text,
                                                                 minlength=1 << self.bits))])
        self.wavelet = WaveletMatrix(bwt, self.bits)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])

    @staticmethod
    def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffixes in order of their first ``depth`` symbols at least, by
        prefix doubling; search for patterns up to that length needs no more."""
        rank, length = text.copy(), 1
        order = np.argsort(rank, kind="stable")
        while length < depth:
            following = np.zeros(len(rank), np.int64)
            following[:-length] = rank[length:] + 1
            key = rank * (len(rank) + 2) + following
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(len(rank), np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
            length *= 2
        return order

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for a word that the index does not hold."""
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, 0)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each match with one more symbol on its left."""
        first = self.before[symbol]
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        lo, hi = first + both[:len(lo)], first + both[len(lo):]
        return lo, np.where(symbol == 0, lo, hi)


def repeated_windows(index: FMIndex, streams: list[np.ndarray], need: int, width: int
                     ) -> np.ndarray:
    """For all streams put end to end, which positions start a window that the
    index holds with weight ``need`` at least.

    All streams advance together, one word to the left per step. A run that
    cannot be extended rules out every window over it; a short probe at the
    failing word then often rules out far more windows at once.
    """
    ends = np.cumsum([len(s) for s in streams])
    starts = ends - [len(s) for s in streams]
    text = index.codes(np.concatenate(streams))
    found = np.zeros(len(text), bool)
    first, end = starts.copy(), ends - 1
    at, lo, hi = end.copy(), np.zeros(len(end), np.int64), np.full(len(end), index.size)
    probe = np.full(len(end), -1)  # the word at which the run failed, while probing
    live = np.flatnonzero(end - first + 1 >= width)
    while len(live):
        pos, failed_at = at[live], probe[live]
        new_lo, new_hi = index.extend(text[pos], lo[live], hi[live])
        ok = index.weight[new_hi] - index.weight[new_lo] >= need
        probing = failed_at >= 0
        run = ok & ~probing
        found[pos[run & (end[live] - pos + 1 >= width)]] = True
        lo[live], hi[live], at[live] = new_lo, new_hi, pos - 1
        last = end[live]
        to = np.full(len(live), -1)  # new right end of streams that start over
        broke = ~ok & ~probing
        long = broke & (last - pos >= PROBE)
        to[broke & ~long] = last[broke & ~long] - 1
        to[probing & ~ok] = failed_at[probing & ~ok] + PROBE - 2
        whole = probing & ok & (pos == failed_at)
        to[whole] = last[whole] - 1
        begin = live[long]
        probe[begin] = pos[long]
        at[begin] = pos[long] + PROBE - 1
        lo[begin], hi[begin] = 0, index.size
        again = to >= 0
        begin = live[again]
        end[begin] = at[begin] = to[again]
        lo[begin], hi[begin], probe[begin] = 0, index.size, -1
        over = (run & (pos == first[live])) | (again & (to - first[live] + 1 < width))
        live = live[~over]
    return found


def shard_intervals(group: pd.DataFrame, width: int) -> pd.DataFrame:
    """(sid, first, last) of repeated windows, as intervals within a segment.
    A group holds the block that is indexed and the block that is streamed;
    against its own block a window must occur twice, against another once."""
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    group = group.sort_values("sid")
    held, streamed = group[group["block"] == i], group[group["block"] == j]
    if not len(held) or not len(streamed):
        return pd.DataFrame({"sid": [], "first": [], "last": []})
    words = {sid: np.frombuffer(w, U64) for sid, w in zip(group["sid"], group["words"])}
    index = FMIndex([words[s] for s in held["sid"]], held["weight"].to_numpy(np.int64), width)
    streams = [words[s] for s in streamed["sid"]]
    found = repeated_windows(index, streams, 2 if i == j else 1, width)
    ends = np.cumsum([len(s) for s in streams])
    owner = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    at = np.flatnonzero(found)
    if not len(at):
        return pd.DataFrame({"sid": [], "first": [], "last": []})
    cut = np.concatenate([[True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])
    first, last = at[cut], at[np.append(np.flatnonzero(cut)[1:] - 1, len(at) - 1)]
    base = (ends - [len(s) for s in streams])[owner[first]]
    return pd.DataFrame({"sid": streamed["sid"].to_numpy()[owner[first]],
                         "first": first - base, "last": last - base})


# -- the jobs ----------------------------------------------------------------

def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def scanned(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, tid, n_words, sha, keys) of (doc_id, tid, text)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_stores()
        for batch in slices(batches):
            n, sha, keys = [], [], []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                n.append(len(words))
                sha.append(digest(words))
                keys.append(segments(word_hashes(words), width)[0].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tid"], pa.array(n, pa.int64()), pa.array(sha),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "tid", "n_words", "sha", "keys"])
    return docs.mapInArrow(scan, "doc_id long, tid long, n_words long, sha string, "
                                 "keys array<long>")


def segment_rows(texts: DataFrame, width: int, with_words: bool) -> DataFrame:
    """The wanted segments (by number, in ``wanted``) of each distinct text:
    (tid, seg, start, sid, key) or, as payload, (sid, words)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_stores()
        for batch in slices(batches, 64):
            out: dict[str, list] = {k: [] for k in ("tid", "seg", "start", "sid", "key", "words")}
            for tid, text, wanted in zip(batch["tid"].to_pylist(), batch["text"].to_pylist(),
                                         batch["wanted"].to_pylist()):
                h = word_hashes(words_of(text))
                key, start, count = segments(h, width)
                for k in wanted:
                    piece = h[start[k]:start[k] + count[k] + width - 1].tobytes()
                    out["tid"].append(tid)
                    out["seg"].append(k)
                    out["start"].append(int(start[k]))
                    out["sid"].append(xxhash.xxh3_64_intdigest(piece) - (1 << 63))
                    out["key"].append(int(key[k].view(np.int64)))
                    out["words"].append(piece if with_words else None)
            names = ["sid", "words"] if with_words else ["tid", "seg", "start", "sid", "key"]
            types = {"words": pa.binary()}
            yield pa.RecordBatch.from_pydict(
                {c: pa.array(out[c], types.get(c, pa.int64())) for c in names})
    return texts.mapInArrow(rows, "sid long, words binary" if with_words else
                            "tid long, seg long, start long, sid long, key long")


def cut_texts(texts: DataFrame, width: int) -> DataFrame:
    """(tid, n_removed, kept_sha, kept) of texts with the intervals of their
    repeated windows."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_stores()
        for batch in slices(batches, 64):
            removed, shas, kept_texts = [], [], []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                words = words_of(text)
                edge = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    edge[s["a"]] += 1
                    edge[s["b"] + width] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                kept = [w for w, g in zip(words, gone) if not g]
                removed.append(int(gone.sum()))
                shas.append(digest(kept))
                kept_texts.append(b" ".join(kept).decode("utf-8"))
            yield pa.RecordBatch.from_arrays(
                [batch["tid"], pa.array(removed, pa.int64()), pa.array(shas),
                 pa.array(kept_texts, pa.string())],
                names=["tid", "n_removed", "kept_sha", "kept_text"])
    return texts.mapInArrow(cut, "tid long, n_removed long, kept_sha string, kept_text string")


def text_id(text: str) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_parts(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(scan, cuts): the scan holds one row per document, cuts one row per
    distinct text that loses words."""
    texts = docs.withColumn("tid", text_id("text"))
    scan = landed(scanned(texts.select("doc_id", "tid", "text"), width), "substring-scan")

    repeated = landed(scan.select(F.explode("keys").alias("key")).groupBy("key")
                      .agg(F.count("*").alias("n")).where("n > 1"), "substring-repeated")
    # A key of more than one in HOT_SHARE places is hot. There are at most
    # HOT_SHARE of them, so they are broadcast and their places stay where they are.
    total = scan.agg(F.sum(F.size("keys"))).first()[0] or 0
    hot = repeated.where(F.col("n") * HOT_SHARE > total).select("key")
    places = scan.select("tid", F.posexplode("keys").alias("seg", "key"))
    in_hot = places.join(F.broadcast(hot), "key", "left_semi")
    in_cold = (places.join(F.broadcast(hot), "key", "left_anti")
               .join(repeated.select("key"), "key", "left_semi"))
    wanted = (in_hot.union(in_cold).select("tid", "seg").distinct()
              .groupBy("tid").agg(F.collect_list("seg").alias("wanted")))
    copies = scan.groupBy("tid").agg(F.count("*").alias("copies"))
    # One text of each content: copies meet their like map-side first.
    once = texts.groupBy("tid").agg(F.first("text").alias("text"))
    shared = landed(once.join(wanted, "tid"), "substring-shared")

    places = landed(segment_rows(shared, width, False).join(copies, "tid"), "substring-places")
    distinct = places.groupBy("sid").agg(
        F.sum("copies").alias("weight"), F.min(F.struct("tid", "seg")).alias("owner"),
        F.min("key").alias("key"))
    distinct = landed(distinct, "substring-distinct")
    owners = (distinct.select("owner.tid", "owner.seg").groupBy("tid")
              .agg(F.collect_list("seg").alias("wanted")))
    payload = segment_rows(shared.select("tid", "text").join(owners, "tid"), width, True)

    # Shards of about SHARD_WORDS; a shard that a hot minimizer overfills is
    # dealt over blocks, and every pair of its blocks is a group of its own.
    total = distinct.count() * (width + 15)
    shards = max(1, -(-total // SHARD_WORDS))
    sharded = distinct.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    blocks = sharded.groupBy("shard").agg(
        F.ceil(F.count("*") * (width + 15) / (4.0 * SHARD_WORDS)).alias("blocks"))
    dealt = (payload.join(sharded.select("sid", "weight", "shard"), "sid").join(blocks, "shard")
             .withColumn("block", F.pmod(F.xxhash64("sid"), "blocks"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .withColumn("pair", F.explode(F.when(
                 F.col("block") == F.col("other"),
                 F.array(F.struct(F.col("block").alias("i"), F.col("block").alias("j"))))
                 .otherwise(F.array(F.struct(F.col("block").alias("i"), F.col("other").alias("j")),
                                    F.struct(F.col("other").alias("i"), F.col("block").alias("j"))))))
             .select("shard", "pair.i", "pair.j", "block", "sid", "weight", "words")
             .withColumn("cell", F.xxhash64("shard", "i", "j")))
    found = landed(dealt.groupBy("cell").applyInPandas(
        lambda group: shard_intervals(group, width), "sid long, first long, last long"),
        "substring-intervals")

    spans = (places.select("tid", "start", "sid").join(found, "sid")
             .select("tid", F.struct((F.col("start") + F.col("first")).alias("a"),
                                     (F.col("start") + F.col("last")).alias("b")).alias("span"))
             .groupBy("tid").agg(F.collect_list("span").alias("spans")))
    cuts = landed(cut_texts(shared.select("tid", "text").join(spans, "tid"), width),
                  "substring-cuts")
    return scan, cuts


def remove_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_words, n_removed, kept_sha256,
    kept_text); kept_text is null where nothing was removed.

    Every word covered by a window of ``width`` words whose sequence starts
    anywhere else in the table too (same document included) is removed;
    windows are judged on the input. Words are runs without ASCII white space;
    null and empty texts have none. Repeated rows repeat each other, so all of
    their windows go. Ids are carried, not compared: null and repeated ids are
    ordinary. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    scan, cuts = repeated_parts(rows, width)
    return (scan.select("doc_id", "tid", "n_words", "sha").join(cuts, "tid", "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept_text"))


def without_repeats(docs: DataFrame, width: int = 35, text_col: str = "text") -> DataFrame:
    """``docs`` with the same rows and columns, the text of documents that lose
    words replaced by the words kept, joined by one space; all other texts
    stay as they are. The rules are those of :func:`remove_repeats`."""
    _, cuts = repeated_parts(docs.select(F.lit(0).cast("long").alias("doc_id"),
                                         F.col(text_col).alias("text")), width)
    whole = docs.select(F.struct(*docs.columns).alias("row"), text_id(text_col).alias("tid"))
    joined = whole.join(cuts.select("tid", "kept_text"), "tid", "left")
    return joined.select(*(F.coalesce("kept_text", F.col("row")[c]).alias(c) if c == text_col
                           else F.col("row")[c].alias(c) for c in docs.columns))
