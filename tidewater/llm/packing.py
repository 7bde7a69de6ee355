"""Packing documents into sequences by first-fit decreasing.

Documents are dealt at random over groups of about ``GROUP_DOCS``; each group
packs on its own. A document's full sequences stand alone; what remains of
each document is placed, longest first, into the first sequence with room,
found by descending a tournament tree of the free room. In the end the
emptiest sequences are taken apart and cut to fill the gaps of the others, so
that at most one sequence of a group is not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import landed, slices
from tidewater.llm.tokens import END_ID, Encoder

GROUP_DOCS = 1500
#: Rows equal in id and text that lie in one group for certain, at most.
EQUAL_ROWS = 16


class TournamentTree:
    """Free room of bins; a parent holds the larger of its children."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``, which it then holds."""
        at = 1
        while at < self.leaves:
            at *= 2
            if self.room[at] < size:
                at += 1
        leaf = at
        self.room[at] -= size
        while at > 1:
            at //= 2
            self.room[at] = max(self.room[2 * at], self.room[2 * at + 1])
        return leaf - self.leaves


def first_fit_decreasing(sizes: np.ndarray, room: int) -> list[list[int]]:
    """Bins as lists of item numbers."""
    tree = TournamentTree(len(sizes), room)
    bins: list[list[int]] = []
    for k in np.argsort(-sizes, kind="stable").tolist():
        b = tree.place(int(sizes[k]))
        if b == len(bins):
            bins.append([])
        bins[b].append(k)
    return bins


def fill_gaps(bins: list[list[tuple[int, int, int]]], room: int
              ) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) pieces: the emptiest bins give theirs,
    cut where needed, to the gaps of the others, fullest first."""
    bins = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    free = [room - sum(p[2] for p in b) for b in bins]
    to = 0
    while True:
        while to < len(bins) and free[to] == 0:
            to += 1
        if to >= len(bins) - 1:
            return bins
        item, start, length = bins[-1].pop()
        part = min(length, free[to])
        bins[to].append((item, start, part))
        free[to] -= part
        free[-1] += part
        if part < length:
            bins[-1].append((item, start + part, length - part))
        if not bins[-1]:
            bins.pop()
            free.pop()


def pack(sizes: np.ndarray, room: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start, length) pieces; each part of each item lies
    in exactly one."""
    full = [[(k, at, room)] for k, n in enumerate(sizes.tolist())
            for at in range(0, n - room + 1, room)]
    rest = sizes % room
    items = np.flatnonzero(rest)
    bins = [[(int(items[k]), int(sizes[items[k]] - rest[items[k]]), int(rest[items[k]]))
             for k in b] for b in first_fit_decreasing(rest[items], room)]
    return full + fill_gaps(bins, room)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, grp, copies, ids) with little-endian unsigned 16-bit ids, end
    id last."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(tokenizer), np.uint16(END_ID).tobytes()
        for batch in slices(batches):
            ids = [i + end for i in encoder.encode([t or "" for t in batch["text"].to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["grp"], batch["copies"], pa.array(ids, pa.binary())],
                names=["doc_id", "grp", "copies", "ids"])
    return docs.select("doc_id", "text", "grp", "copies").mapInArrow(
        encode, "doc_id long, grp long, copies long, ids binary")


def pack_group(group: pd.DataFrame, room: int) -> pd.DataFrame:
    group = group.loc[group.index.repeat(group["copies"])]
    group = group.sort_values(["doc_id", "ids"], kind="stable", na_position="first")
    ids = [np.frombuffer(i, np.uint16).astype("<u4") for i in group["ids"]]
    doc_ids = group["doc_id"].tolist()
    base = int(group["grp"].iloc[0]) << 32
    sequences = pack(np.array([len(i) for i in ids], np.int64), room)
    rows = [(doc_ids[k], start, length, len(ids[k]), base + s, offset,
             ids[k][start:start + length].tobytes())
            for s, pieces in enumerate(sequences)
            for (k, start, length), offset in
            zip(pieces, np.cumsum([0] + [p[2] for p in pieces]).tolist())]
    out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id",
                                      "offset", "ids"])
    return out.assign(doc_id=pd.array([None if pd.isna(d) else int(d) for d in out["doc_id"]],
                                      "Int64"))


def deal(rows: DataFrame, groups: int, seed: int) -> DataFrame:
    """``rows`` (doc_id, text) with their group and a number of copies: where
    more than ``EQUAL_ROWS`` rows are equal, one row stands for up to that many
    of them and each such row is dealt on its own."""
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    many = landed(hashed.groupBy(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"))
                  .count().where(F.col("count") > EQUAL_ROWS).drop("count"), "pack-equal")
    into = lambda *more: F.pmod(F.xxhash64("doc_id", "hash", F.lit(seed), *more), F.lit(groups))
    one = F.lit(1).cast("long").alias("copies")
    if many.isEmpty():
        return hashed.select("doc_id", "text", into().alias("grp"), one)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    size = F.lit(EQUAL_ROWS).cast("long")
    equal = (hashed.join(many, same, "left_semi").groupBy("doc_id", "text", "hash").count()
             .withColumn("part", F.explode(F.sequence(
                 F.lit(0).cast("long"), F.floor((F.col("count") - 1) / size)))))
    return (hashed.join(many, same, "left_anti").select("doc_id", "text", into().alias("grp"), one)
            .union(equal.select("doc_id", "text", into("part").alias("grp"),
                                F.least(size, F.col("count") - F.col("part") * size))))


def pack_documents(docs: DataFrame, tokenizer: str, room: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", seed: int = 11) -> DataFrame:
    """One row per piece: (doc_id, start, length, doc_tokens, sequence_id,
    offset, ids); ids are the piece's ids as little-endian unsigned 32-bit
    integers, offset its place in its sequence of at most ``room``.

    A null or empty text is the end id alone. Null and repeated ids and
    repeated rows are packed row by row, equal rows spread over groups. Very long texts are cut at multiples
    of ``room``. Groups depend on the rows' contents and ``seed`` only, so
    reruns agree. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text"))
    groups = max(1, -(-rows.count() // GROUP_DOCS))
    return encoded(deal(rows, groups, seed), tokenizer).groupBy("grp").applyInPandas(
        lambda group: pack_group(group, room),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
        "ids binary")
