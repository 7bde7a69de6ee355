"""Document fingerprints: improbable-feature digests in chained Bloom filters.

Every byte window of a text has a Shannon entropy, and every entropy a rarity:
how seldom it occurs among all windows of the corpus. A window is a feature if
it is the rarest one of its neighbourhood often enough. Features are hashed
into small Bloom filters; a full filter is followed by the next one. Two
digests are compared filter by filter through the share of common bits beyond
what chance explains.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import range_starts, slices

WINDOW = 32           # bytes of a feature
NEIGHBOURS = 32       # windows among which the rarest one scores
SCORES = 8            # times a window must be the rarest
SHORT_TEXT = 400      # bytes; shorter texts have few such windows and add
SHORT = 6             # all windows of so many bytes
ENTROPIES = 1000      # steps of the entropy scale
FILTER_BYTES = 256
FILTER_FEATURES = 128
HASHES = 5
#: Windows are computed over this many bytes at a time.
CHUNK = 1 << 18

_n = np.arange(WINDOW + 1, dtype=float)
#: Fixed-point n log2 n, so that sums along a text are exact.
N_LOG_N = np.round(_n * np.log2(np.maximum(_n, 1)) * (1 << 20)).astype(np.int64)
GAIN = np.diff(N_LOG_N, prepend=0)  # of the n-th equal byte in a window


def window_entropies(data: np.ndarray) -> np.ndarray:
    """Entropy step (0..ENTROPIES) of every ``WINDOW``-byte window.

    As the window moves, one byte leaves and one enters; how often each occurs
    in its window comes from comparing the text with itself at every distance
    below ``WINDOW``. All steps are whole-array operations.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    entered = np.ones(len(data), np.uint8)  # equal bytes among the last WINDOW, itself included
    leaving = np.ones(len(data), np.uint8)  # the same among the next WINDOW
    for d in range(1, WINDOW):
        equal = data[d:] == data[:-d]
        entered[d:] += equal
        leaving[:-d] += equal
    first = N_LOG_N[np.bincount(data[:WINDOW], minlength=1)].sum()
    total = np.empty(n, np.int64)
    total[0] = first
    if n > 1:
        total[1:] = first + np.cumsum(GAIN[entered[WINDOW:]] - GAIN[leaving[:n - 1]])
    top = N_LOG_N[WINDOW]
    return (top - total) * ENTROPIES // top


def rarity_ranks(texts: DataFrame) -> np.ndarray:
    """Rank of each entropy step by its number of windows over the whole
    corpus, rarest first; steps that never occur come last, and so do the
    lowest entropies (runs of few different bytes), which say little."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENTROPIES + 1, np.int64)
        for batch in slices(batches):
            texts = [t.encode("utf-8") for t in batch["text"].to_pylist()]
            ends = np.cumsum([len(t) for t in texts])
            data = np.frombuffer(b"".join(texts), np.uint8)
            # Windows that run over the end of a text don't count.
            within = np.zeros(len(data) + 1, np.int64)
            np.add.at(within, np.maximum(ends - WINDOW + 1, ends - np.diff(ends, prepend=0)), 1)
            np.add.at(within, ends, -1)
            within = np.cumsum(within)[:-1] == 0
            for at in range(0, max(0, len(data) - WINDOW + 1), CHUNK):
                step = window_entropies(data[at:at + CHUNK + WINDOW - 1])
                total += np.bincount(step[within[at:at + len(step)]], minlength=ENTROPIES + 1)
        yield pa.RecordBatch.from_pydict({"step": pa.array(np.arange(ENTROPIES + 1)),
                                          "n": pa.array(total)})

    rows = (texts.select("text").mapInArrow(count, "step long, n long").groupBy("step")
            .agg(F.sum("n").alias("n")).orderBy("step").collect())
    n = np.zeros(ENTROPIES + 1, np.int64)
    for r in rows:
        n[r["step"]] = r["n"]
    low = np.arange(ENTROPIES + 1) < ENTROPIES // 5
    order = np.lexsort((np.arange(ENTROPIES + 1), n, (n == 0) | low))
    ranks = np.empty(ENTROPIES + 1, np.int64)
    ranks[order] = np.arange(ENTROPIES + 1)
    return ranks


def features(data: np.ndarray, ranks: np.ndarray) -> list[bytes]:
    """The improbable windows of a text, in text order; a short text adds all
    its ``SHORT``-byte windows (one at least, if it isn't empty)."""
    text = data.tobytes()
    out = []
    for at in range(0, len(data), CHUNK):
        piece = data[at:at + CHUNK + WINDOW + NEIGHBOURS]
        rank = ranks[window_entropies(piece)]
        n = len(rank) - NEIGHBOURS + 1
        if n <= 0:
            break
        key = rank << 20 | np.arange(len(rank))  # rarest first, leftmost of equals
        span = 1
        while span * 2 <= NEIGHBOURS:
            key, span = np.minimum(key[:-span], key[span:]), span * 2
        wins = np.bincount(key[:CHUNK] & 0xFFFFF)
        out += [text[at + k:at + k + WINDOW] for k in np.flatnonzero(wins >= SCORES).tolist()]
    if text and (len(text) < SHORT_TEXT or not out):
        out += [text[k:k + SHORT] for k in range(max(1, len(text) - SHORT + 1))]
    return list(dict.fromkeys(out))


def digest(data: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """Chained Bloom filters over the features of a text."""
    found = features(data, ranks)
    filters = []
    for at in range(0, len(found), FILTER_FEATURES):
        bits = np.zeros(FILTER_BYTES * 8, np.uint8)
        h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, found[at:at + FILTER_FEATURES])),
                          np.uint16).reshape(-1, 8)[:, :HASHES]
        bits[(h & (FILTER_BYTES * 8 - 1)).ravel()] = 1
        filters.append(np.packbits(bits))
    return filters


def written(filters: list[np.ndarray]) -> str:
    """A digest as text: the number of filters, then their bits."""
    return f"{len(filters)}:" + base64.b64encode(b"".join(f.tobytes() for f in filters)).decode()


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> float:
    """0..1: each filter of the shorter digest takes its best partner; common
    bits count from what chance gives to what the sparser one could share.
    Two empty digests are alike, an empty and another one are not."""
    if not a or not b:
        return float(not a and not b)
    a, b = sorted((a, b), key=len)
    x, y = (np.unpackbits(np.stack(f), axis=1).astype(np.float32) for f in (a, b))
    common, nx, ny = x @ y.T, x.sum(1)[:, None], y.sum(1)[None, :]
    chance, most = nx * ny / x.shape[1], np.minimum(nx, ny)
    score = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    weight = nx[:, 0] / nx.sum()
    return float(min(1.0, (score.max(1) * weight).sum()))


def in_key_order(rows: DataFrame, starts: list[int]) -> DataFrame:
    """Rows dealt by key range, each range sorted in one partition. The first
    rows of a range also visit the range before it (the first of all the
    last), as guests at its end, so that every row meets its successor."""
    n = max(1, len(starts))

    @F.arrow_udf("array<long>")
    def visits(keys: pa.Array) -> pa.Array:
        k = keys.to_numpy()
        first = np.array(starts or [0], np.int64)
        home = np.maximum(np.searchsorted(first, k, "right") - 1, 0)
        opens = first[home] == k
        return pa.array([[h, (h - 1) % n + n] if o else [h]
                         for h, o in zip(home.tolist(), opens.tolist())], pa.list_(pa.int64()))

    placed = (rows.withColumn("visit", F.explode(visits("key")))
              .withColumn("guest", F.col("visit") >= n)
              .withColumn("range", (F.col("visit") % n).cast("int")))
    return (placed.repartitionById(n, "range")
            .sortWithinPartitions("range", "guest", "key", "text")
            .select("range", "guest", "doc_id", "text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 edit_part: int = 4) -> DataFrame:
    """One row per document: (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next).

    The edited text has its last floor(n_chars / edit_part) code points
    replaced by the first as many (or all) of the next document's, in ascending
    id order; the first document follows the last. A null text is an empty
    text, whose digest is empty (like another empty one, unlike any other).
    Null ids come first in order, repeated ids follow each other by text. A
    lone row is its own next document. Equal texts have equal fingerprints
    within one corpus. Other columns are not read; an empty table gives no
    rows.
    """
    doc_id = F.col(id_col).cast("long")
    rows = docs.select(doc_id.alias("doc_id"),
                       F.coalesce(doc_id, F.lit(-(1 << 63)).cast("long")).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranks = rarity_ranks(rows)
    starts = range_starts(rows.select("key"), max(8, 2 * rows.rdd.getNumPartitions()))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def encoded(text: str) -> tuple[np.ndarray, list[np.ndarray]]:
            data = np.frombuffer(text.encode("utf-8"), np.uint8)
            return data, digest(data, ranks)

        def row(one: tuple, following: tuple) -> dict:
            doc_id, text, own = one
            cut = len(text) // edit_part
            edited = text[:len(text) - cut] + following[1][:cut]
            data, changed = encoded(edited)
            return {"doc_id": doc_id, "n_chars": len(text),
                    "edited_sha256": hashlib.sha256(data.tobytes()).hexdigest(),
                    "fingerprint": written(own), "edited_fingerprint": written(changed),
                    "near_edited": likeness(own, changed),
                    "near_next": likeness(own, following[2])}

        last, out = None, []
        for batch in batches:
            for guest, doc_id, text in zip(*(batch[c].to_pylist()
                                             for c in ("guest", "doc_id", "text"))):
                if guest and last is None:
                    continue  # another row with the id that opens the next range
                one = (doc_id, text, encoded(text)[1])
                if last is not None:
                    out.append(row(last, one))
                last = None if guest else one
                if len(out) >= 128:
                    yield pa.RecordBatch.from_pylist(out, SCHEMA)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, SCHEMA)

    return in_key_order(rows, starts).mapInArrow(digested, DDL)


DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
       "edited_fingerprint string, near_edited double, near_next double")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()),
                    ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64())])
