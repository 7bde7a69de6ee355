"""Quality classifier: Naive Bayes support vectors.

Binary indicators of word, byte and shape n-grams (hashed to a fixed number of
columns) are scaled by their log-count ratio between the classes; a linear
model with hinge loss is then fitted to the scaled indicators by dual
coordinate descent over a bounded sample. Scoring is one dot product per text.
A word of any length counts whole: its shape in successive pieces, its
characters, where the word is long, in runs of three.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import U64, labelled_sample, mixed, ngram_hashes, worker_store

BITS = 17
CACHED_WORDS = 600_000
CACHED_CHARS = 20_000_000
#: Signs of a shape that make one indicator; a longer shape is several.
PIECE = 12
#: Words over this many characters count by each of their three-character runs.
LONG_WORD = 24
UPPER, LOWER = re.compile("[A-ZÀ-ÖØ-Þ]+"), re.compile("[a-zß-öø-ÿ]+")


def word_shape(word: str) -> str:
    """The word with runs of capitals, small letters and digits as A, a, 9 and
    runs of one sign cut to two."""
    shape = re.sub(r"\d+", "9", LOWER.sub("a", UPPER.sub("A", word)))
    return re.sub(r"(\W)\1+", r"\1\1", shape)


def hashes(mark: str, parts: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(mark + p) for p in parts], U64)


class Indicators:
    """Columns of whole texts. Words seen so far keep the hashes of their word,
    last three characters and (first piece of their) shape in rows of
    ``table``; ``more`` has the other pieces and the three-character runs of
    those that are ``long``."""

    def __init__(self):
        self.ids: dict[str, int] = {}
        self.table = np.zeros((0, 3), U64)
        self.long = np.zeros(0, bool)
        self.more: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.chars = 0
        self.present = np.zeros(1 << BITS, bool)

    def codes(self, words: list[str]) -> np.ndarray:
        got = list(map(self.ids.get, words))
        if None in got:
            if len(self.ids) > CACHED_WORDS or self.chars > CACHED_CHARS:
                self.ids.clear()
                self.more.clear()
                self.chars = 0
                return self.codes(words)
            new = sorted({w for w, k in zip(words, got) if k is None})
            first = len(self.ids)
            if first + len(new) > len(self.table):
                grown = np.zeros((2 * (first + len(new)), 3), U64)
                grown[:first] = self.table[:first]
                self.table = grown
                self.long = np.resize(self.long, len(grown))
            for k, w in enumerate(new, first):
                self.ids[w] = k
                self.chars += len(w)
                shape = word_shape(w)
                self.table[k] = (xxhash.xxh3_64_intdigest("w" + w.lower()),
                                 xxhash.xxh3_64_intdigest("e" + w[-3:]),
                                 xxhash.xxh3_64_intdigest("s" + shape[:PIECE]))
                self.long[k] = len(shape) > PIECE or len(w) > LONG_WORD
                if self.long[k]:
                    runs = {w[i:i + 3] for i in range(len(w) - 2)} if len(w) > LONG_WORD else ()
                    self.more[k] = (
                        hashes("s", [shape[i:i + PIECE] for i in range(PIECE, len(shape), PIECE)]),
                        hashes("e", runs))
            got = list(map(self.ids.get, words))
        return np.array(got, np.int64)

    def columns(self, text: str) -> np.ndarray:
        """Sorted distinct columns: words, word ends (of long words every run
        of three characters), runs of one to three word shapes or pieces of
        them (a word that repeats the one before has a shape of its own), and
        how large a share of the lines repeats."""
        codes = self.codes(text.split())
        rows = self.table[codes]
        shapes = rows[:, 2].copy()
        again = np.concatenate([[False], codes[1:] == codes[:-1]])[:len(codes)]
        shapes[again] = U64(5)
        ends = [rows[:, 1]]
        at = np.flatnonzero(self.long[codes] & ~again)
        if len(at):
            pieces = [self.more[k] for k in codes[at].tolist()]
            ends += [runs for _, runs in pieces]
            shapes = np.insert(shapes, np.repeat(at + 1, [len(p) for p, _ in pieces]),
                               np.concatenate([p for p, _ in pieces]))
        lines = text.split("\n")
        repeated = int(8 * (1 - len(set(lines)) / len(lines)))
        parts = [mixed(rows[:, 0]), mixed(np.concatenate(ends)), mixed(np.array([repeated + 11], U64))]
        parts += [ngram_hashes(shapes, n) + U64(n) for n in (1, 2, 3)]
        at = (np.concatenate(parts) >> U64(64 - BITS)).astype(np.int32)
        self.present[at] = True
        distinct = np.flatnonzero(self.present).astype(np.int32)
        self.present[at] = False
        return distinct


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray,
                            c: np.ndarray, epochs: int, seed: int = 5) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM over rows of scaled indicators: each step solves one
    dual variable in closed form, clipped to [0, c]."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    norm = np.array([np.square(scale[r]).sum() + 1.0 for r in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            r = rows[k]
            x = scale[r]
            gradient = y[k] * (w[r] @ x + bias) - 1.0
            new = min(max(alpha[k] - gradient / norm[k], 0.0), c[k])
            step = (new - alpha[k]) * y[k]
            if step:
                w[r] += step * x
                bias += step
                alpha[k] = new
                moved = max(moved, abs(step) * norm[k])
        if moved < 0.01:
            break
    return w, bias


def fit(rows: list[np.ndarray], labels: np.ndarray, part: np.ndarray, epochs: int) -> QualityModel:
    """Log-count ratios, support vectors, and a logistic slope fitted on the
    margins of rows that were left out (all rows when those hold one class)."""
    def svm(of: np.ndarray) -> tuple[np.ndarray, float]:
        counts = np.ones((2, 1 << BITS)) * 0.5
        for k in np.flatnonzero(of):
            counts[labels[k], rows[k]] += 1
        n = np.array([(labels[of] == 0).sum(), (labels[of] == 1).sum()], float)
        p = counts / (n[:, None] + 1.0)
        ratio = np.clip(np.log(p[1]) - np.log(p[0]), -5, 5)
        share = np.where(labels[of] == 1, n.sum() / (2 * n[1]), n.sum() / (2 * n[0]))
        w, b = dual_coordinate_descent([rows[k] for k in np.flatnonzero(of)],
                                       labels[of] * 2.0 - 1.0, ratio, share, epochs)
        return w * ratio, b

    out = part >= 8
    if min(len(set(labels[out])), len(set(labels[~out]))) < 2:
        w, b = svm(np.ones(len(rows), bool))
        return QualityModel(w.astype(np.float32), b, 2.0, 0.0)
    w, b = svm(~out)
    margin = np.array([w[rows[k]].sum() + b for k in np.flatnonzero(out)])
    t, slope, offset = labels[out] * 0.98 + 0.01, 1.0, 0.0
    for _ in range(50):  # Newton steps of a two-parameter logistic fit
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = np.array([((p - t) * margin).sum() + 0.1 * (slope - 1), (p - t).sum() + 0.1 * offset])
        q = p * (1 - p)
        h = np.array([[(q * margin * margin).sum() + 0.1, (q * margin).sum()],
                      [(q * margin).sum(), q.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if abs(step).max() < 1e-6:
            break
    w, b = svm(np.ones(len(rows), bool))
    return QualityModel(w.astype(np.float32), b, max(slope, 1e-3), offset)


def fit_quality(sample: DataFrame, epochs: int) -> QualityModel | None:
    """One task fits the bounded sample and returns the fixed-size weights."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Indicators()
        for batch in batches:
            yield pa.RecordBatch.from_pydict({
                "columns": pa.array([seen.columns(t).tobytes()
                                     for t in batch["text"].to_pylist()], pa.binary()),
                "y": batch["y"].cast(pa.int32()), "part": batch["part"].cast(pa.int64())})

    def trained(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "y", "columns"])
        rows = [np.frombuffer(c, np.int32) for c in group["columns"]]
        labels = group["y"].to_numpy().astype(int)
        if len(set(labels)) < 2:
            return pd.DataFrame({"weights": [b""], "bias": [float(labels[0])], "slope": [0.0],
                                 "offset": [0.0]})
        m = fit(rows, labels, group["part"].to_numpy(), epochs)
        return pd.DataFrame({"weights": [m.weights.tobytes()], "bias": [m.bias],
                             "slope": [m.slope], "offset": [m.offset]})

    got = (sample.mapInArrow(hashed, "columns binary, y int, part long")
           .groupBy(F.lit(1).alias("all"))
           .applyInPandas(trained, "weights binary, bias double, slope double, offset double")
           .first())
    if got is None:
        return None
    return QualityModel(np.frombuffer(got["weights"], np.float32), got["bias"], got["slope"],
                        got["offset"])


def scored(text: Column, model: Broadcast) -> Column:
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m, seen = model.value, worker_store("quality").setdefault("seen", Indicators())
        for batch in batches:
            margin = np.array([m.weights[seen.columns(t or "")].sum() + m.bias
                               for t in batch.to_pylist()], float)
            yield pa.array(1 / (1 + np.exp(-np.clip(m.slope * margin + m.offset, -30, 30))))
    return run(text)


def score_quality(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (3, 1),
                  text_col: str = "text", max_rows: int = 12_000, epochs: int = 20) -> DataFrame:
    """One row per document: (doc_id, score), score in 0..1, higher for quality.

    ``labels`` (doc_id, quality) outside the ``held`` fold (modulus, remainder
    of crc32 of the id) teach, ``max_rows`` documents at most, chosen by id
    hash; labels other than 0 and 1 are left out. Every whole text is scored,
    words of any length included. Null and empty texts have the indicators of
    one empty line. Without labels every score is 0.5, with labels of one
    class it is that class. Repeated rows get equal scores; other columns are
    not read.
    """
    rows = docs.select("doc_id", F.col(text_col).alias("text"))
    labels = labels.where(F.col("quality").isin(0, 1))
    sample = labelled_sample(rows, labels, "quality", held, max_rows, "quality-sample")
    model = fit_quality(sample, epochs)
    if model is None:
        return rows.select("doc_id", F.lit(0.5).alias("score"))
    if not len(model.weights):
        return rows.select("doc_id", F.lit(model.bias).alias("score"))
    return rows.select("doc_id", scored(F.col("text"),
                                        docs.sparkSession.sparkContext.broadcast(model)).alias("score"))
