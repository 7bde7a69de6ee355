"""Hard-negative mining by L2AP-style threshold joins.

Anchors meet all rows in blocks. Within a pair of blocks the rows are held in
an inverted index over the dimensions, the heaviest dimension first. A row's
last dimensions are left out as long as their norm times the longest anchor's
stays below the threshold: whatever they add, they can't reach it alone. The
index is read in groups of dimensions; partial scores are accumulated, and a
pair whose partial score plus the product of the two remaining norms can't
reach the threshold is pruned. What is left gets its exact integer score. The
threshold starts high and is lowered for the anchors whose windows are not
full yet, down to the window's own lower bound; a lower threshold reads on
where the last one stopped.

Two such joins make the result: one of rows with the anchor's label, whose
window is the best ``positives`` rows; and one of the others, with one window
of ``negatives`` rows for each positive, between two shares of its score. A
pair of blocks returns only its own best rows of each window, so what goes on
to the final ranking is bounded by the windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import landed

#: Most rows and anchors of one block, and most components of its rows.
ROW_BLOCK, ANCHOR_BLOCK, BLOCK_COMPONENTS = 4096, 1024, 1 << 21
#: Dimensions of the index read at a time.
GROUP = 8
#: Shares of the way from an anchor's highest possible score to the lowest
#: bound of its windows at which the threshold stops; the last is that bound.
STOPS = (0.4, 0.6, 0.8, 1.0)
#: Sums of products below this are exact in doubles; larger ones are taken in integers.
EXACT = 2.0 ** 52
LONG = 2 ** 63 - 1
#: Scaled components saturate here.
LARGEST = 2.0 ** 62

FOUND = "anchor long, window long, id long, score long"


def norms_after(x: np.ndarray) -> np.ndarray:
    """Column k: norm of each row's dimensions from k on (one column more than
    dimensions, the last one zero), rounded up a little."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    out = np.zeros((len(x), x.shape[1] + 1))
    out[:, :-1] = np.sqrt(squares) * (1 + 1e-9)
    return out


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of two matrices of whole numbers, as long. Where
    doubles would round they are taken in integers without bounds; beyond
    long they saturate."""
    top = np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * x.shape[1]
    if top < EXACT:
        return (x @ y.T).astype(np.int64)
    ints = [[[int(v) for v in row] for row in m] for m in (x, y)]
    return np.array([[max(-LONG, min(LONG, sum(a * b for a, b in zip(p, q)))) for q in ints[1]]
                     for p in ints[0]], np.int64).reshape(len(x), len(y))


class PartialScores:
    """Partial scores of one block of anchors against the inverted index of
    one block of rows, dimensions in the order of their weight."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.argsort(-(y * y).sum(axis=0), kind="stable")
        self.x, self.y = x[:, order], y[:, order]
        self.x_rest, self.y_rest = norms_after(self.x), norms_after(self.y)
        self.scores = np.zeros((len(x), len(y)))
        #: Dimensions accumulated so far, by row of the block.
        self.read = np.zeros(len(y), np.int64)

    def candidates(self, anchors: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
        """Mask of ``anchors`` (places) x rows: pairs that may still reach the
        anchor's threshold. Reads on in the index as far as that needs; the
        anchors of one call must be among those of the calls before."""
        dims = self.y.shape[1]
        longest = self.x_rest[anchors, 0].max(initial=0)
        # Indexed dimensions of each row: those before the ones whose norm
        # can't reach the lowest threshold alone.
        indexed = (self.y_rest[:, :dims] * longest >= thresholds.min()).sum(axis=1)
        alive = np.zeros((len(anchors), len(self.y)), bool)
        rows = np.flatnonzero(indexed > 0)
        alive[:, rows] = True
        for start in range(0, dims, GROUP):
            posted = rows[indexed[rows] > start]  # postings of this group of dimensions
            fresh = posted[self.read[posted] <= start]
            end = min(dims, start + GROUP)
            if len(fresh):
                self.scores[np.ix_(anchors, fresh)] += (self.x[anchors, start:end]
                                                        @ self.y[fresh, start:end].T)
                self.read[fresh] = end
            if not len(posted):
                break
            alive[:, posted] &= self.bounds(anchors, posted) >= thresholds[:, None]
            rows = rows[alive[:, rows].any(axis=0)]
        return alive

    def bounds(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Most that the scores can be: what was read, the product of the two
        norms of the rest, and room for rounding."""
        read = self.read[rows]
        rest = self.x_rest[anchors][:, read] * self.y_rest[rows, read]
        room = 1 + np.outer(self.x_rest[anchors, 0], self.y_rest[rows, 0])
        return self.scores[np.ix_(anchors, rows)] + rest + 1e-9 * room


@dataclass
class Windows:
    """Per anchor (row) and window (column) the lowest and highest score
    wanted; a window whose ``low`` is above its ``high`` takes nothing."""
    low: np.ndarray
    high: np.ndarray


def best_in_windows(x: np.ndarray, y: np.ndarray, ids: np.ndarray, allowed: np.ndarray,
                    windows: Windows, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, window, row, score) of the best ``size`` allowed rows in each
    window, by score downwards, then by ``ids``."""
    partial = PartialScores(x, y)
    empty = windows.low > windows.high
    # No score is beyond the product of the norms.
    most = partial.x_rest[:, 0] * partial.y_rest[:, 0].max(initial=0) + 1
    low = np.where(empty, np.inf, windows.low).min(axis=1, initial=np.inf)
    high = np.where(empty, -np.inf, windows.high).max(axis=1, initial=-np.inf)
    low, high = np.maximum(low, -most), np.minimum(high, most)
    scores = np.zeros((len(x), len(y)), np.int64)
    known = np.zeros((len(x), len(y)), bool)
    waiting = np.flatnonzero(low <= high) if len(y) else np.array([], np.int64)
    for stop in STOPS:
        if not len(waiting):
            return
        # The last threshold is the bound itself, exactly.
        thresholds = low[waiting] if stop == 1 else (
            high[waiting] - stop * (high[waiting] - low[waiting]))
        wanted = partial.candidates(waiting, thresholds) & allowed[waiting] & ~known[waiting]
        rows = np.flatnonzero(wanted.any(axis=0))
        if len(rows):  # verification on whole vectors
            scores[np.ix_(waiting, rows)] = exact_products(x[waiting], y[rows])
            known[np.ix_(waiting, rows)] = True
        unfilled = []
        for place, a in enumerate(waiting):
            met = np.flatnonzero(known[a] & allowed[a] & (scores[a] >= thresholds[place]))
            met = met[np.lexsort((ids[met], -scores[a, met]))]
            s = scores[a, met]
            picked = [(w, met[(s >= windows.low[a, w]) & (s <= windows.high[a, w])][:size])
                      for w in np.flatnonzero(~empty[a])]
            # Rows not met score below the threshold, so a full window is final.
            if stop < 1 and any(len(p) < size and windows.low[a, w] < thresholds[place]
                                for w, p in picked):
                unfilled.append(a)
                continue
            for w, p in picked:
                for r in p:
                    yield int(a), int(w), int(r), int(scores[a, r])
        waiting = np.array(unfilled, np.int64)


def dense(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind).reshape(len(column), -1)


def threshold_join(anchors: DataFrame, rows: DataFrame, size: int, same_label: bool) -> DataFrame:
    """(anchor, window, id, score, place): for each window of each anchor the
    ``size`` best rows, ``place`` counting from 1, by score downwards, then id.

    ``rows`` has (id, label, vec, width), ids distinct; ``anchors`` the same and
    arrays ``low`` and ``high``, an element for each window, all of one length.
    Partners have the anchor's width and, as ``same_label`` says, its label
    (but another id) or another one. Anchors and rows of a width (and a label)
    are dealt over blocks of bounded size by their ids, and every block of
    anchors meets every block of rows in a group of its own.
    """
    cell = [F.col("width"), (F.col("label") if same_label else F.lit(0).cast("long")).alias("cell")]
    rows, anchors = rows.select("*", cell[1]), anchors.select("*", cell[1])
    room = F.greatest(F.lit(64), F.floor(F.lit(BLOCK_COMPONENTS) / F.col("width")))
    blocks = (rows.groupBy("width", "cell").agg(F.count("*").alias("n"))
              .join(anchors.groupBy("width", "cell").agg(F.count("*").alias("m")),
                    ["width", "cell"])
              .select("width", "cell",
                      F.ceil(F.col("n") / F.least(room, F.lit(ROW_BLOCK))).alias("row_blocks"),
                      F.ceil(F.col("m") / F.least(room, F.lit(ANCHOR_BLOCK)))
                      .alias("anchor_blocks")))

    def dealt(df: DataFrame, own: str, other: str, seed: int, is_anchor: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", F.lit(seed)), F.col(f"{own}_blocks")).alias(f"{own}_block")
        everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1))
        return (df.join(blocks, ["width", "cell"])
                .select("width", "cell", mine, everywhere.alias(f"{other}_block"),
                        F.lit(is_anchor).alias("is_anchor"), "id", "label", "vec",
                        *([F.col("low"), F.col("high")] if is_anchor else
                          [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")])))

    def block(table: pa.Table) -> pa.Table:
        first = table["is_anchor"].combine_chunks()
        a, r = table.filter(first), table.filter(pa.compute.invert(first))
        out: list[tuple] = []
        if len(a) and len(r):
            a_ids, r_ids = (t["id"].to_numpy() for t in (a, r))
            a_labels, r_labels = (t["label"].to_numpy() for t in (a, r))
            if same_label:
                allowed = a_ids[:, None] != r_ids[None, :]
            else:
                allowed = a_labels[:, None] != r_labels[None, :]
            windows = Windows(dense(a["low"], np.int64), dense(a["high"], np.int64))
            out = [(a_ids[i], w, r_ids[j], s) for i, w, j, s in best_in_windows(
                dense(a["vec"], np.float64), dense(r["vec"], np.float64), r_ids, allowed,
                windows, size)]
        return pa.table({name: pa.array([t[k] for t in out], pa.int64())
                         for k, name in enumerate(("anchor", "window", "id", "score"))})

    pair = ["width", "cell", "anchor_block", "row_block"]
    met = (dealt(anchors, "anchor", "row", 7, True)
           .unionByName(dealt(rows, "row", "anchor", 11, False))
           # A number of partitions that stays: pairs of blocks are small in bytes, not in work.
           .repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *pair)
           .groupBy(*pair).applyInArrow(block, FOUND))
    # Cut to the best of every task before it is shuffled.
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return met.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)


def whole_rows(rows: DataFrame, id_col: str, vector_col: str, label: Column,
               scale: int) -> DataFrame:
    """(id, label, vec, width) of the rows that take part; see
    :func:`hard_negatives`."""
    scaled = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                         F.transform(F.col(vector_col).cast("array<double>"),
                                     lambda c: scale * c).alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    taking = scaled.where(F.col("id").isNotNull() & F.col("label").isNotNull()
                          & F.coalesce(finite, F.lit(False)) & (F.size("vec") > 0))

    def floored(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))).cast("double")
    return (taking.select("id", "label", F.transform("vec", floored).alias("vec"))
            .groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r"))
            .select("id", "r.label", "r.vec", F.size("r.vec").alias("width")))


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | str = "label", scale: int = 256, anchor_every: int = 50,
                   positives: int = 5, negatives: int = 3, at_least: int = 50,
                   at_most: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) by inner product of components times ``scale``, floored.

    Anchors are the rows whose id ``anchor_every`` divides. An anchor's
    positives are its best ``positives`` other rows of its label; for each, the
    best ``negatives`` rows of another label whose score is from ``at_least``
    to ``at_most`` percent of the positive's are returned, all of them if there
    are fewer. Higher scores come first, ties by smaller id.

    Rows with a null id, label or vector, or a component that is null or not
    finite (before or after scaling), take no part, nor do empty vectors. Of
    rows that share an id, the one of smallest label, then vector, takes part.
    Vectors of different lengths never meet. Scaled components saturate at
    2**62, scores at the ends of long. An empty table gives an empty result;
    other columns are ignored.
    """
    label = F.col(label) if isinstance(label, str) else label
    taking = landed(whole_rows(rows, id_col, vector_col, label, scale), "negatives-rows")
    anchors = taking.where(F.col("id") % anchor_every == 0)
    everything = [F.array(F.lit(v).cast("long")).alias(c)
                  for c, v in (("low", -LONG), ("high", LONG))]
    best = landed(threshold_join(anchors.select("*", *everything), taking, positives, True)
                  .select(F.col("anchor"), F.col("place").alias("nth"),
                          F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                  "negatives-positives")
    # Window w of an anchor belongs to its positive of that place; missing ones take nothing.
    score = F.col("positive_score").cast("decimal(24,0)")
    bound = F.struct("nth", F.ceil(score * at_least / 100).cast("long").alias("low"),
                     F.floor(score * at_most / 100).cast("long").alias("high"))
    given = (best.groupBy(F.col("anchor").alias("id"))
             .agg(F.sort_array(F.collect_list(bound)).alias("bounds")))

    def padded(name: str, filler: int) -> Column:
        return F.concat(F.transform("bounds", lambda b: b[name]),
                        F.array_repeat(F.lit(filler).cast("long"),
                                       F.lit(positives) - F.size("bounds"))).alias(name)
    windowed = anchors.join(given, "id").select("id", "label", "vec", "width",
                                                padded("low", LONG), padded("high", -LONG))
    hard = threshold_join(windowed, taking, negatives, False)
    return (hard.join(best, (hard["anchor"] == best["anchor"])
                      & (hard["window"] == best["nth"] - 1))
            .select(hard["anchor"].alias("anchor_id"), "positive_id",
                    F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
