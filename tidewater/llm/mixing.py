"""Mixing sources to target weights by cube-method balanced sampling.

Each source has a target number of words. A document is taken
``floor(rate)`` times for certain (rate = target / source size) and once more
with the remaining fractional probability. The cube method decides those
fractional probabilities: in the flight phase three undecided documents at a
time move along the null space of the two balance constraints (documents and
tokens stay exactly on their expected totals) until one of them reaches 0 or
1. Blocks of one source fly independently, so a hot source is many small
groups; what each block leaves undecided (two documents at most) flies again
in the next round. The last block of a source lands: a dozen undecided
documents take the combination closest to the expected token total.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD_PATTERN, landed

EPS = 1e-9
#: Documents of a source's last block that wait for the landing.
LANDING = 10


def numbered(rows: DataFrame, order: list, number: str, sums: dict[str, str],
             label: str) -> DataFrame:
    """``rows`` with their place in ``order`` from 1, and per entry of ``sums``
    the sum of a column over the rows before. Ranges are sorted and summed
    each on its own; only one row per range passes through one task."""
    ranges = landed(rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label) \
        .withColumn("_range", F.shiftright("_at", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = ranges.groupBy("_range").agg(F.count("*").alias("_rows"),
                                         *[F.sum(c).alias(n) for n, c in sums.items()])
    start = whole.select("_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}_start")
                                     for c in ("_rows", *sums)])
    inside = (Window.partitionBy("_range").orderBy("_at")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (ranges.join(F.broadcast(start), "_range")
            .withColumn(number, F.col("__rows_start") + F.col("_at") % (1 << 33) + 1)
            .withColumns({n: F.col(f"_{n}_start") + F.coalesce(F.sum(c).over(inside), F.lit(0))
                          for n, c in sums.items()})
            .drop("_at", "_range", "__rows_start", *[f"_{n}_start" for n in sums]))


def source_targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, rank, source_size, target) of a (source, size) table.

    Sources in code point order (null last) weigh 1, 2, 3, repeating, and
    share all words; a target stops at ``cap`` times its source's size and the
    excess is shared anew by weight. That is water filling: with sources
    ordered by size per weight, a prefix is capped and the rest share one
    level. Ranks and sums run over ranges of the sources, any number of them.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = (numbered(total, [F.col("source").isNull(), "source"], "rank", {}, "mix-ranks")
              .withColumn("rank", F.col("rank").cast("int"))
              .withColumn("weight", (F.col("rank") - 1) % 3 + 1)
              .withColumn("most", F.col("source_size") * F.lit(cap))
              .withColumn("full_at", F.col("most") / F.col("weight")))
    every = ranked.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    ranked = landed(
        numbered(ranked, ["full_at", "rank"], "filled",
                 {"most_before": "most", "weight_before": "weight"}, "mix-fill")
        .crossJoin(F.broadcast(every))
        .withColumn("level", (F.col("all_size") - F.col("most_before"))
                    / (F.col("all_weight") - F.col("weight_before"))), "mix-levels")
    # The first source, in order of filling, that its level does not fill.
    first = ranked.agg(F.min(F.when(F.col("full_at") >= F.col("level"),
                                    F.struct("full_at", "rank", "level"))).alias("first"))
    ranked = ranked.crossJoin(F.broadcast(first))
    return (ranked.withColumn("at", F.col("first.level"))
            .select("source", "rank", "source_size",
                    F.least("most", F.col("weight") * F.col("at")).alias("target"),
                    (F.col("most") <= F.col("weight") * F.col("at")).alias("capped")))


def fly(size: np.ndarray, pi: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase over one block: probabilities move through the null space
    of (documents, tokens) until at most two stay strictly between 0 and 1."""
    pi = pi.copy()
    draws = rng.random(2 * len(pi) + 4)
    open_, queue, at = [], list(range(len(pi))), 0
    queue.reverse()
    while True:
        while len(open_) < 3 and queue:
            k = queue.pop()
            if EPS < pi[k] < 1 - EPS:
                open_.append(k)
        if len(open_) < 3:
            return pi
        i, j, k = open_
        a, b, c = size[i], size[j], size[k]
        u = (c - b, a - c, b - a) if not a == b == c else (1.0, -1.0, 0.0)
        up = down = float("inf")
        for p, d in zip((pi[i], pi[j], pi[k]), u):
            if d > 0:
                up, down = min(up, (1 - p) / d), min(down, p / d)
            elif d < 0:
                up, down = min(up, p / -d), min(down, (1 - p) / -d)
        step = up if draws[at % len(draws)] * (up + down) < down else -down
        at += 1
        for n, d in zip(open_, u):
            p = pi[n] + step * d
            pi[n] = 0.0 if p < EPS else 1.0 if p > 1 - EPS else p
        open_ = [n for n in open_ if 0.0 < pi[n] < 1.0]


def land(size: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """Landing phase: of all 0/1 choices for the undecided documents (two that
    the flight left and ``LANDING`` at most that it never moved), the one
    nearest to the expected tokens, then documents."""
    pi = pi.copy()
    left = np.flatnonzero((pi > EPS) & (pi < 1 - EPS))
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1).astype(float)
    off = choices - pi[left]
    best = np.lexsort((abs(off.sum(1)), abs(off @ size[left])))[0]
    pi[left] = choices[best]
    return pi.round()


def cube_block(block: pd.DataFrame, seed: int) -> pd.DataFrame:
    # Largest first: what a block leaves undecided is then small.
    block = block.sort_values(["size", "draw"], ascending=[False, True]).reset_index(drop=True)
    key = [seed, int(block["rank"].iloc[0]), int(block["block"].iloc[0]), int(block["turn"].iloc[0])]
    size = block["size"].to_numpy(float)
    pi, rng = block["pi"].to_numpy(float).copy(), np.random.default_rng(key)
    last = block["blocks"].iloc[0] == 1
    kept_back = np.linspace(0, len(pi) - 1, LANDING).astype(int) if last else []
    flies = ~np.isin(np.arange(len(pi)), kept_back)
    pi[flies] = fly(size[flies], pi[flies], rng)
    if last:
        pi = land(size, pi)
    return block.assign(pi=pi)[["doc_id", "rank", "size", "draw", "pi"]]


def apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``same``: equal rows are numbered from 0. They are counted
    and told out again, in two steps so that no array holds all numbers."""
    step = F.lit(10_000).cast("long")
    zero = F.lit(0).cast("long")
    return (rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
            .withColumn("_k", F.explode(F.sequence(zero, F.floor((F.col("_n") - 1) / step))))
            .withColumn("same", F.explode(F.sequence(
                F.col("_k") * step, F.least((F.col("_k") + 1) * step, F.col("_n")) - 1)))
            .drop("_n", "_k"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", cap: float = 3.0, block_rows: int = 2000,
                seed: int = 7) -> DataFrame:
    """One row per document: (doc_id, source, size, source_size, target,
    copies, taken).

    ``size`` is the number of words, 0 for null and empty texts (such
    documents are taken for nothing). Nulls in the source form a source of
    their own; a null id is an ordinary row. Repeated rows are sampled one by
    one. An empty table gives no rows. Other columns are not read, so their
    names may clash. ``seed`` and the ids decide all draws: reruns agree, on
    any partitioning.
    """
    spark = docs.sparkSession
    sizes = landed(apart(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD_PATTERN))
        .cast("long").alias("size"))), "mix-sizes")
    targets = landed(source_targets(sizes, cap), "mix-targets")
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).when(F.col("capped"), F.lit(cap)) \
        .otherwise(F.col("target") / F.col("source_size"))
    planned = (sizes.join(targets, sizes["source"].eqNullSafe(targets["source"]))
               .select("doc_id", sizes["source"], "size", "same", "rank", rate.alias("rate")))
    # Equal rows draw by their numbers, so that they fly in different blocks.
    draw = F.when(F.col("same") == 0, F.xxhash64("doc_id", F.lit(seed))) \
        .otherwise(F.xxhash64("doc_id", F.lit(seed), "same"))
    active = planned.select("doc_id", "rank", "size", draw.alias("draw"),
                            (F.col("rate") - F.floor("rate")).alias("pi"))
    rounds, turn = [], 0
    while True:
        counts = active.groupBy("rank").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
        blocks = (active.join(counts, "rank")
                  .withColumn("turn", F.lit(turn))
                  .withColumn("block", F.pmod(F.xxhash64("draw", "size", F.lit(turn)), "blocks")))
        # One key column: a join on rank alone would otherwise serve as the
        # partitioning of (rank, block) and leave a hot source in one task.
        cell = F.shiftleft(F.col("rank").cast("long"), 31) + F.col("block")
        flown = landed(blocks.withColumn("cell", cell).groupBy("cell").applyInPandas(
            lambda block: cube_block(block, seed),
            "doc_id long, rank int, size long, draw long, pi double"), f"mix-flight-{turn}")
        undecided = F.col("pi").between(EPS, 1 - EPS)
        rounds.append(flown.where(~undecided))
        active, turn = flown.where(undecided), turn + 1
        if active.isEmpty():
            break
    decided = rounds[0]
    for r in rounds[1:]:
        decided = decided.union(r)
    copies = (F.floor("rate") + F.col("pi")).cast("long")
    level = targets.select("rank", "source", "source_size", "target", rate.alias("rate"))
    return (decided.join(level, "rank")
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (F.col("size") * copies).alias("taken")))
