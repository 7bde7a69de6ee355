import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import negatives
from tidewater.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, window long"


def brute(rows, positives=5, wanted=3):
    taking = {}
    for i, e, label, *_ in rows:
        if i is None or label is None or not e or any(c is None or not math.isfinite(c)
                                                      for c in e):
            continue
        v = [math.floor(256 * float(np.float32(c))) for c in e]
        if i not in taking or (label, v) < taking[i]:
            taking[i] = (label, v)
    out = []
    for a, (label, v) in taking.items():
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other)
                        for i, (other, w) in taking.items() if i != a and len(w) == len(v))
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            window = [t for t in scored if t[2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s]
            out += [(a, p, k + 1, t[1], -s, -t[0]) for k, t in enumerate(window[:wanted])]
    return sorted(out)


def found(spark, rows, **kw):
    prepare(spark)
    got = negatives.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(5), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(map(tuple, got.collect()))


def clustered(rng, n, dims, labels, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    rows = []
    for i in range(n):
        # One label holds a third of all rows.
        label = 0 if rng.random() < 0.33 else rng.randrange(labels)
        v = [c + rng.gauss(0, spread) for c in centres[rng.randrange(labels)]]
        rows.append((i, v, label, "x", i))
    return rows


@pytest.mark.parametrize("spread, dims", [(0.3, 24), (3.0, 7)])
def test_matches_brute_force(spark, spread, dims):
    rows = clustered(random.Random(dims), 900, dims, 6, spread)
    want = brute(rows)
    assert want and found(spark, rows) == want


def test_many_blocks(spark, monkeypatch):
    """Anchors and rows over several blocks; an anchor's windows fill from all of them."""
    monkeypatch.setattr(negatives, "ROW_BLOCK", 64)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 4)
    rows = clustered(random.Random(2), 700, 16, 4, 0.8)
    want = brute(rows)
    assert want and found(spark, rows) == want


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], rng.randrange(3), "t", 0)
            for i in range(300)]
    rows += rows[:40]                                       # repeated rows
    rows += [(100, [1.0, 1.0, 1.0, 1.0], 0, "d", 0)]        # another row of a known id
    rows += [(400, None, 1, "n", 0), (450, [1.0, None, 1.0, 1.0], 1, "n", 0),
             (500, [1.0, math.nan, 0.0, 0.0], 1, "n", 0), (550, [math.inf, 0.0, 0.0, 0.0], 1, "n", 0),
             (600, [1.0, 1.0, 0.0, 0.0], None, "n", 0), (None, [1.0, 1.0, 1.0, 1.0], 1, "n", 0),
             (650, [], 1, "e", 0), (700, [1.0, 1.0], 1, "w", 0), (701, [1.0, 1.0], 1, "w", 0),
             (702, [0.9, 0.9], 2, "w", 0), (750, [0.0] * 4, 2, "z", 0)]
    want = brute(rows)
    assert any(r[0] == 700 for r in want) and found(spark, rows) == want


def test_few_rows_and_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1, "", 0)]) == []
    assert found(spark, [(0, [1.0], 1, "", 0), (1, [1.0], 1, "", 0), (2, [0.9], 2, "", 0)]) == [
        (0, 1, 1, 2, 65536, 230 * 256)]


def test_scores_beyond_doubles_and_long(spark):
    """Large components: exact up to the ends of long, saturated beyond."""
    prepare(spark)
    rows = [(0, [1e7, 1.0], 1), (1, [1e7, 2.0], 1), (2, [6e6, 5.0], 2), (3, [6e6, 4.0], 2),
            (50, [1e30, 0.0], 3), (51, [1e30, 0.0], 3), (52, [1e300, 1e308], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, negatives.hard_negatives(df).where("anchor_id = 0").collect()))
    v = {i: [math.floor(256 * c) for c in e] for i, e, _ in rows[:4]}
    score = {i: sum(a * b for a, b in zip(v[0], v[i])) for i in v}
    assert got == [(0, 1, 1, 2, score[1], score[2]), (0, 1, 2, 3, score[1], score[3])]
    assert score[2] > 2 ** 53
    best = negatives.hard_negatives(df, at_most=100).where("anchor_id = 50")
    assert best.agg(F.max("positive_score")).first()[0] in (None, negatives.LONG)


def test_index_prunes_and_omits():
    """Rows too short to reach the threshold aren't read; a lower threshold
    reads on; what is pruned could not have reached it."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(0, 50, (5, 32)))
    y = np.floor(rng.normal(0, 50, (200, 32)) * np.linspace(0.01, 1, 200)[:, None])
    true = x @ y.T
    partial = negatives.PartialScores(x, y)
    reads = []
    for t in (40_000.0, 15_000.0, 2_000.0):
        alive = partial.candidates(np.arange(5), np.full(5, t))
        assert not (true[~alive] >= t).any()
        reads.append(int(partial.read.sum()))
    assert reads[0] < reads[1] < reads[2] < 200 * 32
