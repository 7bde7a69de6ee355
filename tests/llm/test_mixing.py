import random

from tidewater.llm import mixing
from tidewater.llm.common import prepare

SCHEMA = "doc_id long, text string, source string, size long, rank int, target string"


def targets(sizes, cap=3.0):
    """Excess over the cap reshared by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = sum(weight[s] for s in free)
        out = {s: cap * sizes[s] if s in capped else left * weight[s] / share for s in order}
        above = {s for s in free if out[s] > cap * sizes[s]}
        if not above:
            return out
        capped |= above


def rows(rng):
    out, k = [], 0
    for source, docs in (("a", 40), ("b", 3), ("é", 300), (None, 25), ("", 60), ("z", 900),
                         ("only empty", 4)):
        for _ in range(docs):
            n = 0 if source == "only empty" else rng.choice([0, 1, rng.randrange(200), 900])
            out.append((k, "w " * n, source, 1, 2, "x"))
            k += 1
    return out + [(5, None, "a", 1, 2, "x"), (None, "one two", "b", 1, 2, "x"), out[60], out[60]]


def test_targets_and_copies(spark, monkeypatch):
    prepare(spark)
    data = rows(random.Random(1))
    df = spark.createDataFrame(data, SCHEMA)
    got = mixing.mix_sources(df.repartition(5), block_rows=100).collect()
    assert len(got) == len(data)
    sizes = {}
    for _, text, source, *_ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert r.taken == r.copies * r.size <= 3 * r.size
        rate = want[r.source] / r.source_size if r.source_size else 0
        assert r.copies in (int(rate + 1e-9), int(rate + 1e-9) + 1)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, n in taken.items():
        assert abs(n - want[source]) <= max(0.02 * want[source], 30)
    again = mixing.mix_sources(df, block_rows=100).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_flight_keeps_the_balance():
    import numpy as np
    rng = np.random.default_rng(4)
    size, pi = rng.integers(0, 500, 400).astype(float), np.full(400, 0.37)
    out = mixing.fly(size, pi, rng)
    undecided = (out > mixing.EPS) & (out < 1 - mixing.EPS)
    assert undecided.sum() <= 2
    assert abs(out.sum() - pi.sum()) < 1e-6 and abs(out @ size - pi @ size) < 1e-3


def test_no_rows(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_rows_fly_in_different_blocks(spark, monkeypatch):
    prepare(spark)
    flown, plain = {}, mixing.landed

    def kept(df, label):
        flown[label] = plain(df, label)
        return flown[label]

    monkeypatch.setattr(mixing, "landed", kept)
    data = [(None, "one two", "a", 1, 2, "x")] * 600 + [(k, "w " * 9, "b", 1, 2, "x")
                                                        for k in range(300)]
    got = mixing.mix_sources(spark.createDataFrame(data, SCHEMA), block_rows=50).collect()
    assert len(got) == 900 and sum(r.doc_id is None for r in got) == 600
    assert len({r.draw for r in flown["mix-flight-0"].collect()}) == 900  # before: 301


def test_ranges_are_numbered_and_summed_in_order(spark):
    prepare(spark)
    rng = random.Random(2)
    values = [rng.randrange(10**9) for _ in range(5000)]
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
        got = mixing.numbered(df, ["v"], "n", {"before": "v"}, "test-numbered").orderBy("n").collect()
    finally:
        spark.conf.unset(conf)
    total = 0
    for k, (r, v) in enumerate(zip(got, sorted(values)), 1):
        assert (r.v, r.n, r.before) == (v, k, total)
        total += v
