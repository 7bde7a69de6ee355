import math

import numpy as np
import pytest

from tidewater.llm import embeddings
from tidewater.llm.common import prepare, table

SCHEMA = "vec_id long, embedding array<{}>, label int, node long, cell string"


def brute(rows, cosine=0.95):
    ok = [r for r in rows if r[1] and None not in r[1] and all(map(math.isfinite, r[1]))
          and any(r[1])]
    near = {id(r): [] for r in rows}
    for a in ok:
        for b in ok:
            if a is not b and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                x, y = x / abs(x).max(), y / abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    near[id(a)].append(b)
    out = []
    for r in rows:
        seen, todo = {id(r)}, [r]
        ids = []
        while todo:
            one = todo.pop()
            ids.append(one[0])
            for b in near[id(one)]:
                if id(b) not in seen:
                    seen.add(id(b))
                    todo.append(b)
        out.append((r[0], len(near[id(r)]), min((i for i in ids if i is not None), default=None)))
    return sorted(out, key=str)


def check(spark, rows, kind="double"):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA.format(kind))
    got = embeddings.near_vectors(df.repartition(3)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark):
    prepare(spark)
    check(spark, [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.3]), (4, None),
                  (5, [0.0, 0.0]), (6, [1.0, None]), (7, [math.nan, 1.0]), (8, [math.inf, 1.0]),
                  (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.31]), (12, [-1.0, 0.0]),
                  (13, [1e200, 1e199]), (14, [1e-200, 1e-201]), (None, [0.0, 5.0])])
    empty = spark.createDataFrame([], SCHEMA.format("float"))
    assert embeddings.near_vectors(empty).collect() == []


@pytest.mark.parametrize("block", [1024, 16])
def test_links_across_cells_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(12, 6))
    x = np.concatenate([c + rng.normal(size=(25, 6)) * rng.uniform(0.05, 0.8) for c in centres])
    x = np.concatenate([x, x[:3], rng.normal(size=(60, 6))]).astype(np.float32)
    check(spark, [(5 * k % 1009, v.tolist()) for k, v in enumerate(x)], "float")


def test_given_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r.vec_id, list(r.embedding)) for r in df.select("vec_id", "embedding").collect()]
    x = np.array([v for _, v in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    expected = dict(zip((i for i, _ in rows), ((x @ x.T) >= 0.95).sum(1) - 1))
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    assert got == expected


def test_small_tables_go_through_cells_and_copies_stay_few(spark, monkeypatch):
    """No size switches the cells off, and up to a block for each cell a vector
    is copied to as many cells however many vectors there are."""
    prepare(spark)
    cells, copies = [], []
    fit, assign = embeddings.fit_cells, embeddings.assigned
    monkeypatch.setattr(embeddings, "fit_cells", lambda *a: cells.append(a[1]) or fit(*a))

    def counted(nodes, centres, cosine):
        out = assign(nodes, centres, cosine)
        copies.append(out.count() / nodes.count())
        return out
    monkeypatch.setattr(embeddings, "assigned", counted)
    rng = np.random.default_rng(5)
    for n in (40, 500, 4000):
        x = rng.normal(size=(n, 32))
        rows = [(k, v.tolist()) for k, v in enumerate(x)]
        if n < 1000:
            check(spark, rows + [(10_000 + k, (x[k] + 0.01).tolist()) for k in range(20)])
        else:
            df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA.format("double"))
            assert embeddings.near_vectors(df).count() == n
    assert cells == [7, 12, 12] and max(copies) < embeddings.CELLS


def test_many_lengths_of_vectors(spark):
    """Lengths with a handful of vectors share one job."""
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=1 + k % 30).tolist()) for k in range(90)]
    rows += [(500 + k, [2 * c for c in rows[k][1]]) for k in range(40)]
    rows += [(900 + k, rng.normal(size=5).round(0).tolist()) for k in range(60)]
    prepare(spark)
    check(spark, rows)


def test_single_precision_never_decides():
    rng = np.random.default_rng(7)
    x = embeddings.unit(rng.normal(size=(300, 48)))
    y = embeddings.unit(np.concatenate([x[:200] + rng.normal(size=(200, 48)) * 0.03, x[:5]]))
    for cosine in (0.95, 0.99, 1 - 1e-12):
        links = np.zeros((300, 205), bool)
        for strip, found in embeddings.near_strips(x, y, cosine):
            links[strip] = found
        assert np.array_equal(links, x @ y.T >= cosine)
    assert list(embeddings.near_strips(x, y[:0], 0.95)) == []
