import random
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import minhash
from tidewater.llm.common import connected_components, prepare

SCHEMA = "doc_id long, text string, key string, node string"


def brute(rows, width, percent):
    """component_id per row by comparing all sets with one another."""
    def shingles(text):
        words = (text or "").encode().lower().split()
        if len(words) < width:
            return {tuple(words)} if words else set()
        return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}

    by_set = defaultdict(list)
    for doc_id, text in rows:
        by_set[frozenset(shingles(text))].append(doc_id)
    sets = [s for s in by_set if s]
    parent = {s: s for s in sets}

    def root(s):
        while parent[s] != s:
            s = parent[s]
        return s
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[root(a)] = root(b)
    least = {}
    for s in sets:
        ids = [i for i in by_set[s] if i is not None]
        r = root(s)
        least[r] = min([*ids, *([least[r]] if least.get(r) is not None else [])], default=None)
    out = []
    for doc_id, text in rows:
        s = frozenset(shingles(text))
        out.append((doc_id, len(s), least[root(s)] if s else doc_id))
    return sorted(out, key=str)


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_matches_brute_force(spark, width):
    prepare(spark)
    rng = random.Random(width)
    texts = [None, "", " \n\t", "one", "One", "one two", "a b c d", "a b c d", "ÄB äb"]
    texts += family(rng, 60, 120, 9) + family(rng, 3, 4000, 300) + ["the end " * 3000]
    for _ in range(15):
        texts += family(rng, 4, rng.randrange(3, 200), 6)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (None, texts[12]), (None, "only here " * 9), (5, "quite another")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA)
    got = minhash.near_duplicates(df, width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) \
        == brute(rows, width, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_members_apart_are_compared_across_blocks(spark, monkeypatch):
    """Between components of one bucket every linked pair of components is
    found, whatever the blocks; pairs inside a component aren't compared, and
    those that share an earlier bucket are compared there only."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(9)
    texts = family(rng, 150, 60, 8)
    sets = [minhash.shingle_set(t, 2) for t in texts]
    node = {minhash.node_of(s): s for s in sets}
    ids = sorted(node)
    comp = {n: (0 if k % 3 else n) for k, n in enumerate(ids)}
    sketch = minhash.odd_sketches(np.stack([minhash.minhashes(node[n]) for n in ids]))
    # All share the key of band 2; every other node also that of band 0.
    bands = [[5 if k % 2 else -k, 10_000 + k, 7, *range(k * 100, k * 100 + minhash.BANDS - 3)]
             for k in range(len(ids))]
    rows = [(key, n, comp[n], len(node[n]), *bands[k], *map(int, sketch[k]))
            for k, n in enumerate(ids) for key in ((7, 5) if k % 2 else (7,))]
    names = ["key", "node", "comp", "n", *minhash.BAND, *minhash.SKETCH]
    sets = spark.createDataFrame([(n, bytearray(s.tobytes())) for n, s in node.items()],
                                 "node long, members binary")

    def found(rows):
        return minhash.block_links(spark.createDataFrame(
            rows, ", ".join(f"{c} long" for c in names)), sets, 512, 80).collect()
    got = found(rows)
    odd = {n for k, n in enumerate(ids) if k % 2}
    assert not any(r.a in odd and r.b in odd for r in found([r for r in rows if r[0] == 7]))
    linked = {(a, b) for a in ids for b in ids
              if 100 * len(np.intersect1d(node[a], node[b]))
              >= 80 * len(np.union1d(node[a], node[b]))}
    assert all((r.a, r.b) in linked for r in got)
    assert {frozenset((comp[a], comp[b])) for a, b in linked if comp[a] != comp[b]} \
        == {frozenset((comp[r.a], comp[r.b])) for r in got}


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in
           connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)}
