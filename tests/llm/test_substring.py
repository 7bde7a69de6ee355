import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import substring
from tidewater.llm.common import U64, prepare

SCHEMA = "doc_id long, text string, tid string, words string"


def brute(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(rng, width):
    def some(n, of=5000):
        return [f"w{rng.randrange(of)}" for _ in range(n)]
    shared = [some(n) for n in (width - 1, width, width + 1, 3 * width, 400)]
    texts = [None, "", " \n", "one", " ".join(some(width)), "go " * (3 * width)]
    for k in range(60):
        parts = [some(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            passage = list(rng.choice(shared))
            for _ in range(rng.choice([0, 0, 1, 3])):
                passage[rng.randrange(len(passage))] = f"x{rng.randrange(9)}"
            parts += [passage, some(rng.randrange(60))]
        texts.append(" ".join(x for p in parts for x in p))
    texts += texts[6:9] + [" \t".join(some(300, 3)), "\n".join(some(4000, 9000))]
    return texts


@pytest.mark.parametrize("width", [35, 7])
def test_matches_brute_force(spark, monkeypatch, width):
    prepare(spark)
    if width == 7:  # many shards, and shards dealt over several blocks
        monkeypatch.setattr(substring, "SHARD_WORDS", 400)
    texts = corpus(random.Random(width), width)
    rows = [(k if k % 9 else None, t, "x", "y") for k, t in enumerate(texts)]
    got = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3),
                                   width).collect()
    expected = [(r[0], *b) for r, b in zip(rows, brute(texts, width))]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) \
        == sorted(expected, key=str)
    for r in got:
        if r.n_removed:
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_index_counts_patterns():
    rng = np.random.default_rng(3)
    seqs = [rng.integers(0, 4, rng.integers(1, 40)).astype(U64) for _ in range(30)]
    weights = rng.integers(1, 5, len(seqs))
    index = substring.FMIndex(seqs, weights, 8)
    for _ in range(200):
        pattern = rng.integers(0, 5, rng.integers(1, 8)).astype(U64)
        lo, hi = np.zeros(1, np.int64), np.array([index.size])
        for c in index.codes(pattern)[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        expected = sum(int(w) for s, w in zip(seqs, weights) for k in range(len(s))
                       if np.array_equal(s[k:k + len(pattern)], pattern))
        assert index.weight[hi[0]] - index.weight[lo[0]] == expected


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_passages_are_found_without_a_shuffle_of_their_places(spark, monkeypatch):
    """One passage in most texts, and a share at which its minimizers are hot."""
    prepare(spark)
    monkeypatch.setattr(substring, "HOT_SHARE", 40)
    rng = random.Random(3)
    hot = [f"hot{k}" for k in range(50)]
    texts = [" ".join([f"w{rng.randrange(9000)}" for _ in range(30)]
                      + (hot if k % 4 else hot[:30]) + [f"w{rng.randrange(9000)}" for _ in range(20)])
             for k in range(80)]
    texts += texts[:30] + ["", None]
    rows = [(k, t, "x", "y") for k, t in enumerate(texts)]
    got = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), 35).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) \
        == [(k, *b) for k, b in enumerate(brute(texts, 35))]
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
