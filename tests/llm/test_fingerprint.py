import hashlib
import math
import random
from collections import Counter

import numpy as np
import xxhash

from tidewater.llm import fingerprint as fp
from tidewater.llm.common import prepare, table

SCHEMA = "doc_id long, text string, key long, range string, guest string"


def run(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    return fp.fingerprints(df).collect()


def test_edits_follow_the_id_order(spark):
    prepare(spark)
    rng = random.Random(4)
    texts = ["", None, "é", "ab", "naïve ☃ text " * 30, "w " * 5000]
    texts += [" ".join(f"w{rng.randrange(999)}é" for _ in range(rng.randrange(400)))
              for _ in range(150)]
    rows = [(7 * k - 300, t) for k, t in enumerate(texts)] + [(9_000, texts[20])]
    got = {r.doc_id: r for r in run(spark, rng.sample(rows, len(rows)))}
    assert len(got) == len(rows)
    plain = [t or "" for _, t in rows]
    for k, (doc_id, _) in enumerate(rows):
        text, following, r = plain[k], plain[(k + 1) % len(rows)], got[doc_id]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if edited == text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert got[9_000].fingerprint == got[20 * 7 - 300].fingerprint
    assert got[-300].fingerprint == got[-293].fingerprint  # empty and null


def test_repeated_and_null_ids(spark):
    rows = [(None, "first of all " * 9), (5, "b " * 90), (5, "a " * 90), (5, "a " * 90), (6, "")]
    got = run(spark, rows, 1)
    assert sorted(r.n_chars for r in got) == [0, 117, 180, 180, 180]
    lone = run(spark, [(1, "one text alone, next to itself")])
    assert lone[0].near_next == 1
    assert run(spark, []) == []


def test_entropy_of_every_window():
    data = np.frombuffer((b"the cat sat on the mat " * 9 + bytes(range(200)) + b"a" * 90), np.uint8)
    steps = fp.window_entropies(data)
    assert len(steps) == len(data) - fp.WINDOW + 1
    for k, step in enumerate(steps):
        n = Counter(data[k:k + fp.WINDOW].tolist()).values()
        h = -sum(c / fp.WINDOW * math.log2(c / fp.WINDOW) for c in n) / math.log2(fp.WINDOW)
        assert abs(step - fp.ENTROPIES * h) <= 1.01


def test_edited_texts_are_nearer_than_others(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = fp.fingerprints(docs).collect()
    assert len(got) == docs.count()
    nearer = sum(r.near_edited > r.near_next for r in got) / len(got)
    assert nearer > 0.97
    assert min(r.near_edited for r in got if r.n_chars >= 200) > 0.5


def plain_features(text, ranks):
    """Window by window: which of its neighbours is the rarest, how often."""
    data = np.frombuffer(text, np.uint8)
    steps = fp.window_entropies(data).tolist()
    wins = Counter()
    for first in range(len(steps) - fp.NEIGHBOURS + 1):
        near = range(first, first + fp.NEIGHBOURS)
        wins[min(near, key=lambda k: (ranks[steps[k]], k))] += 1
    out = []
    for k in sorted(wins):
        if wins[k] >= fp.SCORES and text[k:k + fp.WINDOW] not in out:
            out.append(text[k:k + fp.WINDOW])
    if text and (len(text) < fp.SHORT_TEXT or not out):
        for k in range(max(1, len(text) - fp.SHORT + 1)):
            if text[k:k + fp.SHORT] not in out:
                out.append(text[k:k + fp.SHORT])
    return out


def plain_digest(found):
    """Chained filters as sets of bit places."""
    chain = []
    for k, feature in enumerate(found):
        if k % fp.FILTER_FEATURES == 0:
            chain.append(set())
        h = xxhash.xxh3_128_digest(feature)
        for j in range(fp.HASHES):
            value = h[2 * j] + 256 * h[2 * j + 1]
            chain[-1].add(value % (8 * fp.FILTER_BYTES))
    return chain


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    a, b = sorted((a, b), key=len)
    bits, total = 8 * fp.FILTER_BYTES, 0.0
    for x in a:
        best = 0.0
        for y in b:
            chance, most = len(x) * len(y) / bits, min(len(x), len(y))
            best = max(best, min(1.0, max(0.0, (len(x & y) - chance) / (most - chance))))
        total += best * len(x)
    return min(1.0, total / sum(map(len, a)))


def texts_of_all_kinds():
    rng = random.Random(12)
    words = [f"w{rng.randrange(700)}é" for _ in range(900)]
    long = " ".join(words)
    return [b"", b"a", b"abcdef", b"short text " * 3, b"a" * 700, long.encode(),
            " ".join(words[:450] + ["changed"] * 40 + words[460:]).encode(),
            " ".join(f"other{rng.randrange(500)}" for _ in range(500)).encode(),
            bytes(range(1, 128)) * 9, long.encode() * 3]


def test_digest_matches_a_plain_one(spark):
    rng = np.random.default_rng(4)
    ranks = rng.permutation(fp.ENTROPIES + 1)
    for text in texts_of_all_kinds():
        data = np.frombuffer(text, np.uint8)
        found = fp.features(data, ranks)
        assert found == plain_features(text, ranks)
        got = [set(np.flatnonzero(np.unpackbits(f)).tolist()) for f in fp.digest(data, ranks)]
        assert got == plain_digest(found)


def test_likeness_matches_a_plain_one():
    ranks = np.random.default_rng(5).permutation(fp.ENTROPIES + 1)
    texts = texts_of_all_kinds()
    digests = [fp.digest(np.frombuffer(t, np.uint8), ranks) for t in texts]
    plain = [plain_digest(fp.features(np.frombuffer(t, np.uint8), ranks)) for t in texts]
    for a, x in zip(digests, plain):
        for b, y in zip(digests, plain):
            assert abs(fp.likeness(a, b) - plain_likeness(x, y)) < 1e-5
            assert fp.likeness(a, b) == fp.likeness(b, a) or len(a) == len(b)
        assert abs(fp.likeness(a, a) - 1) < 1e-5


def test_rarity_counts_every_window_of_the_corpus(spark):
    prepare(spark)
    texts = [t.decode("utf-8") for t in texts_of_all_kinds()]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    n = Counter()
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        for k in range(len(data) - fp.WINDOW + 1):
            n[int(fp.window_entropies(data[k:k + fp.WINDOW])[0])] += 1
    low = fp.ENTROPIES // 5
    order = sorted(range(fp.ENTROPIES + 1), key=lambda s: (n[s] == 0 or s < low, n[s], s))
    assert fp.rarity_ranks(df).tolist() == np.argsort(order).tolist()
