import random
import zlib
from collections import Counter

import pytest

from tidewater.llm import variants
from tidewater.llm.common import prepare

WORDS = "word string, n long"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n_of):
    form, near = {}, {}
    for w in n_of:
        others = [v for v in n_of if one_edit(w, v)]
        near[w] = len(others)
        best = min(others, key=lambda v: (-n_of[v], v), default=None)
        form[w] = best if best is not None and n_of[best] >= 2 * n_of[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n_of[w], near[w], n_of.get(form[w])) for w in n_of)


def found(spark, rows, **kw):
    prepare(spark)
    got = variants.variant_groups(spark.createDataFrame(rows, WORDS), **kw)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("pairs_per_key", [variants.PAIRS_PER_KEY, 1, 20])
def test_matches_brute_force(spark, pairs_per_key):
    """Also where nearly every chunk is hot and is chunked again to the end."""
    rng = random.Random(5)
    n_of = {}
    while len(n_of) < 400:
        word = [rng.choice("abé") for _ in range(rng.randrange(5, 9))]
        n_of["".join(word)] = rng.randrange(3, 60)
    n_of |= {"strasse": 9, "straße": 4, "strase": 2, "strasser": 9, "aaaaaaaaaa": 3,
             "aaaaaaaaaaa": 7, "ab": 5, "ba": 5, "abc": 20}
    assert found(spark, list(n_of.items()), pairs_per_key=pairs_per_key) == brute(n_of)


def test_one_stem_shared_by_all_words(spark):
    """Every word has the same first half: one hot chunk."""
    rng = random.Random(8)
    n_of = {"common" + "".join(rng.choice("abcdef") for _ in range(6)): rng.randrange(3, 9)
            for _ in range(300)}
    assert found(spark, list(n_of.items()), pairs_per_key=50) == brute(n_of)


def test_ties_repeats_nulls_and_empty(spark):
    # A tie of n goes to the smaller word; twice its n is needed; repeats add up.
    rows = [("hause", 3), ("haupe", 6), ("haute", 6), ("hauge", 5), (None, 7), ("hauge", 0),
            ("", 9), ("x", 9)]
    got = {r[0]: r for r in found(spark, rows)}
    assert set(got) == {"hause", "haupe", "haute", "hauge"}
    assert got["hause"][1:] == ("haupe", "haupe", 3, 3, 6)
    assert got["hauge"][1:] == (None, "hauge", 5, 3, None)
    assert found(spark, []) == []


def test_chain_of_forms(spark):
    rows = [("chaina", 1), ("chainab", 2), ("chainabc", 4), ("chainabcd", 8), ("chainabcde", 16)]
    assert {r[2] for r in found(spark, rows)} == {"chainabcde"}


def test_corpus_words(spark):
    prepare(spark)
    rng = random.Random(1)
    pool = ["Straße", "naïve", "NAÏVE", "house", "Été", "it's", "a×b÷cde", "cafés2cafés"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(60)), "x") for i in range(40)]
    rows += [(None, "house " * 5, "y"), (7, None, "n"), (8, "", "e"), (9, "q" * 30_000, None),
             (3, "house", "r"), (3, "house", "r")]
    want = Counter()
    for doc, text, _ in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                word = run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]
                want[word] += 1
                run = ""
    want = {w: n for w, n in want.items() if len(w) >= 5 and n >= 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = variants.corpus_words(docs)
    assert {r["word"]: r["n"] for r in got.collect()} == want
    assert variants.corpus_words(docs.limit(0)).count() == 0
