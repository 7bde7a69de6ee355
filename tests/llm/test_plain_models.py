"""The three classifiers against plain Python on tiny corpora."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import language, quality, toxicity
from tidewater.llm.common import prepare

DOCS = "doc_id long, text string, lang string"


# -- language ------------------------------------------------------------------

def plain_language(rows, texts, min_words=3, min_grams=5):
    """(language, score) of texts, from counts in dictionaries."""
    def words(text):
        return "".join(c if c.isalpha() else " " for c in text.lower()).split()

    def grams(word, n):
        marked = f"<{word}>"
        return [marked[i:i + n] for i in range(len(marked) - n + 1)]
    counts = defaultdict(Counter)                    # order -> (term, language) -> times
    for text, lang in rows:
        for w in words(text):
            counts[0][w, lang] += 1
            for n in range(1, 6):
                for g in grams(w, n):
                    counts[n][g, lang] += 1
    total = {n: Counter() for n in counts}
    for n, c in counts.items():
        for (term, _), k in c.items():
            total[n][term] += k
    known = {n: {t for t, k in total[n].items() if k >= (min_grams if n else min_words)}
             for n in total}
    langs = sorted({lang for n in counts for (t, lang) in counts[n] if t in known[n]})

    def log_share(n, term, lang):
        of = sum(counts[n][t, lang] for t in known[n])
        return math.log((counts[n][term, lang] + 0.1) / (of + 0.1 * (len(known[n]) + 1)))

    def word_score(w, lang):
        if w in known[0]:
            return log_share(0, w, lang)
        for n in range(min(5, len(w) + 2), 0, -1):
            held = [g for g in grams(w, n) if g in known[n]]
            if held:
                return sum(log_share(n, g, lang) for g in held) / len(held)
        return 0.0
    out = []
    for text in texts:
        ws = words(text or "")
        if not ws:
            out.append(("und", 0.0))
            continue
        means = [sum(word_score(w, lang) for w in ws) / len(ws) * min(len(ws), 12)
                 for lang in langs]
        p = [math.exp(m - max(means)) for m in means]
        best = max(range(len(langs)), key=lambda k: (p[k], -k))
        out.append((langs[best], p[best] / sum(p)))
    return out


def test_language_matches_plain_counts(spark):
    prepare(spark)
    rng = random.Random(4)
    pools = {"aa": ["hola", "casa", "perro", "niño", "azul"],
             "bb": ["haus", "hund", "blau", "straße", "kinder"]}
    rows = [(" ".join(rng.choice(pools[lang]) for _ in range(9)), lang) for lang in pools
            for _ in range(6)]
    texts = ["hola casa", "hund hola 12", "hausboot perrera", "xyz qqq", "½ ² Ⅷ", "½haus²blau",
             "", None, "Straße STRASSE", "x" * 50_000, "12 !?", "ǆ casa", "casa haus"]
    docs = [(k, t, lang) for k, (t, lang) in enumerate(rows)]
    # The held-out fold has the texts to tell and no language that could be learned.
    all_rows = docs + [(1000 + k, t, None) for k, t in enumerate(texts)]
    df = spark.createDataFrame(all_rows, DOCS)
    used = {r["doc_id"] for r in df.where(F.col("lang").isNotNull() & (
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)).collect()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in
           language.identify_language(df).collect()}
    want = plain_language([(t, lang) for k, t, lang in docs if k in used],
                          [t for _, t, _ in all_rows])
    for (k, t, _), (lang, score) in zip(all_rows, want):
        assert got[k][0] == lang and got[k][1] == pytest.approx(score, abs=1e-9), t
    assert got[1004] == ("und", 0.0) and got[1005][0] == "bb"


def test_language_of_words_that_nothing_knows(spark):
    prepare(spark)
    df = spark.createDataFrame([(k, "hola hola hola", "es") for k in range(8)]
                               + [(50, "xyz", None), (51, "xyz hola", None)], DOCS)
    got = {r["doc_id"]: r for r in language.identify_language(df).collect()}
    assert got[50].lang_pred == got[51].lang_pred == "es" and 0 <= got[50].score <= 1


def test_language_model_is_bounded(spark):
    prepare(spark)
    sample = spark.createDataFrame([("hola casa perro " * 9, "es", 0)], "text string, y string, part int")
    model = language.fit_language(sample, max_terms=10)
    assert len(model.words) + len(model.grams) == 10
    assert language.fit_language(sample).words.keys() == {"hola", "casa", "perro"}


# -- quality ---------------------------------------------------------------------

def test_support_vectors_solve_the_plain_problem():
    """The same hinge loss minimised by projected gradient on the dual."""
    rng = np.random.default_rng(1)
    n, d = 30, 12
    rows = [np.unique(rng.integers(0, d, 5)).astype(np.int32) for _ in range(n)]
    y = np.where(rng.random(n) < 0.5, 1.0, -1.0)
    scale, c = rng.normal(0, 1, d), np.full(n, 0.7)
    w, b = quality.dual_coordinate_descent(rows, y, scale, c, epochs=4000)
    x = np.zeros((n, d + 1))
    for k, r in enumerate(rows):
        x[k, r] = scale[r]
    x[:, d] = 1.0                                      # the bias is one more column
    q = (x @ x.T) * np.outer(y, y)
    alpha = np.zeros(n)
    for _ in range(60_000):
        alpha = np.clip(alpha + (1 - q @ alpha) / np.linalg.norm(q, 2), 0, c)
    best = (alpha * y) @ x

    def loss(v):
        return 0.5 * v @ v + (c * np.maximum(0, 1 - y * (x @ v))).sum()
    assert loss(np.append(w, b)) == pytest.approx(loss(best), rel=1e-2)
    assert np.allclose(np.append(w, b), best, atol=0.05)


def test_quality_ratios_match_plain_counts(monkeypatch):
    """The scale of each indicator is its clipped log-count ratio."""
    seen = quality.Indicators()
    texts = ["good words here", "good plain words", "bad!!! BAD###", "bad words!!!"]
    labels = np.array([1, 1, 0, 0])
    rows = [seen.columns(t) for t in texts]
    given = []
    monkeypatch.setattr(quality, "dual_coordinate_descent", lambda r, y, scale, c, epochs: (
        given.append((scale.copy(), c.copy())), (np.zeros(len(scale)), 0.0))[1])
    quality.fit(rows, labels, np.zeros(4, int), epochs=1)
    scale, c = given[-1]
    for column in {k for r in rows for k in r.tolist()}:
        has = [sum(column in rows[k] for k in range(4) if labels[k] == y) for y in (0, 1)]
        want = math.log((has[1] + 0.5) / 3) - math.log((has[0] + 0.5) / 3)
        assert scale[column] == pytest.approx(max(-5, min(5, want)))
    assert c.tolist() == [1.0] * 4


def test_labels_of_other_values_are_left_out(spark):
    prepare(spark)
    docs = spark.createDataFrame([(k, f"text {k % 7} you idiot" if k % 2 else f"calm text {k % 5}",
                                   "en") for k in range(120)], DOCS)
    rows = [(k, k % 2, k % 2) for k in range(100)]
    odd = rows + [(k, 7, -1) for k in range(100, 120)] + [(3, 9, None)]
    for score in (lambda t: toxicity.score_toxicity(docs, t),
                  lambda t: quality.score_quality(docs, t)):
        a, b = (sorted((r["doc_id"], r["score"]) for r in score(spark.createDataFrame(
            given, "doc_id long, toxic int, quality int")).collect()) for given in (rows, odd))
        assert a == b


# -- toxicity --------------------------------------------------------------------

def plain_features(text, model):
    """Word by word, without codes or tables."""
    words = text.split()
    out = dict.fromkeys(toxicity.FEATURES, 0.0)
    if not words:
        return list(out.values())
    hits, twos = [], []
    for at, w in enumerate(words):
        seed, learned, prefix, second, caps, title, signs, undone = toxicity.profile(w, model)
        out["seed_hits"] += seed
        out["learned_rate"] += learned > 0
        out["learned_sum"] += learned
        out["learned_max"] = max(out["learned_max"], learned)
        out["prefix_rate"] += prefix > 0
        out["prefix_max"] = max(out["prefix_max"], prefix)
        out["second_rate"] += second
        out["caps_rate"] += caps
        out["title_rate"] += title
        out["punct_rate"] += signs
        out["obfuscated_rate"] += undone
        hit = seed > 0 or learned > 0 or prefix > 0
        out["obfuscated_hits"] += bool(undone and hit)
        hits += [at] * hit
        twos += [at] * (second > 0)
    out["seed_rate"] = out["seed_hits"]
    out["shout_rate"] = text.count("!") + text.count("?")
    for name in out:
        if name.endswith("_rate"):
            out[name] /= len(words)
    out["log_words"] = math.log1p(len(words))
    if hits and twos:
        out["proximity"] = 1 / (1 + min(abs(a - b) for a in hits for b in twos))
    return [out[name] for name in toxicity.FEATURES]


def test_toxicity_features_match_plain_ones():
    rng = random.Random(9)
    model = toxicity.ToxicityModel({"grump": 1.5, "noisy": 2.0}, {"horri": 1.2})
    pool = ["You", "idiot!", "1d10t", "calm", "GRUMP", "horrible", "noisy,", "you're", "tu", "a.b",
            "!!!", "2024", "Ö", "text", "i.d.i.o.t", "WHY?!"]
    seen = toxicity.Profiles(model)
    for _ in range(300):
        text = " ".join(rng.choice(pool) for _ in range(rng.randrange(0, 30)))
        assert toxicity.text_features(text, seen) == pytest.approx(plain_features(text, model))


def test_toxicity_lexicon_and_scores_match_plain_ones(spark):
    """The learned lexicon by counting documents; the score by the fitted
    trees' probability and a step line found by hand."""
    prepare(spark)
    rng = random.Random(2)
    rows = []
    for k in range(60):
        toxic = k % 3 == 0
        words = [rng.choice(["calm", "house", "river", "green"]) for _ in range(8)]
        if toxic:
            words[rng.randrange(8)] = rng.choice(["vexling", "vexlings", "snorfle"])
        rows.append((" ".join(words), int(toxic), k % 10))
    sample = spark.createDataFrame(rows, "text string, y int, part long")
    model = toxicity.learned_lexicon(sample, 100)
    n = Counter(y for _, y, _ in rows)
    for kind, held in ((0, model.words), (1, model.prefixes)):
        has = defaultdict(lambda: [0, 0])
        for text, y, _ in rows:
            for term in {w if kind == 0 else w[:5] for w in text.split() if kind == 0 or len(w) > 5}:
                has[term][y] += 1
        want = {t: math.log((b + 0.5) / (n[1] + 1)) - math.log((a + 0.5) / (n[0] + 1))
                for t, (a, b) in has.items() if b >= 2}
        assert held == pytest.approx({t: v for t, v in want.items() if v > 1.1})
    assert model.words.keys() == {"vexling", "vexlings", "snorfle"}

    line = spark.createDataFrame([(x / 10,) for x in range(-2, 13)], "x double")
    got = [r[0] for r in line.select(toxicity.interpolated(
        F.col("x"), [0.1, 0.5, 0.5, 0.9], [0.0, 0.2, 0.6, 1.0])).collect()]
    for x, y in zip((k / 10 for k in range(-2, 13)), got):
        want = 0.0 if x <= 0.1 else 1.0 if x >= 0.9 else \
            (x - 0.1) / 0.4 * 0.2 if x < 0.5 else 0.6 + (x - 0.5)
        assert y == pytest.approx(want) or x == 0.5


def test_toxicity_with_few_labels_still_learns(spark):
    """Too few rows for disjoint parts: they are shared, and no fixed rule decides."""
    prepare(spark)
    docs = [(k, "you are an idiot" if k % 2 else "a calm day by the river", "en")
            for k in range(1, 13)] + [(20, "you are an imbecile", "en"), (21, "a calm day by the sea", "en"),
                                      (22, None, "en")]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 13)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(
        spark.createDataFrame(docs, DOCS), labels, held=(1, 5)).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[20] > 0.5 > got[21]
