"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

The features of a text are densities and extremes: hits of a seed lexicon and
of a lexicon learned from the labelled rows (words and word beginnings),
second-person words and how near they stand to a hit, capitals, punctuation,
and words that are spelled with look-alike signs. A bounded sample of labelled
rows is split three ways so that no step is fitted on rows that an earlier one
has seen: one part gives the lexicon, one the trees, one the calibration.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import labelled_sample, landed, worker_store

# Insults of general knowledge, a seed that the learned lexicon
# extends, and second-person words.
SEED_LEXICON = frozenset("""
    idiot moron stupid dumb loser scum trash worthless pathetic disgusting clown fool imbecile
    jerk bastard bitch asshole crap garbage filth vermin scumbag dimwit ugly hate shit fuck
    dumm blöd dummkopf trottel depp arschloch abschaum idiotin versager widerlich
    imbécile connard salope crétin débile nul ordure abruti dégoûtant merde
    imbécil estúpido tonto basura asqueroso mierda cabrón gilipollas escoria
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous
    votre vos tú ti usted ustedes vosotros tuyo
""".split())
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
SIGNS = ".,;:!?\"()[]'"
INNER = re.compile(r"[\W_]+")
CODES = 8  # columns of a word's profile, see profile()
PREFIX = 5
CACHED_WORDS = 600_000
FEATURES = ("log_words", "seed_rate", "seed_hits", "learned_rate", "learned_sum", "learned_max",
            "prefix_rate", "prefix_max", "second_rate", "proximity", "caps_rate", "title_rate",
            "punct_rate", "shout_rate", "obfuscated_rate", "obfuscated_hits")


@dataclass
class ToxicityModel:
    """What scoring needs on executors; every part has a fixed size bound."""
    words: dict[str, float]
    prefixes: dict[str, float]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def plain_form(word: str) -> tuple[str, bool]:
    """A word in lower case without signs at its ends; true if it had to be
    undone from look-alike signs or signs between its letters."""
    if word.isalpha():
        return word.lower(), False
    core = word.strip(SIGNS).lower()
    if core.isalpha():
        return core, False
    core = EDGE.sub("", word.translate(LOOKALIKES) if not word[:1].isalnum() else word).lower()
    if core.isalpha() or not any(c.isalpha() for c in core):
        return core, False
    return INNER.sub("", core.translate(LOOKALIKES)), True


def profile(word: str, model: ToxicityModel) -> tuple[float, ...]:
    """(seed, learned weight, prefix weight, second person, caps, title, signs,
    obfuscated) of one word."""
    core, undone = plain_form(word)
    signs = 0 if word.isalnum() else len(word) - sum(map(str.isalnum, word))
    return (float(core in SEED_LEXICON), model.words.get(core, 0.0),
            model.prefixes.get(core[:PREFIX], 0.0) if len(core) > PREFIX else 0.0,
            float(core in SECOND_PERSON), float(word.isupper() and len(core) > 1),
            float(word[0].isupper()), float(signs), float(undone))


class Profiles:
    """Words seen so far, each with the row of its profile in ``table``."""

    def __init__(self, model: ToxicityModel):
        self.model, self.ids, self.rows = model, {}, {}
        self.table = np.zeros((0, CODES))

    def codes(self, words: list[str]) -> np.ndarray:
        got = list(map(self.ids.get, words))
        if None in got:
            if len(self.ids) > CACHED_WORDS:
                self.ids.clear()
            for k, w in enumerate(words):
                if got[k] is None:
                    p = profile(w, self.model)
                    got[k] = self.ids[w] = self.rows.setdefault(p, len(self.rows))
            if len(self.rows) > len(self.table):
                self.table = np.array(list(self.rows))
        return np.array(got)


def text_features(text: str, seen: Profiles) -> list[float]:
    """Dense features of one text."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    codes = seen.codes(words)
    n, p = len(words), seen.table
    counts = np.bincount(codes, minlength=len(p))
    present = np.flatnonzero(counts)
    p, counts = p[present], counts[present]
    seed, learned, prefix, second, caps, title, signs, undone = counts @ p
    hit = (p[:, 0] > 0) | (p[:, 1] > 0) | (p[:, 2] > 0)
    near = 0.0
    if second and hit.any():
        hits = np.flatnonzero(np.isin(codes, present[hit]))
        twos = np.flatnonzero(np.isin(codes, present[p[:, 3] > 0]))
        at = np.searchsorted(twos, hits)
        gap = np.minimum(np.abs(hits - twos[np.minimum(at, len(twos) - 1)]),
                         np.abs(hits - twos[np.maximum(at - 1, 0)]))
        near = 1.0 / (1.0 + gap.min())
    return [float(np.log1p(n)), seed / n, seed, float((counts * (p[:, 1] > 0)).sum() / n), learned,
            float(p[:, 1].max()), float((counts * (p[:, 2] > 0)).sum() / n), float(p[:, 2].max()),
            second / n, near, caps / n, title / n, signs / n,
            (text.count("!") + text.count("?")) / n, undone / n,
            float((counts * ((p[:, 7] > 0) & hit)).sum())]


def features_of(text: Column, model: Broadcast) -> Column:
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = worker_store("toxicity", model.value.key)
        seen = store.setdefault("profiles", Profiles(model.value))
        for batch in batches:
            yield pa.array([text_features(t or "", seen) for t in batch.to_pylist()],
                           pa.list_(pa.float64()))
    return features(text)


def learned_lexicon(rows: DataFrame, max_terms: int) -> ToxicityModel:
    """Words and word beginnings that toxic rows favour, by log ratio of
    document frequencies; at most ``max_terms`` of each, strongest first."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: dict[tuple[str, int], list[int]] = {}
            for text, y in zip(batch["text"].to_pylist(), batch["y"].to_pylist()):
                cores = {plain_form(w)[0] for w in text.split()} - {""}
                for key in {(c, 0) for c in cores} | {(c[:PREFIX], 1) for c in cores
                                                     if len(c) > PREFIX}:
                    got.setdefault(key, [0, 0])[int(y)] += 1
            yield pa.RecordBatch.from_pydict({
                "term": pa.array([k[0] for k in got], pa.string()),
                "kind": pa.array([k[1] for k in got], pa.int32()),
                "clean": pa.array([v[0] for v in got.values()], pa.int64()),
                "toxic": pa.array([v[1] for v in got.values()], pa.int64())})

    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    counts = (rows.mapInArrow(terms, "term string, kind int, clean long, toxic long")
              .groupBy("term", "kind").agg(F.sum("clean").alias("clean"),
                                           F.sum("toxic").alias("toxic"))
              .withColumn("weight", F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1.0))
                          - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1.0)))
              .where("toxic >= 2 and weight > 1.1"))
    best = {kind: {r["term"]: r["weight"] for r in
                   counts.where(F.col("kind") == kind)
                   .orderBy(F.desc(F.col("weight") * F.col("toxic")), "term")
                   .limit(max_terms).collect()} for kind in (0, 1)}
    return ToxicityModel(best[0], best[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, held: tuple[int, int] = (5, 0),
                   text_col: str = "text", out_col: str = "score", max_rows: int = 20_000,
                   max_terms: int = 3_000, trees: int = 30) -> DataFrame:
    """``docs`` with a calibrated ``out_col`` in 0..1; all rows and all other
    columns, whatever their names, are kept as they are. A column that already
    has the name ``out_col`` is replaced.

    ``labels`` (doc_id, toxic) outside the ``held`` fold (modulus, remainder of
    crc32 of the id) teach, ``max_rows`` at most; labels other than 0 and 1 are
    left out. Where labels are too few for disjoint parts to learn the lexicon,
    the trees and the calibration from, these share rows. The whole of ``docs``
    is scored over whole texts. Null and empty texts have all features 0 and get
    that row's score. Without any label, or with labels of one class only, the
    score of every row is the class rate (0 without labels). Repeated rows get
    equal scores.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != out_col]
    whole = docs.select(F.struct(*others).alias("row"), F.col(text_col).alias("text"))

    def result(frame: DataFrame, score: Column) -> DataFrame:
        return frame.select("row.*", score.alias(out_col))

    labels = labels.where(F.col("toxic").isin(0, 1))
    sample = labelled_sample(docs.select("doc_id", F.col(text_col).alias("text")), labels,
                             "toxic", held, max_rows, "toxicity-sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if min(classes.get(0, 0), classes.get(1, 0)) == 0:
        rate = float(bool(classes.get(1, 0)))
        return result(whole, F.lit(rate))
    model = spark.sparkContext.broadcast(
        learned_lexicon(sample.where("part < 5"), max_terms))
    everything = landed(sample.select(
        array_to_vector(features_of(F.col("text"), model)).alias("features"),
        F.col("y").cast("double").alias("label"), "part"), "toxicity-features").coalesce(2)
    rows = everything.where("part >= 5")
    # The first part that has both classes; the whole sample has.
    fit_on = next(part for part in (rows.where("part < 8"), rows, everything)
                  if part is everything or part.select("label").distinct().count() == 2)
    gbt = GBTClassifier(maxIter=trees, maxDepth=3, stepSize=0.2, seed=1, checkpointInterval=-1,
                        featuresCol="features", labelCol="label").fit(fit_on)
    raw = vector_to_array(F.col("probability"))[1]
    calibration = rows.where("part >= 8")
    if calibration.isEmpty():
        calibration = fit_on
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(
        gbt.transform(calibration).select("label", raw.alias("raw")))
    knots = [float(x) for x in isotonic.boundaries]
    level = [float(x) for x in isotonic.predictions]

    scored = gbt.transform(whole.withColumn(
        "features", array_to_vector(features_of(F.col("text"), model))))
    # A little of the trees' own probability keeps the order within a step.
    return result(scored, 0.99 * interpolated(raw, knots, level) + 0.01 * raw)


def interpolated(x: Column, knots: list[float], level: list[float]) -> Column:
    """The step line through (knots, level), constant beyond its ends."""
    @F.arrow_udf("double")
    def at(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(np.interp(batch.to_numpy(zero_copy_only=False), knots, level))
    return at(x)
