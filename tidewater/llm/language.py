"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language. An unseen
word falls back to its longest character n-grams that the model knows, ever
shorter ones, with a fixed cost for each step down.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import labelled_sample, worker_store

WORDLIKE = re.compile(r"[^\W\d_]+")
LONGEST = 5
UNKNOWN = "und"
#: Words beyond this many add no certainty: neighbours in a text depend on each other.
CERTAIN_WORDS = 12
CACHED_PIECES = 600_000


@dataclass
class LanguageModel:
    """Log frequency per language (a row of ``scores``) by word and by n-gram."""
    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def letter_runs(text: str) -> list[str]:
    """Runs of letters. The pattern also takes number signs such as a half or a
    roman numeral sign, which are none."""
    out = []
    for run in WORDLIKE.findall(text):
        out += [run] if run.isalpha() else "".join(
            c if c.isalpha() else " " for c in run).split()
    return out


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word between its end marks."""
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def fit_language(sample: DataFrame, min_words: int = 3, min_grams: int = 5,
                 max_terms: int = 1_000_000) -> LanguageModel | None:
    """Counts of words and 1..5-grams by language over a bounded sample (text,
    y); words and n-grams seen less often than the minima are left to backoff,
    and so are those beyond the ``max_terms`` most frequent, which bounds the
    model however long the sample's texts are. None without any row."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: Counter = Counter()
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(batch["text"].to_pylist(), batch["y"].to_pylist()):
                by_lang.setdefault(lang, Counter()).update(letter_runs(text.lower()))
            for lang, words in by_lang.items():
                for w, k in words.items():
                    got[lang, 0, w] += k
                    for n in range(1, LONGEST + 1):
                        for g in grams_of(w, n):
                            got[lang, n, g] += k
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in got], pa.string()),
                "n": pa.array([k[1] for k in got], pa.int32()),
                "term": pa.array([k[2] for k in got], pa.string()),
                "k": pa.array(list(got.values()), pa.int64())})

    counts = (sample.mapInArrow(counted, "lang string, n int, term string, k long")
              .groupBy("n", "term", "lang").agg(F.sum("k").alias("k")))
    rows = (counts.groupBy("n", "term")
            .agg(F.map_from_arrays(F.collect_list("lang"), F.collect_list("k")).alias("by"),
                 F.sum("k").alias("all"))
            .where(F.col("all") >= F.when(F.col("n") == 0, min_words).otherwise(min_grams))
            .orderBy(F.desc("all"), "n", "term").limit(max_terms).collect())
    rows.sort(key=lambda r: (r["n"], r["term"]))
    if not rows:
        return None
    languages = sorted({lang for r in rows for lang in r["by"]})
    table = np.array([[r["by"].get(lang, 0) for lang in languages] for r in rows], float)
    order = np.array([r["n"] for r in rows])
    scores = np.zeros_like(table)
    for n in range(LONGEST + 1):
        of = order == n
        if of.any():
            # The share of a language among terms of this order, with a little mass for the rest.
            scores[of] = np.log((table[of] + 0.1) / (table[of].sum(0) + 0.1 * (of.sum() + 1)))
    words = {r["term"]: k for k, r in enumerate(rows) if r["n"] == 0}
    grams = {r["term"]: k for k, r in enumerate(rows) if r["n"]}
    return LanguageModel(languages, words, grams, scores)


def known_rows(word: str, model: LanguageModel) -> list[int]:
    """The row of a known word; else those of its longest known n-grams, whose
    mean counts; empty if not even a letter is known."""
    row = model.words.get(word)
    if row is not None:
        return [row]
    for n in range(min(LONGEST, len(word) + 2), 0, -1):
        known = [g for g in map(model.grams.get, grams_of(word, n)) if g is not None]
        if known:
            return known
    return []


class Scored:
    """Blank-separated pieces seen so far, each with a row of ``table``: the
    summed scores of its words and, last, their number."""

    def __init__(self, model: LanguageModel):
        self.model, self.ids = model, {}
        self.table = np.zeros((0, len(model.languages) + 1))

    def rows(self, pieces: list[str]) -> np.ndarray:
        """Rows of new pieces, summed over the rows of all their words at once."""
        at, owner, weight = [], [], []
        words_in = np.zeros(len(pieces))
        for k, piece in enumerate(pieces):
            piece = piece.lower()
            words = [piece] if piece.isalpha() else letter_runs(piece)
            words_in[k] = len(words)
            for w in words:
                known = known_rows(w, self.model)
                at += known
                owner += [k] * len(known)
                weight += [1.0 / max(1, len(known))] * len(known)
        owner, weight = np.array(owner, np.int64), np.array(weight)
        scores = self.model.scores[np.array(at, np.int64)]
        return np.stack([np.bincount(owner, weight * scores[:, j], len(pieces))
                         for j in range(scores.shape[1])] + [words_in], axis=1)

    def total(self, pieces: list[str]) -> np.ndarray:
        got = list(map(self.ids.get, pieces))
        if None in got:
            if len(self.ids) > CACHED_PIECES:
                self.ids.clear()
                return self.total(pieces)
            new = sorted({p for p, k in zip(pieces, got) if k is None})
            first = len(self.ids)
            if first + len(new) > len(self.table):
                grown = np.zeros((2 * (first + len(new)), self.table.shape[1]))
                grown[:first] = self.table[:first]
                self.table = grown
            self.table[first:first + len(new)] = self.rows(new)
            self.ids.update(zip(new, range(first, first + len(new))))
            got = list(map(self.ids.get, pieces))
        return self.table[np.array(got)].sum(0)


def predict(text: str | None, seen: Scored) -> tuple[str, float]:
    """(language, confidence) of a whole text; ``und`` and 0 without a letter."""
    pieces = text.split() if text else None
    total = seen.total(pieces) if pieces else None
    if total is None or not total[-1]:
        return UNKNOWN, 0.0
    n = total[-1]
    mean = total[:-1] / n * min(n, CERTAIN_WORDS)
    p = np.exp(mean - mean.max())
    best = int(np.argmax(p))
    return seen.model.languages[best], float(p[best] / p.sum())


def predicted(text: Column, model: Broadcast) -> Column:
    @F.arrow_udf("struct<lang: string, score: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = worker_store("language", model.value.key)
        seen = store.setdefault("scored", Scored(model.value))
        for batch in batches:
            got = [predict(t, seen) for t in batch.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], ["lang", "score"])
    return run(text)


def identify_language(docs: DataFrame, held: tuple[int, int] = (4, 2), text_col: str = "text",
                      lang_col: str = "lang", max_rows: int = 6_000) -> DataFrame:
    """One row per document: (doc_id, lang_pred, score).

    The model learns from ``max_rows`` documents at most, with a non-null
    language, outside the ``held`` fold (modulus, remainder of crc32 of the
    id); the choice is by id hash. Only the text enters a prediction. Null
    texts and texts without a letter are ``und`` with score 0, and so is every
    row when there is nothing to learn from. Words are compared in lower case.
    A word none of whose letters is known counts for no language. Ties go to
    the language first in order. Repeated rows get equal answers.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sample = labelled_sample(rows, rows.select("doc_id", "lang"), "lang", held, max_rows,
                             "language-sample")
    model = fit_language(sample)
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    got = predicted(F.col("text"), spark.sparkContext.broadcast(model))
    return (rows.select("doc_id", got.alias("got"))
            .select("doc_id", F.col("got.lang").alias("lang_pred"), "got.score"))
