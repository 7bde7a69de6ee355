"""Held-out accuracy on the given tables, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import language, quality, toxicity
from tidewater.llm.common import held_out, labelled_sample, prepare, table
from tidewater.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, score double, features string"
ODD = [(1, None, "en", None, 0.0, ""), (2, "", None, "s", 0.0, ""), (3, "123 !!", "en", "s", 0.0, ""),
       (None, "some text", None, None, 0.0, ""), (5, "long " * 30_000, "en", "s", 0.0, ""),
       (6, "same", "en", "s", 0.0, ""), (6, "same", "en", "s", 0.0, "")]
LABELS = "doc_id long, toxic int, quality int, text string"


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) \
        / ((y == 1).sum() * (y == 0).sum())


@pytest.mark.parametrize("name, label, least", [("op1_toxicity", "toxic", 0.8),
                                                ("op10_quality", "quality", 0.97)])
def test_held_out_scores(spark, name, label, least):
    got = QUERIES[name](spark, MID)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(spark, MID, "labels"), "doc_id").where("held_out").collect()
    y, s = np.array([r[label] for r in rows]), np.array([r["score"] for r in rows])
    assert auc(y, s) >= least and s.min() >= 0 and s.max() <= 1
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_language_held_out(spark):
    got = QUERIES["op5_language"](spark, MID)
    right = (got.join(table(spark, MID, "documents"), "doc_id").where("held_out")
             .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))).first()[0]
    assert right > 0.97


def test_unseen_words_back_off_to_their_grams():
    grams = {g: k for k, g in enumerate(["<da", "da", "a>", "b"])}
    scores = np.log(np.array([[.9, .1], [.6, .4], [.5, .5], [.1, .9], [.2, .8]]))
    model = language.LanguageModel(["x", "y"], {"dab": 4}, grams, scores)
    assert language.known_rows("dab", model) == [4]
    assert language.known_rows("dax", model) == [0]      # a trigram before shorter ones
    assert language.known_rows("oda", model) == [1, 2]
    assert language.known_rows("obo", model) == [3]
    assert language.known_rows("zzz", model) == []
    lang, score = language.predict("dab obo", language.Scored(model))
    assert lang == "y" and 0.5 < score <= 1
    assert language.predict("12 !", language.Scored(model)) == ("und", 0.0)


def test_odd_rows_and_missing_labels(spark):
    prepare(spark)
    docs = spark.createDataFrame(ODD, SCHEMA)
    for labels in ([], [(6, 1, 1, "x"), (6, None, 0, "x"), (None, 1, 1, "x")],
                   [(k, k % 2, k % 2, "x") for k in range(1, 7)]):
        labels = spark.createDataFrame(labels, LABELS)
        toxic = toxicity.score_toxicity(docs, labels, held=(1, 5)).collect()
        good = quality.score_quality(docs, labels, held=(1, 5)).collect()
        for got in (toxic, good):
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
            assert len({r.score for r in got if r.doc_id == 6}) == 1
        assert toxic[0].asDict().keys() == set(docs.columns)
    langs = {r.doc_id: r for r in language.identify_language(docs, held=(1, 5)).collect()}
    assert [langs[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and langs[5].lang_pred == "en"
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], LABELS)
    assert toxicity.score_toxicity(none, labels).collect() == []
    assert quality.score_quality(none, labels).collect() == []
    assert language.identify_language(none).collect() == []


def test_null_ids_are_held_out(spark):
    df = spark.createDataFrame([(None,), (7,)], "doc_id long")
    got = df.select(held_out(F.col("doc_id"), 5, 0)).collect()
    assert got[0][0] and got[1][0] in (True, False)


def test_learned_labels_only_from_the_other_folds(spark):
    """Flipping every held-out label changes no score."""
    small = "/root/testdata/sf0.001"
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    flipped = labels.withColumn("quality", F.when(out, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a = quality.score_quality(docs, labels).collect()
    b = quality.score_quality(docs, flipped).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 60, 12)) + (60 if k % 2 else 0) for k in range(80)]
    y = np.array([1.0 if k % 2 else -1.0 for k in range(80)])
    w, b = quality.dual_coordinate_descent(rows, y, np.ones(120), np.ones(80), 50)
    assert all(np.sign(w[r].sum() + b) == t for r, t in zip(rows, y))


def test_look_alike_signs_are_undone():
    assert toxicity.plain_form("1d10t") == ("idiot", True)
    assert toxicity.plain_form("i.d.i.o.t!") == ("idiot", True)
    assert toxicity.plain_form("Clown,") == ("clown", False)
    assert toxicity.plain_form("2024") == ("2024", False)


def test_the_middle_of_a_long_word_counts():
    rng = np.random.default_rng(3)
    one, two, middle = ("".join(map(chr, rng.integers(0x4E00, 0x9FA5, 300))) for _ in range(3))
    seen = quality.Indicators()
    a, b = seen.columns(one + middle + one), seen.columns("x" + two + middle + two)
    other = seen.columns("".join(reversed(one + two + one)))
    assert len(np.intersect1d(a, b)) > 250  # before: the one column of lines
    assert len(np.intersect1d(a, other)) < 50
    shape = quality.Indicators().columns("A1-" * 100 + "B_2.")
    assert len(np.setdiff1d(shape, quality.Indicators().columns("A1-" * 100 + "B.2_"))) > 3
    again = quality.Indicators()
    again.columns("some other words first")
    assert np.array_equal(again.columns(f"{one} {one} end"), again.columns(f"{one} {one} end"))
    assert len(again.columns("")) == 1


def test_a_sample_has_one_row_per_id(spark):
    prepare(spark)
    rows = [(k % 40, None if k == 5 else f"text {k}") for k in range(400)] + [(None, "none")] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] * 2, "doc_id long, quality int")
    got = [sorted(map(tuple, labelled_sample(d, labels, "quality", (3, 1), 10, "test-sample").collect()))
           for d in (docs, docs.repartition(7))]
    assert len(got[0]) == 10 and got[0] == got[1]  # before: 100 rows
    of = {text or "": i for i, text in rows}
    assert len({of[text] for text, *_ in got[0]}) == 10
    assert all(y == of[text] % 2 for text, y, _ in got[0])
