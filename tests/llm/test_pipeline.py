import random
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import mixing, substring, tokens
from tidewater.llm.common import landed, prepare

SMALL = "/root/testdata/sf0.001"


def test_each_stage_acts_on_what_came_before(spark):
    prepare(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("_copy", F.lit("clash"))
    columns, given = docs.columns, docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = landed(stage(spark, given, SMALL), f"test-{name}")
        if name != "packing":
            assert out.columns == columns, name
            given = out
        sizes.append(out.count())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "substring_dedup", "mixing", "packing"]
    assert 200 > sizes[0] > sizes[1] == sizes[2]
    words = given.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert words > 0
    total = out.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert total.where("n < 2048").count() <= 1 and total.agg(F.max("n")).first()[0] <= 2048
    assert out.agg(F.sum("length")).first()[0] >= words


def test_texts_without_repeats_stay_as_they_are(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"head  of\tone {passage} tail", "x"), (1, f"other {passage}", "y"),
            (None, "kept \n as it is", "z"), (4, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tid string")
    got = {r.tid: r.text for r in substring.without_repeats(df).collect()}
    assert got == {"x": "head of one tail", "y": "other", "z": "kept \n as it is", "n": None}


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(
            f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_after_toxicity_match_plain_python(spark):
    """Each stage on its own input: near-dedup, substring cut, mixing, packing."""
    prepare(spark)
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=50))
    rows = []
    for k in range(150):
        words = rng.choices(vocabulary, k=rng.randrange(30, 120))
        rows.append((k, " ".join(words), rng.choice(["a", "b", None])))
        if k % 5 == 0:  # a near-copy
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + k, " ".join(words), "a"))
        if k % 7 == 0:
            rows.append((2000 + k, " ".join(rng.choices(vocabulary, k=40)) + " " + passage, "b"))
    rows += [rows[0], rows[0], (3000, None, "a"), (3001, "", "b"), (3002, "two words", None)]
    docs = spark.createDataFrame([(*r, 0) for r in rows],
                                 "doc_id long, text string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)

    def out_of(name, given):
        out = landed(stages[name](spark, given, SMALL), f"plain-{name}")
        return out, Counter((r.doc_id, r.text) for r in out.collect())

    shingles = {}
    for i, text, _ in rows:
        w = (text or "").split()
        shingles[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in shingles}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in combinations(sorted(shingles), 2):
        a, b = shingles[i], shingles[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b) and find(i) != find(j):
            root[max(find(i), find(j))] = min(find(i), find(j))
    kept, got = out_of("near_dedup", docs)
    assert got == Counter({(i, text) for i, text, _ in rows if find(i) == i})
    assert len(set(shingles)) - 5 > len(got)

    windows = Counter(tuple(w[k:k + 35]) for _, text in got for w in [(text or "").split()]
                      for k in range(len(w) - 34))
    want = Counter()
    for i, text in got:
        w = (text or "").split()
        cut = {n for k in range(len(w) - 34) if windows[tuple(w[k:k + 35])] > 1
               for n in range(k, k + 35)}
        want[i, " ".join(x for n, x in enumerate(w) if n not in cut) if cut else text] += 1
    assert want != got
    kept, got = out_of("substring_dedup", kept)
    assert got == want

    copies = {r.doc_id: r.copies for r in mixing.mix_sources(kept).collect()}
    mixed, after = out_of("mixing", kept)
    assert after == +Counter({key: copies[key[0]] for key in got})

    encoder = Tokenizer.from_file(tokens.tokenizer_file())
    want = Counter()
    for (i, text), n in after.items():
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]
        for at, one in enumerate(ids):
            want[i, at, one] += n
    pieces = stages["packing"](spark, mixed, SMALL).collect()
    assert Counter((p.doc_id, p.start + k, int(one)) for p in pieces
                   for k, one in enumerate(np.frombuffer(p.ids, "<u4"))) == want
