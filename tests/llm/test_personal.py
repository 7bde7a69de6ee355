import random
import re
import time

import pytest

from tidewater.llm import personal, queries
from tidewater.llm.common import prepare

# The contract's patterns as they are stated, and its checks.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def checks_out(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and checks_out(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def base_of(text):
    return [(s.start, s.kind, s.end) for s in personal.spans_of(text)[0]]


def test_base_rules_match_the_stated_patterns():
    rng = random.Random(6)
    pieces = ["a.b%c", "@", "@@", "x-y.", "example.com", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "+", "+1 (743) 555-3824", "+44", " ",
              "  ", "-", "(", ")", "é", "ß@ü.de", "007", "٣", "378282246310005", "\n", "\t", "0" * 20]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        assert base_of(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 100_000,
                                  "+1 " * 70_000, "1 " * 100_000, ":" * 200_000, "a at " * 40_000,
                                  "a.a@b.c" * 30_000, "(" * 200_000, "12:34 " * 30_000])
def test_long_texts_take_linear_time(text):
    began = time.process_time()
    base, others = personal.spans_of(text)
    assert time.process_time() - began < 5
    for s in (base + others)[:200]:
        assert 0 <= s.start < s.end <= len(text)


def brute_found(rows, rounds=3, min_seeds=3, confidence=0.8):
    """The same scores with dictionaries, document by document."""
    places, counts = [], {}
    for doc, text in rows:
        text = text or ""
        for t in personal.TOKEN.findall(text):
            h = personal.hashed(t.lower())
            counts[h] = counts.get(h, 0) + 1
        base, others = personal.spans_of(text)
        for s in base + others:
            for p, near, far in personal.patterns_of(text, s):
                places.append((doc, text, s, personal.instance_of(text, s), p, near, far))
    label = {}
    for _, _, s, i, *_ in places:
        label[i] = max(label.get(i, -1), s.label)
    n, tokens = {}, {}
    for _, _, _, i, p, near, far in places:
        n[p, i] = n.get((p, i), 0) + 1
        tokens[p] = (near, far)
    belief = {i: float(v == 1) for i, v in label.items()}
    conf = {}
    for _ in range(rounds):
        conf = {}
        for p, (near, far) in tokens.items():
            held = [(i, k) for (q, i), k in n.items() if q == p]
            if sum(belief[i] for i, _ in held) >= min_seeds:
                conf[p] = min(1.0, sum(k * belief[i] for i, k in held)
                              / (min(counts[near], counts[far]) + 1))
        for i, v in label.items():
            if v == -1:
                doubt = 1.0
                for (p, j) in n:
                    if j == i:
                        doubt *= 1 - min(conf.get(p, 0.0), 0.999999)
                belief[i] = 1 - doubt
    return sorted({(doc, s.start, s.end, s.kind) for doc, _, s, _, p, _, _ in places
                   if s.label == -1 and conf.get(p, 0.0) >= confidence}, key=str)


def corpus(rng):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]

    def prose(k):
        return " ".join(rng.choice(words) for _ in range(k))

    def local(k):
        return f"({200 + k}) 555-01{k:02d}"
    rows = []
    for k in range(30):  # seeds teach "telephone:" and "write to"
        rows.append((len(rows), f"{prose(20)} telephone: +1 (7{k:02d}) 555-38{k:02d} {prose(5)}"))
        rows.append((len(rows), f"{prose(9)} mailbox {rng.choice(words)}.{k}@mail{k}.example.com"))
    for k in range(6):   # found by "telephone:"; the same numbers teach "hotline"
        rows.append((len(rows), f"{prose(9)} telephone: {local(k)} {prose(4)}"))
        rows.append((len(rows), f"{prose(9)} hotline {local(k)} {prose(4)}"))
    rows.append((len(rows), f"{prose(9)} hotline 555 01 999 {prose(4)}"))  # second round
    rows.append((len(rows), f"{prose(9)} mailbox jo.doe (at) example (dot) org {prose(3)}"))
    rows.append((len(rows), f"{prose(9)} see 1234567890 and 555-0199-22 {prose(3)}"))  # no context
    rows.append((len(rows), "telephone: 4111 1111 1111 1112 telephone: 300.1.2.3"))  # rejected
    return rows


def test_patterns_discover_unseen_identifiers(spark):
    prepare(spark)
    rows = corpus(random.Random(3))
    rows += [rows[60], (None, rows[61][1]), (None, None), (7, ""), (900, "q" * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "doc_id long, text string, base string, label int").repartition(4)
    got = personal.find_personal_data(df).collect()
    assert len(got) == len(rows)
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(text or "")
    found = set()
    for r in got:
        assert any([(s["start"], s["kind"], s["end"]) for s in r["base"]] == plain_base(t)
                   for t in texts[r["id"]])
        found |= {(r["id"], s["start"], s["end"], s["kind"]) for s in r["found"]}
    assert sorted(found, key=str) == brute_found(rows)
    by_doc = dict(rows[:76])
    said = {by_doc[d][a:b] for d, a, b, _ in found if d is not None and d in by_doc}
    assert {"555 01 999", "jo.doe (at) example (dot) org", "(203) 555-0103"} <= said
    assert not any("1234567890" in t or "4111" in t or "300.1" in t for t in said)


def test_without_seeds_and_empty_table(spark):
    prepare(spark)
    schema = "doc_id string, text string"
    got = personal.find_personal_data(spark.createDataFrame(
        [("a", "telephone 555-123-4567"), ("b", None)], schema)).collect()
    assert [(r["id"], list(r["base"]), list(r["found"])) for r in got] == [("a", [], []),
                                                                          ("b", [], [])]
    assert personal.find_personal_data(spark.createDataFrame([], schema)).count() == 0


def test_query_over_whole_table(spark):
    import hashlib
    small = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op13_personal(spark, small).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        want = plain_base(texts[r["doc_id"]])
        said = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in personal.KINDS] == [
            sum(k == n for _, k, _ in want) for n in range(4)]
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))
        if not r["n_found"]:
            assert r["spans"] == said
