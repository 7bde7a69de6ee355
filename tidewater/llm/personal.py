"""Personal data by bootstrapped contextual extraction.

Base rules find e-mail addresses, IP addresses, card numbers and phone numbers
of usual form. They are the seeds. Other spans that look like an identifier of
some kind (numbers written otherwise, spelled-out addresses, colon-separated
addresses) are candidates, and what a base rule matched but rejected (a wrong
check digit, a part beyond 255) is known to be none.

Every seed and candidate induces lexical patterns: the one or two tokens
before it, the token after it, and both sides together. Patterns and the
instances they hold (the identifiers, by their digits or letters) are a graph
that Spark scores in rounds. A pattern's confidence is the share of its places
in the whole corpus that hold believed instances, so a context of ordinary
words never gets any; an instance is believed as its patterns are, seeds
wholly and rejected ones never. Candidates where a high-confidence pattern
stands are found; base spans always stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import landed, slices

KINDS = ("email", "ip", "card", "phone")
SEED, REJECTED, CANDIDATE = 1, 0, -1

# The base rules' characters and forms.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match from inside a run of digits fails as the one from its start does, so
# only starts of runs are tried and long runs cost no more than their length.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Looser forms of candidates.
NUMBER = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])+")
COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4})++")
AT = re.compile(r" ?[\[(] ?at ?[\])] ?| at ", re.IGNORECASE)
SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.| ?[\[(] ?dot ?[\])] ?| dot )"
                     r"[A-Za-z0-9-]{1,63})+", re.IGNORECASE)
LONGEST_LOCAL = 64
HEX = "0123456789ABCDEFabcdef"

#: Tokens of contexts: runs of letters and single signs, lower-cased.
TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]")
#: Code points around a span that are searched for its context.
REACH = 100
HELD_TOKENS = 200_000


class Span(NamedTuple):
    start: int
    end: int
    kind: int
    label: int


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 if d > 4 else 2 * d for d in digits[-2::-2])
    return (sum(digits[::-2]) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their sign outwards: the local part is all
    that fits before it, back to the last match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        done = at + 1
        if domain:
            yield Span(start, domain.end(), 0, SEED)
            done = domain.end()
        at = text.find("@", done)


def base_matches(text: str) -> Iterator[Span]:
    """Matches of the base rules, those that a check rejects included."""
    yield from emails(text)
    for m in IP.finditer(text):
        fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                   for p in m.group().split("."))
        yield Span(*m.span(), 1, SEED if fits else REJECTED)
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 14 <= len(digits) <= 19:
            yield Span(*m.span(), 2, SEED if luhn(digits) else REJECTED)
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m.group())) <= 15:
            yield Span(*m.span(), 3, SEED)


def loose_matches(text: str) -> Iterator[Span]:
    """Spans that may be identifiers written in another form."""
    for m in NUMBER.finditer(text):
        start, end = m.span()
        start -= text[start - 1:start] in ("+", "(") and start > 0
        digits = len(digits_of(m.group()))
        if 7 <= digits <= 19:
            yield Span(start, end, 3 if digits < 14 else 2, CANDIDATE)
    for m in COLONS.finditer(text):
        head = text[max(0, m.start() - 4):m.start()]
        yield Span(m.start() - len(head) + len(head.rstrip(HEX)), m.end(), 1, CANDIDATE)
    for m in AT.finditer(text):
        near = text[max(0, m.start() - LONGEST_LOCAL):m.start()]
        start = m.start() - len(near) + len(near.rstrip(LOCAL))
        domain = SPELLED.match(text, m.end()) if start < m.start() else None
        if domain:
            yield Span(start, domain.end(), 0, CANDIDATE)


def free_of(spans: Iterator[Span], blocked: list[Span]) -> Iterator[Span]:
    """Those of ``spans``, in order of place, that overlap neither a blocked
    span nor one another."""
    merged: list[list[int]] = []
    for b in sorted(blocked):
        if merged and b.start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b.end)
        else:
            merged.append([b.start, b.end])
    starts, last = [m[0] for m in merged], 0
    for s in spans:
        k = bisect_right(starts, s.end - 1) - 1
        if s.start >= last and (k < 0 or merged[k][1] <= s.start):
            yield s
            last = s.end


def in_a_word(text: str, s: Span) -> bool:
    before, after = text[max(0, s.start - 1):s.start], text[s.end:s.end + 1]
    return before.isalnum() or after.isalnum() or "_" in (before, after)


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, other spans) of a whole text. Base spans are ordered by
    start, then kind. The others are rejected matches and candidates that are
    no part of a word; they overlap no base span, candidates no rejected one."""
    matched = list(base_matches(text))
    base = sorted((s for s in matched if s.label == SEED), key=lambda s: (s.start, s.kind))
    rejected = list(free_of(sorted(s for s in matched if s.label == REJECTED), base))
    loose = sorted(s for s in loose_matches(text) if not in_a_word(text, s))
    return base, rejected + list(free_of(loose, base + rejected))


def hashed(*parts: object) -> int:
    """A long from the parts."""
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace")) - (
        1 << 63)


def instance_of(text: str, s: Span) -> int:
    """Card and phone numbers are the same by their digits, others by their
    letters in lower case."""
    said = text[s.start:s.end]
    return hashed(s.kind, "".join(map(str, digits_of(said))) if s.kind > 1 else said.lower())


def patterns_of(text: str, s: Span) -> list[tuple[int, int, int]]:
    """(pattern, token, token) of the contexts of a span; the tokens are those
    that stand nearest to it on the pattern's sides. A token that is cut by
    the reach is no context."""
    start = max(0, s.start - REACH)
    left = [hashed(m.group().lower()) for m in TOKEN.finditer(text, start, s.start)
            if m.start() > start or not start][-2:]
    end = min(len(text), s.end + REACH)
    first = TOKEN.search(text, s.end, end)
    right = hashed(first.group().lower()) if first and (first.end() < end or end == len(text)) \
        else None
    out = []
    if left:
        out.append((hashed(s.kind, "l", left[-1]), left[-1], left[-1]))
    if len(left) == 2:
        out.append((hashed(s.kind, "ll", *left), *left))
    if right is not None:
        out.append((hashed(s.kind, "r", right), right, right))
        if left:
            out.append((hashed(s.kind, "lr", left[-1], right), left[-1], right))
    return out


SPAN_FIELDS = "start: long, end: long, kind: int"
OTHER_FIELDS = (f"{SPAN_FIELDS}, label: int, instance: long, "
                "contexts: array<struct<pattern: long, near: long, far: long>>")


def arrow_spans(with_context: bool) -> pa.DataType:
    plain = [("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]
    context = pa.struct([(c, pa.int64()) for c in ("pattern", "near", "far")])
    return pa.list_(pa.struct(plain + [("label", pa.int32()), ("instance", pa.int64()),
                                       ("contexts", pa.list_(context))] * with_context))


def read_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, base, graph) per row: base spans, and every span that is
    part of the graph (base ones too) with its instance and contexts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base_out, graph_out = [], []
            for text in batch["text"].to_pylist():
                base, others = spans_of(text)
                base_out.append([{"start": s.start, "end": s.end, "kind": s.kind} for s in base])
                graph_out.append([
                    {"start": s.start, "end": s.end, "kind": s.kind, "label": s.label,
                     "instance": instance_of(text, s),
                     "contexts": [dict(zip(("pattern", "near", "far"), c))
                                  for c in patterns_of(text, s)]}
                    for s in base + others])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["text_hash"], pa.array(base_out, arrow_spans(False)),
                 pa.array(graph_out, arrow_spans(True))], ["id", "text_hash", "base", "graph"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
            .mapInArrow(scan, f"id {kind}, text_hash long, base array<struct<{SPAN_FIELDS}>>, "
                              f"graph array<struct<{OTHER_FIELDS}>>"))


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(token, n) over all whole texts, added up before the shuffle."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "token": pa.array([hashed(t.lower()) for t in held], pa.int64()),
                "n": pa.array(list(held.values()), pa.int64())})
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                held.update(TOKEN.findall(text or ""))
                if len(held) >= HELD_TOKENS:
                    yield out()
                    held.clear()
        if held:
            yield out()
    return (docs.select(F.col(text_col).cast("string").alias("text"))
            .mapInArrow(counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))


def confident_patterns(edges: DataFrame, docs: DataFrame, text_col: str, rounds: int,
                       min_seeds: int) -> DataFrame | None:
    """(pattern, confidence) after ``rounds`` rounds over the graph ``edges``
    (pattern, near, far, instance, label, n); None if no pattern has enough
    seeds, so that nothing could be found."""
    wide = (edges.groupBy("pattern").agg(
        F.count("*").alias("instances"), F.count_if(F.col("label") == SEED).alias("seeds"),
        F.first("near").alias("near"), F.first("far").alias("far"))
        .where(F.col("instances") >= min_seeds))
    wide = landed(wide, "personal-patterns")
    if wide.where(F.col("seeds") >= min_seeds).isEmpty():
        return None
    counts = landed(token_counts(docs, text_col), "personal-tokens")
    # A context stands at most as often as the rarer one of its tokens: the
    # places it has in the corpus, candidates or not.
    near, far = (counts.select(F.col("token").alias(c), F.col("n").alias(f"{c}_n"))
                 for c in ("near", "far"))
    places = landed(wide.join(near, "near").join(far, "far").select(
        "pattern", F.least("near_n", "far_n").alias("places")), "personal-places")
    edges = landed(edges.join(places, "pattern").select("pattern", "places", "instance", "label",
                                                        "n"), "personal-edges")
    belief, confidence = None, None
    for _ in range(rounds):
        held = edges if belief is None else edges.join(belief, "instance", "left")
        believed = (F.when(F.col("label") == SEED, 1.0).when(F.col("label") == REJECTED, 0.0)
                    .otherwise(F.lit(0.0) if belief is None else F.coalesce("belief", F.lit(0.0))))
        confidence = landed(
            held.withColumn("b", believed).groupBy("pattern")
            .agg((F.sum(F.col("n") * F.col("b")) / (F.max("places") + 1)).alias("confidence"),
                 F.sum("b").alias("support"))
            .where(F.col("support") >= min_seeds)
            .select("pattern", F.least("confidence", F.lit(1.0)).alias("confidence")),
            "personal-confidence")
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999999))))
        belief = landed(edges.where(F.col("label") == CANDIDATE).join(confidence, "pattern")
                        .groupBy("instance").agg((1 - F.exp(doubt)).alias("belief")),
                        "personal-belief")
    return confidence


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       rounds: int = 3, min_seeds: int = 3,
                       confidence: float = 0.8) -> DataFrame:
    """(id, base, found) per row of ``docs``: arrays of (start, end, kind),
    code points, end exclusive, kind a place in :data:`KINDS`, each ordered by
    start, then kind. ``found`` are the spans that only patterns find; they
    overlap no base span.

    A pattern counts with ``min_seeds`` believed instances or more and finds
    with a confidence of ``confidence`` or more. Scores are gathered over all
    documents. A null text is empty and has no span. Rows that repeat, also
    those without an id, have the same spans; other columns are ignored; an
    empty table gives an empty result.
    """
    rows = landed(read_spans(docs, id_col, text_col), "personal-spans")
    places = (rows.select("id", "text_hash", F.explode("graph").alias("s"))
              .select("id", "text_hash", "s.start", "s.end", "s.kind", "s.label", "s.instance",
                      F.explode("s.contexts").alias("c")))
    # What is a seed anywhere is one everywhere.
    labels = (rows.select(F.explode("graph").alias("s")).groupBy("s.instance")
              .agg(F.max("s.label").alias("label")))
    edges = landed(places.groupBy(F.col("c.pattern").alias("pattern"), "instance")
                   .agg(F.count("*").alias("n"), F.first("c.near").alias("near"),
                        F.first("c.far").alias("far"))
                   .join(labels, "instance"), "personal-graph")
    scored = confident_patterns(edges, docs, text_col, rounds, min_seeds)
    nothing = F.lit(None).cast(f"array<struct<{SPAN_FIELDS}>>")
    if scored is None:
        return rows.select("id", "base", F.coalesce(nothing, F.array()).alias("found"))
    strong = scored.where(F.col("confidence") >= confidence).select("pattern")
    found = (places.where(F.col("label") == CANDIDATE)
             .join(strong, F.col("c.pattern") == strong["pattern"], "left_semi")
             .groupBy("id", "text_hash")
             .agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("found")))
    given = found.select(F.col("id").alias("found_id"), F.col("text_hash").alias("found_hash"),
                         "found")
    same = rows["id"].eqNullSafe(given["found_id"]) & (rows["text_hash"] == given["found_hash"])
    return rows.join(given, same, "left").select(
        "id", "base", F.coalesce("found", F.array()).alias("found"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, by start, then kind, comma-joined."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
