"""MinHash near-duplicates with odd sketches.

Every distinct shingle set is one node. Its MinHash samples give band keys,
which propose candidates, and an odd sketch: the parity bitmap of the samples.
The population count of two sketches' XOR estimates a high similarity closely,
so a candidate pair reaches the exact check on full sets only if its sketches
agree well enough. A bucket proposes its members against one leader (another
one in each bucket); members that stay in different components are compared
block by block on their full sets, so no bucket is expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import (U64, connected_components, drop_stores, landed, mixed, ngram_hashes,
                                  slices, word_hashes, words_of)

BANDS, ROWS = 20, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
SKETCH = [f"s{k}" for k in range(SKETCH_BITS // 64)]
BAND = [f"b{k}" for k in range(BANDS)]
BLOCK = 512
#: A pair whose sketches estimate less than the threshold minus this is dropped
#: unseen: over five standard deviations of the estimate at 80 samples.
MARGIN = 0.25
SEEDS = mixed(np.arange(1, SAMPLES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
FACTORS = mixed(SEEDS) | U64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a whole text,
    A-Z lower-cased; a text with fewer words is one shingle, an empty one none."""
    words = words_of(text)
    h = word_hashes([w.lower() for w in words])
    return np.unique(ngram_hashes(h, min(width, len(h)) or 1) + U64(min(width, len(h))))


def node_of(shingles: np.ndarray) -> int:
    """The identity of a set: 64 bits of the hash of its sorted members."""
    return int(np.int64(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    best = np.full(SAMPLES, np.iinfo(U64).max, U64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048]
        best = np.minimum(best, ((part[None, :] ^ SEEDS[:, None]) * FACTORS[:, None]).min(1))
    return best


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Rows of samples to rows of 64-bit words of the parity bitmap."""
    at = mixed(samples + SEEDS[None, :]) & U64(SKETCH_BITS - 1)
    flat = at.astype(np.int64) + SKETCH_BITS * np.arange(len(samples))[:, None]
    parity = (np.bincount(flat.ravel(), minlength=SKETCH_BITS * len(samples)) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(len(samples), -1), axis=1).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(len(samples), BANDS, ROWS)
    keys = np.broadcast_to(SEEDS[:BANDS], parts.shape[:2])
    for k in range(ROWS):
        keys = mixed(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys.view(np.int64)


def most_flips(percent: int) -> int:
    """Largest population count of an XOR of sketches that stays a candidate."""
    differing = SAMPLES * (1 - percent / 100 + MARGIN)
    return int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * differing)))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, node, n, bands, sketch) of a (doc_id, text) table; node is null
    for a text without words."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_stores()
        for batch in slices(batches):
            sets = [shingle_set(t, width) for t in batch["text"].to_pylist()]
            samples = np.stack([minhashes(s) for s in sets])
            bands, sketch = band_keys(samples), odd_sketches(samples)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([node_of(s) if len(s) else None for s in sets],
                                           pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 *(pa.array(bands[:, k]) for k in range(BANDS)),
                 *(pa.array(sketch[:, k]) for k in range(len(SKETCH)))],
                names=["doc_id", "node", "n", *BAND, *SKETCH])

    longs = ", ".join(f"{c} long" for c in ["doc_id", "node", "n", *BAND, *SKETCH])
    return docs.mapInArrow(signed, longs)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    return landed(pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a")
                  .join(sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
                  .where(similar("x", "y")).select("a", "b"), "minhash-links")


def common_members(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all sets of x with all of y, as products of
    indicator matrices over the members that both sides have."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])

    (members_x, row_x), (members_y, row_y) = flat(x), flat(y)
    shared = np.intersect1d(members_x, members_y)
    out = np.zeros((len(x), len(y)), np.float32)
    if not len(shared):
        return out
    sides = []
    for members, row in ((members_x, row_x), (members_y, row_y)):
        at = np.minimum(np.searchsorted(shared, members), len(shared) - 1)
        is_shared = shared[at] == members
        at, row = at[is_shared], row[is_shared]
        order = np.argsort(at, kind="stable")
        sides.append((at[order], row[order]))
    for first in range(0, len(shared), 4096):  # counts stay far below 2**24: exact
        parts = []
        for (at, row), n in zip(sides, (len(x), len(y))):
            lo, hi = np.searchsorted(at, [first, first + 4096])
            part = np.zeros((n, min(4096, len(shared) - first)), np.float32)
            part[row[lo:hi], at[lo:hi] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def block_links(rows: DataFrame, sets: DataFrame, flips: int, percent: int) -> DataFrame:
    """Links (a, b) between different components of one bucket (columns key,
    node, comp, n, bands, sketch), checked on full sets.

    Members of a bucket's largest component need no comparison with one
    another: the others are compared with them and among themselves. Both
    kinds are dealt over blocks of about ``BLOCK``; a pair of blocks is one
    group, compared in memory. A pair is compared in its first common bucket
    only: an earlier one has done it, or its leaders have. Of the links of a node with one component one
    is returned, which is all that components need.
    """
    def compared(table: pa.Table) -> pa.Table:
        t = {c: table[c].combine_chunks() for c in table.column_names}
        node, block, comp, n = (t[c].to_numpy() for c in ("node", "block", "comp", "n"))
        order = np.argsort(node, kind="stable")
        left, right = (order[block[order] == t[c][0].as_py()] for c in ("i", "j"))
        nothing = np.zeros(0, np.int64)
        a = b = nothing
        if len(left) and len(right):
            a, b = links_between(left, right, node, comp, n, t)
        return pa.table({"a": a, "b": b})

    def links_between(left: np.ndarray, right: np.ndarray, node: np.ndarray, comp: np.ndarray,
                      n: np.ndarray, t: dict) -> tuple[np.ndarray, np.ndarray]:
        bands, sketch = (t[c].flatten().to_numpy().reshape(len(node), -1)
                         for c in ("bands", "sketch"))
        near = comp[left][:, None] != comp[right][None, :]
        n, m = n[left][:, None], n[right][None, :]
        near &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
        earlier = int(np.flatnonzero(bands[left[0]] == t["key"][0].as_py())[0])
        for k in range(earlier if near.any() else 0):
            near &= bands[left, k][:, None] != bands[right, k][None, :]
        if near.any():
            x, y = sketch[left].view(U64), sketch[right].view(U64)
            flipped = np.zeros(near.shape, np.int32)
            for k in range(x.shape[1]):
                flipped += np.bitwise_count(x[:, None, k] ^ y[None, :, k])
            near &= flipped <= flips
        some, other = near.any(1), near.any(0)
        if not some.any():
            return node[:0], node[:0]
        common = common_members(*([np.frombuffer(t["members"][k].as_buffer(), U64) for k in rows]
                                  for rows in (left[some], right[other])))
        union = n[some] + m[:, other] - common
        at = np.nonzero(near[some][:, other] & (100 * common >= percent * union))
        a, b = left[some][at[0]], right[other][at[1]]
        _, first = np.unique(np.stack([a, comp[b]]), axis=1, return_index=True)
        return node[a[first]], node[b[first]]

    sizes = rows.groupBy("key", "comp").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "comp")).alias("most"),
                                       F.sum("size").alias("all"))
    blocks = largest.select("key", F.col("most.comp").alias("main"),
                            F.ceil((F.col("all") - F.col("most.size")) / BLOCK).alias("others"),
                            F.ceil(F.col("most.size") / BLOCK).alias("mains"))
    packed = rows.select("key", "node", "comp", "n", F.array(*BAND).alias("bands"),
                         F.array(*SKETCH).alias("sketch"))
    dealt = packed.join(blocks, "key").withColumn("is_main", F.col("comp") == F.col("main"))
    # Blocks of the others count up from 0, those of the main one down from -1.
    block = F.when(F.col("is_main"), -1 - F.pmod(F.xxhash64("node"), "mains")) \
        .otherwise(F.pmod(F.xxhash64("node"), "others"))
    others = F.sequence(F.lit(0).cast("long"), F.col("others") - 1)
    mains = F.sequence(F.lit(-1).cast("long"), -F.col("mains"), F.lit(-1).cast("long"))
    dealt = (dealt.withColumn("block", block)
             .withColumn("other", F.explode(F.when(F.col("is_main"), others)
                                            .otherwise(F.concat(others, mains))))
             .withColumn("i", F.greatest("block", "other"))
             .withColumn("j", F.least("block", "other"))
             .withColumn("pair", F.xxhash64("key", "i", "j"))
             .join(sets.select("node", "members"), "node")
             .select("pair", "key", "i", "j", "block", "node", "comp", "n", "bands", "sketch",
                     "members"))
    # Arrow, not pandas: most groups are small, and there are very many of them.
    return dealt.groupBy("pair").applyInArrow(compared, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id, kept).

    Documents link when 100 * |A and B| >= percent * |A or B| for their sets of
    distinct ``width``-word shingles; component_id is the smallest id reachable
    and kept marks it. Equal sets always link. Null and empty texts have no
    shingles, link with nothing and are kept. Repeated rows of one id are one
    document for their component and are all kept or all dropped; a null id
    takes part, but is kept only if its component has no id at all. Other
    columns are not read. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"))
    signed = landed(signatures(texts, width), "minhash-signatures")
    nodes = landed(signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"),
        *(F.max(c).alias(c) for c in [*BAND, *SKETCH])), "minhash-nodes")

    keys = nodes.select("node", F.explode(F.array(*BAND)).alias("key"))
    # Which member leads differs from bucket to bucket: order by node xor key.
    order = F.col("node").bitwiseXOR(F.col("key"))
    buckets = keys.groupBy("key").agg(F.min(order).alias("first"), F.max(order).alias("last")) \
        .where("first <> last").select("key", F.col("first").bitwiseXOR(F.col("key")).alias("lead"),
                                       F.col("last").bitwiseXOR(F.col("key")).alias("second"))
    members = landed(keys.join(buckets, "key"), "minhash-buckets")
    pairs = members.where("node <> lead").select(F.col("lead").alias("a"),
                                                 F.col("node").alias("b")).distinct()
    facts = nodes.select("node", "n", *SKETCH)

    def side(name: str) -> DataFrame:
        return facts.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}")
                                                         for c in ["n", *SKETCH]))
    flips = most_flips(percent)
    flipped = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH),
                  F.lit(0))
    alike = (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")) & (flipped <= flips)
    candidates = landed(pairs.join(side("a"), "a").join(side("b"), "b").where(alike)
                        .select("a", "b", flipped.alias("flipped")), "minhash-candidates")

    wanted = (members.select("node").distinct().join(nodes.select("node", "rep"), "node")
              .withColumnRenamed("rep", "doc_id"))
    needed = wanted.select("doc_id").distinct()
    sets = landed(set_rows(texts.join(needed, texts["doc_id"].eqNullSafe(needed["doc_id"]),
                                      "left_semi").dropDuplicates(["doc_id", "text"]), width)
                  .join(wanted.select("node"), "node", "left_semi"), "minhash-sets")

    # First each node against the leader most like it, then what that left apart.
    best = (candidates.groupBy("b").agg(F.min(F.struct("flipped", "a")).alias("best"))
            .select(F.col("best.a").alias("a"), "b"))
    first = verified(best, sets, percent)
    comps = labels(nodes, first)
    left = apart(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), comps)
    links = landed(first.union(verified(left, sets, percent)), "minhash-links")

    # Buckets of three or more whose members are still in several components.
    comps = labels(nodes, links)
    crowded = members.where("node <> lead and node <> second").select("key").distinct()
    inside = (members.select("key", "node").join(crowded, "key", "left_semi")
              .join(comps, "node"))
    split = inside.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")) \
        .where("x <> y").select("key")
    open_rows = landed(inside.join(split, "key", "left_semi")
                       .join(facts.join(nodes.select("node", *BAND), "node"), "node"),
                       "minhash-open")
    if not open_rows.isEmpty():
        found = landed(block_links(open_rows, sets, flips, percent), "minhash-links")
        if not found.isEmpty():
            comps = labels(nodes, links.union(found))

    smallest = (nodes.join(comps, "node").groupBy("comp").agg(F.min("rep").alias("component")))
    of_node = comps.join(smallest, "comp").select("node", "component")
    joined = signed.select("doc_id", "node", "n").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def set_rows(texts: DataFrame, width: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_stores()
        for batch in slices(batches):
            sets = [s for t in batch["text"].to_pylist() if len(s := shingle_set(t, width))]
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([node_of(s) for s in sets], pa.int64()),
                "members": pa.array([s.tobytes() for s in sets], pa.binary())})
    return texts.select("text").mapInArrow(rows, "node long, members binary")


def labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) of every node; a node without links is its own component."""
    roots = connected_components(links, "minhash-components")
    return landed(nodes.select("node").join(roots, "node", "left")
                  .select("node", F.coalesce("root", "node").alias("comp")), "minhash-comps")


def apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    return (pairs.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("x")), "a")
            .join(comps.select(F.col("node").alias("b"), F.col("comp").alias("y")), "b")
            .where("x <> y").select("a", "b"))
