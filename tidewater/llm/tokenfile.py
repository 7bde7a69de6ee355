"""Token-id files: an adaptive context-mixing range coder.

Ids are written in ascending document order as blocks of at most ``BLOCK_IDS``
ids. Every block starts from the same fresh model and carries a checksum, so
each can be read alone. Blocks are rows of Parquet files in range order (one
file per id range), which keeps Spark's commit protocol and any store that
Spark can write to.

Model of a block: the id that last followed the last two ids (order 2), the
one that last followed the last id (order 1), and an adaptive distribution
over all ids of the block so far by how often they came (order 0) predict the
next one. First a symbol is coded: which order holds, or, for an id that is new
in the block, its size class. Its probability is a mix of three adaptive
distributions (given the last two, one or no symbols), weighted by how well
each did so far in the block. At order 0 the id itself follows, by its
frequency; a new id has the plain bits of its class. All blocks of a batch
advance in step, one array operation for all of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import U64, landed, range_of, range_starts, slices, worker_store
from tidewater.llm.tokens import END_ID, Encoder

BLOCK_IDS = 4096
#: Blocks that advance in step; more of them share the cost of each array call.
LANES = 2560
MAGIC = b"TWR2"
HEADER = 16  # magic, ids, 16-bit words, crc32 of the ids

HIT2, HIT1, SEEN, SMALL = 0, 1, 2, 3
SYMBOLS = 12
#: Plain bits after each symbol, and the id at which its class starts.
EXTRA = np.array([0, 0, 0, 9, 9, 10, 11, 12, 13, 14, 15, 0])
BASE = np.array([0, 0, 0, 0, 512, 1024, 2048, 4096, 8192, 16384, 32768, 0])
SIZE_CLASS = np.array([SMALL] * 512 + [SMALL + k.bit_length() - 9 for k in range(512, 1 << 16)],
                      np.int64)
ONE = 1 << 16      # probability one of a distribution
RATE = 5
TABLE2, TABLE1 = 1 << 12, 1 << 11
MASK = U64((1 << 48) - 1)
LOW32 = U64((1 << 32) - 1)


class Frequencies:
    """How often each of ``places`` places of ``n`` lists came, with sums over
    all places before one: binary indexed trees, one after the other. Entry 0
    of a tree stays 0 and its last one takes what runs over the end. Counts
    and sums have 16 bits, so a list takes 65,535 places."""

    def __init__(self, n: int, places: int):
        self.levels = max(1, (places - 1).bit_length())
        self.places = 1 << self.levels
        self.stride = self.places + 2
        self.tree = np.zeros(n * self.stride, np.uint16)
        self.count = np.zeros(n * self.places, np.uint16)

    def times(self, lanes: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.count.take(lanes * self.places + place)

    def before(self, lanes: np.ndarray, place: np.ndarray) -> np.ndarray:
        row, at, out = lanes * self.stride, place.copy(), np.zeros(len(place), np.int64)
        for _ in range(self.levels):
            out += self.tree.take(row + at)
            at &= at - 1
        return out

    def find(self, lanes: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place whose share holds ``target``, and the sum before it."""
        row, at, rest = lanes * self.stride, np.zeros(len(target), np.int64), target.copy()
        for level in range(self.levels - 1, -1, -1):
            there = self.tree.take(row + at + (1 << level)).astype(np.int64)
            right = there <= rest
            at += right << level
            rest -= there * right
        return at, target - rest

    def add(self, lanes: np.ndarray, place: np.ndarray) -> None:
        self.count[lanes * self.places + place] += 1
        row, at = lanes * self.stride, place + 1
        for _ in range(self.levels + 1):
            self.tree[row + at] += 1
            at += at & -at
            np.minimum(at, self.places + 1, out=at)


class Model:
    """State of the models of ``n`` blocks, longest first; each step works on
    the first ``m`` of them, those that still have an id. Ids are known by
    their places in the order in which they first came in the block."""

    def __init__(self, n: int, longest: int):
        self.t2 = np.zeros(n * TABLE2, np.uint16)
        self.t1 = np.zeros(n * TABLE1, np.uint16)
        self.known = Frequencies(n, longest)
        self.own = np.arange(n)
        self.base2, self.base1 = (self.own * k for k in (TABLE2, TABLE1))
        self.p0 = np.full((n, SYMBOLS), ONE // SYMBOLS, np.int32)
        self.p1 = np.full((n * SYMBOLS, SYMBOLS), ONE // SYMBOLS, np.int32)
        self.p2 = np.full((n * SYMBOLS * SYMBOLS, SYMBOLS), ONE // SYMBOLS, np.int32)
        self.weight = np.full((3, n), 1 << 12, np.int32)
        self.last, self.before = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.symbol, self.symbol_before = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.q1, self.q2, self.mixed, self.part = (np.empty((n, SYMBOLS), np.int32)
                                                   for _ in range(4))
        self.cumulative = np.zeros((n, SYMBOLS + 1), np.int32)

    def predict(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Places predicted by orders 2 and 1, from 1 on, 0 for none; finds the
        rows in which the next one is learned."""
        hashed = self.last[:m] * 40503
        self.at2 = (hashed + self.before[:m] * 9973 >> 3 & TABLE2 - 1) + self.base2[:m]
        self.at1 = (hashed >> 4 & TABLE1 - 1) + self.base1[:m]
        return self.t2.take(self.at2), self.t1.take(self.at1)

    def mix(self, m: int) -> np.ndarray:
        """Cumulative frequencies of the symbols, a leading 0 included."""
        self.row1 = self.own[:m] * SYMBOLS + self.symbol[:m]
        self.row2 = self.row1 * SYMBOLS + self.symbol_before[:m]
        self.q = (self.p0[:m], self.p1.take(self.row1, 0, self.q1[:m], "clip"),
                  self.p2.take(self.row2, 0, self.q2[:m], "clip"))
        weight = self.weight[:, :m]
        share = (weight << 12) // weight.sum(0, dtype=np.int32)
        mixed, part = self.mixed[:m], self.part[:m]
        np.multiply(share[0][:, None], self.q[0], out=mixed)
        for k in (1, 2):
            np.multiply(share[k][:, None], self.q[k], out=part)
            mixed += part
        mixed >>= 16
        mixed += 1
        np.cumsum(mixed, axis=1, out=self.cumulative[:m, 1:])
        return self.cumulative[:m]

    def learn(self, m: int, symbol: np.ndarray, place: np.ndarray) -> None:
        at, part = self.own[:m] * SYMBOLS + symbol, self.part[:m]
        for k, q in enumerate(self.q):
            w, flat = self.weight[k, :m], q.reshape(-1)
            w += (flat.take(at) >> 9) - (w >> RATE) + 1
            np.right_shift(q, RATE, out=part)
            q -= part
            flat[at] += ONE >> RATE
        self.p1[self.row1], self.p2[self.row2] = self.q[1], self.q[2]
        self.t2[self.at2] = self.t1[self.at1] = place + 1
        self.known.add(self.own[:m], place)
        self.before[:m], self.last[:m] = self.last[:m], place + 1
        self.symbol_before[:m], self.symbol[:m] = self.symbol[:m], symbol


def settle(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which 48-bit intervals have a settled top word, and their spans: an
    interval that got too narrow without one is cut at the next boundary."""
    same = (low ^ (low + span)) >> U64(32) == 0
    narrow = ~same & (span < U64(1 << 32))
    if narrow.any():
        span = np.where(narrow, -low & LOW32, span)
    return same | narrow, span


def places_of(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each id of a block: its place in the order of first occurrences, and
    whether it is new there."""
    _, first, which = np.unique(block, return_index=True, return_inverse=True)
    place = np.empty(len(first), np.int64)
    place[np.argsort(first)] = np.arange(len(first))
    return place[which], np.arange(len(block)) == first[which]


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Blocks of 16-bit ids to coded blocks, all in step."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    lengths = np.array([len(blocks[k]) for k in order])
    steps = int(lengths[0]) if len(order) else 0
    ids = np.zeros((steps, len(order)), np.uint16)
    places, news = np.zeros(ids.shape, np.uint16), np.zeros(ids.shape, bool)
    for lane, k in enumerate(order):
        n = len(blocks[k])
        ids[:n, lane] = blocks[k]
        places[:n, lane], news[:n, lane] = places_of(blocks[k])
    model = Model(len(order), steps)
    low, span = np.zeros(len(order), U64), np.full(len(order), MASK)
    words = np.zeros((len(order), 2 * steps + 8), np.uint16)
    filled = np.zeros(len(order), np.int64)
    for step in range(steps):
        n = int(np.searchsorted(-lengths, -step, "left"))  # blocks that have this id
        lane, x = model.own[:n], ids[step, :n].astype(np.int64)
        place = places[step, :n].astype(np.int64)
        by2, by1 = model.predict(n)
        symbol = np.where(place + 1 == by2, HIT2, np.where(
            place + 1 == by1, HIT1, np.where(news[step, :n], SIZE_CLASS[x], SEEN)))
        # What follows the symbol: its part of a whole.
        whole, start = 1 << EXTRA[symbol], np.where(symbol < SMALL, 0, x - BASE[symbol])
        count = np.ones(n, np.int64)
        seen = np.flatnonzero(symbol == SEEN)
        whole[seen], start[seen] = step, model.known.before(seen, place[seen])
        count[seen] = model.known.times(seen, place[seen])
        cumulative = model.mix(n)
        first, after = cumulative[lane, symbol], cumulative[lane, symbol + 1]
        unit = span[:n] // cumulative[:, -1].astype(U64)
        share = unit * (after - first).astype(U64) // whole.astype(U64)
        low[:n] += unit * first.astype(U64) + share * start.astype(U64)
        span[:n] = share * count.astype(U64)
        model.learn(n, symbol, place)
        emit, span[:n] = settle(low[:n], span[:n])
        while emit.any():
            k = np.flatnonzero(emit)
            words[k, filled[k]] = low[k] >> U64(32)
            filled[k] += 1
            low[k] = low[k] << U64(16) & MASK
            span[k] <<= U64(16)
            emit, span[:n] = settle(low[:n], span[:n])
    for _ in range(3):
        words[np.arange(len(order)), filled] = low >> U64(32)
        filled += 1
        low = low << U64(16) & MASK
    out = [b""] * len(blocks)
    for lane, k in enumerate(order):
        head = np.array([len(blocks[k]), filled[lane],
                         zlib.crc32(blocks[k].astype("<u4").tobytes())], "<u4")
        out[k] = MAGIC + head.tobytes() + words[lane, :filled[lane]].astype("<u2").tobytes()
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """Coded blocks back to their ids; ValueError for a damaged block."""
    heads = []
    for c in coded:
        if len(c) < HEADER or c[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        heads.append(np.frombuffer(c, "<u4", 3, 4))
        if len(c) != HEADER + 2 * int(heads[-1][1]):
            raise ValueError("a block of token ids is cut off")
    order = sorted(range(len(coded)), key=lambda k: -int(heads[k][0]))
    lengths = np.array([int(heads[k][0]) for k in order], np.int64)
    steps = int(lengths[0]) if len(order) else 0
    size = max((int(h[1]) for h in heads), default=0) + 4
    words = np.zeros((len(order), size), U64)
    for lane, k in enumerate(order):
        words[lane, :int(heads[k][1])] = np.frombuffer(coded[k], "<u2", offset=HEADER)
    ids = np.zeros((steps, len(order)), np.uint16)
    id_at = np.zeros((steps, len(order)), np.uint16)     # id of each place
    places = np.zeros(len(order), np.int64)              # places given so far
    model = Model(len(order), steps)
    low, span = np.zeros(len(order), U64), np.full(len(order), MASK)
    code = words[:, 0] << U64(32) | words[:, 1] << U64(16) | words[:, 2]
    taken = np.full(len(order), 3)
    for step in range(steps):
        n = int(np.searchsorted(-lengths, -step, "left"))
        lane = model.own[:n]
        by2, by1 = model.predict(n)
        cumulative = model.mix(n)
        unit = span[:n] // cumulative[:, -1].astype(U64)
        at = ((code[:n] - low[:n]) // unit).astype(np.int64)
        symbol = np.minimum((cumulative[:, 1:] <= at[:, None]).sum(1), SYMBOLS - 1)
        first, after = cumulative[lane, symbol], cumulative[lane, symbol + 1]
        low[:n] += unit * first.astype(U64)
        whole, count = 1 << EXTRA[symbol], np.ones(n, np.int64)
        seen = np.flatnonzero(symbol == SEEN)
        whole[seen] = max(step, 1)
        share = unit * (after - first).astype(U64) // whole.astype(U64)
        # A damaged block may hold anything; its checksum tells in the end.
        start = np.minimum(((code[:n] - low[:n]) // share).astype(np.int64), whole - 1)
        is_new = symbol >= SMALL
        place = np.where(symbol == HIT2, by2, by1).astype(np.int64) - 1
        place[seen], start[seen] = model.known.find(seen, start[seen])
        place = np.where(is_new, places[:n], place)
        np.clip(place, 0, steps - 1, out=place)
        count[seen] = np.maximum(model.known.times(seen, place[seen]), 1)
        start[symbol < SEEN] = 0
        low[:n] += share * start.astype(U64)
        span[:n] = share * count.astype(U64)
        id_at[place[is_new], lane[is_new]] = (BASE[symbol] + start)[is_new]
        places[:n] += is_new
        ids[step, :n] = id_at[place, lane]
        model.learn(n, symbol, place)
        pull, span[:n] = settle(low[:n], span[:n])
        while pull.any():
            k = np.flatnonzero(pull)
            code[k] = code[k] << U64(16) & MASK | words[k, np.minimum(taken[k], size - 1)]
            taken[k] += 1
            low[k] = low[k] << U64(16) & MASK
            span[k] <<= U64(16)
            pull, span[:n] = settle(low[:n], span[:n])
    out: list = [None] * len(coded)
    for lane, k in enumerate(order):
        block = ids[:lengths[lane], lane].copy()
        if zlib.crc32(block.astype("<u4").tobytes()) != int(heads[k][2]):
            raise ValueError("a block of token ids does not match its checksum")
        out[k] = block
    return out


# -- files -------------------------------------------------------------------

BLOCK_ROW = ("range int, block long, first_id long, n_ids long, docs array<struct<doc_no: long, doc_id: long, "
             "piece: long, length: long>>, coded binary")


def write_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              parts: int | None = None) -> DataFrame:
    """Write the ids of whole texts, an end id after each, and return the
    landed files as a table (one row per block, see BLOCK_ROW).

    Documents are in ascending id order (null ids first, equal ids by text)
    over ranges that each are one sorted file. A null or empty text is the end
    id alone. A document that fits a block is not cut. An empty table gives
    files without rows.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"),
                       F.col(text_col).alias("text"))
    starts = range_starts(rows.select("key"), parts or max(4, rows.rdd.getNumPartitions()))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(tokenizer), np.array([END_ID], np.uint16)
        state = {"range": None, "doc": 0, "block": 0, "ids": 0}
        pending: list[tuple[list[dict], list[np.ndarray]]] = []
        docs_in: list[dict] = []
        ids_in: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            blocks = [np.concatenate(ids) for _, ids in pending]
            rows = []
            for (d, _), b, c in zip(pending, blocks, encode_blocks(blocks)):
                rows.append({"range": state["range"], "block": state["block"],
                             "first_id": state["ids"], "n_ids": len(b), "docs": d, "coded": c})
                state["block"] += 1
                state["ids"] += len(b)
            pending.clear()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, BLOCK_SCHEMA)

        for batch in slices(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            for rng, doc_id, ids in zip(batch["range"].to_pylist(), batch["doc_id"].to_pylist(),
                                        encoder.encode(texts)):
                if rng != state["range"]:
                    if ids_in:
                        pending.append((docs_in, ids_in))
                        docs_in, ids_in, size = [], [], 0
                    yield from flush()
                    state.update(range=rng, doc=0, block=0, ids=0)
                x = np.concatenate([np.frombuffer(ids, np.uint16), end])
                for piece, at in enumerate(range(0, len(x), BLOCK_IDS)):
                    part = x[at:at + BLOCK_IDS]
                    if size + len(part) > BLOCK_IDS:
                        pending.append((docs_in, ids_in))
                        docs_in, ids_in, size = [], [], 0
                        if len(pending) >= LANES:
                            yield from flush()
                    docs_in.append({"doc_no": state["doc"], "doc_id": doc_id, "piece": piece,
                                    "length": len(part)})
                    ids_in.append(part)
                    size += len(part)
                state["doc"] += 1
        if ids_in:
            pending.append((docs_in, ids_in))
        yield from flush()

    n = max(1, len(starts))
    ranged = (rows.withColumn("range", (range_of(F.col("key"), starts) if starts else F.lit(0))
                              .cast("int"))
              .repartitionById(n, "range").sortWithinPartitions("range", "key", "text"))
    return landed(ranged.select("range", "doc_id", "text").mapInArrow(coded, BLOCK_ROW),
                  "token-files")


BLOCK_SCHEMA = pa.schema([
    ("range", pa.int32()), ("block", pa.int64()), ("first_id", pa.int64()),
    ("n_ids", pa.int64()),
    ("docs", pa.list_(pa.struct([("doc_no", pa.int64()), ("doc_id", pa.int64()),
                                 ("piece", pa.int64()), ("length", pa.int64())]))),
    ("coded", pa.binary())])


def read_ids(files: DataFrame) -> DataFrame:
    """Decode the blocks of files (any of them, in any order): one row per
    piece of a document, (range, doc_no, piece, doc_id, start, ids), ids as
    little-endian unsigned 32-bit integers, start the number of ids in the
    given files before the piece."""
    # A block knows its place in its range; one row per range says where that starts.
    totals = files.groupBy("range").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("at"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= LANES:
                yield from pieces(held[:LANES])
                held = held[LANES:]
        if held:
            yield from pieces(held)

    def pieces(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {k: [] for k in PIECE}
        for r, block in zip(rows, decode_blocks([r["coded"] for r in rows])):
            at, block = 0, block.astype("<u4")
            for d in r["docs"]:
                for k, v in zip(PIECE, (r["range"], d["doc_no"], d["piece"], d["doc_id"],
                                        r["start"] + at,
                                        block[at:at + d["length"]].tobytes())):
                    out[k].append(v)
                at += d["length"]
            if len(out["ids"]) >= 1000:
                yield pa.RecordBatch.from_pydict(out, PIECE_SCHEMA)
                out = {k: [] for k in PIECE}
        if out["ids"]:
            yield pa.RecordBatch.from_pydict(out, PIECE_SCHEMA)

    placed = files.join(F.broadcast(totals), "range")
    return (placed.select("range", "docs", (F.col("at") + F.col("first_id")).alias("start"), "coded")
            .mapInArrow(decode, "range int, doc_no long, piece long, doc_id long, start long, "
                                "ids binary"))


PIECE = ("range", "doc_no", "piece", "doc_id", "start", "ids")
PIECE_SCHEMA = pa.schema([(k, {"range": pa.int32(), "ids": pa.binary()}.get(k, pa.int64()))
                          for k in PIECE])


def combined_crc(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings one after the other, from theirs and the
    second's length: the first advances over as many zero bytes. One zero bit
    is a linear map; the maps of 1, 2, 4, ... bytes are its powers, squared
    once per worker."""
    def times(matrix: list[int], vector: int) -> int:
        out = 0
        for row in matrix:
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    powers = worker_store("crc").setdefault("powers", [])
    while len(powers) < length.bit_length():
        step = powers[-1] if powers else [0xEDB88320] + [1 << k for k in range(31)]
        for _ in range(1 if powers else 3):  # one bit to one byte at first
            step = [times(step, v) for v in step]
        powers.append(step)
    for k in range(length.bit_length()):
        if length >> k & 1:
            first = times(powers[k], first)
    return first ^ second


def crc_of_pieces(pieces: Column) -> Column:
    """crc32 over the pieces (array of (piece, crc, length in bytes))."""
    @F.arrow_udf("long")
    def crc(column: pa.Array) -> pa.Array:
        out = []
        for rows in column.to_pylist():
            total = 0
            for r in sorted(rows, key=lambda r: r["piece"]):
                total = combined_crc(total, r["crc"], r["size"]) if r["piece"] else r["crc"]
            out.append(total)
        return pa.array(out, pa.int64())
    return crc(pieces)
