"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Equal vectors are one node. Spherical k-means, fitted on a bounded sample,
assigns every node to a cell. Two linked vectors may lie on both sides of a
border; then at least one of them is within half the linking angle of the
plane between the two centres, so such nodes also visit the cell across the
border as guests, and no link is lost. Within a cell, blocks of nodes are
compared as matrix products; a block pair returns sums and component labels
per node, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import connected_components, landed, slices

#: Nodes of a cell about, while that gives enough cells: a node visits a share
#: of all cells, so with few of them it is copied seldom.
CELL, CELLS, FEW = 4096, 12, 8
#: Residents of a block and their components at most; blocks of guests are twice that.
BLOCK, COMPONENTS = 8192, 1 << 19
#: Rows of a block compared at a time.
STRIP = 512


def comparable(vector: Column) -> Column:
    """True for vectors that can link: no null, no non-finite component, some
    component that isn't zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest part first keeps very
    large and very small components from over- or underflowing."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def fit_cells(nodes: DataFrame, k: int, max_rows: int) -> np.ndarray:
    """Centres of spherical k-means over the ``max_rows`` nodes of smallest
    hash (a stable sample)."""
    sample = nodes.orderBy("node").limit(max_rows).select(
        array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    model = KMeans(k=k, distanceMeasure="cosine", initMode="random", maxIter=8, seed=3).fit(sample)
    return unit(np.array(model.clusterCenters()))


def assigned(nodes: DataFrame, centres: np.ndarray, cosine: float) -> DataFrame:
    """(cell, home, probes, node, weight, vec): each node in its home cell and,
    as a guest, in every cell whose border is near enough."""
    near = math.sin(math.acos(cosine) / 2) + 1e-9

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        for batch in slices(batches, 1024):
            likeness = unit(matrix(batch["vec"])) @ centres.T
            home = likeness.argmax(1)
            own = likeness[np.arange(len(home)), home]
            visits = own[:, None] - likeness <= near * between[home]
            row, cell = np.nonzero(visits)
            probes = np.split(cell, np.cumsum(visits.sum(1))[:-1])
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(home[row]),
                 pa.array([probes[r].astype(np.int32) if c == home[r] else None
                           for r, c in zip(row, cell)], pa.list_(pa.int32())),
                 batch["node"].take(at), batch["weight"].take(at), batch["vec"].take(at)],
                names=["cell", "home", "probes", "node", "weight", "vec"])

    element = dict(nodes.dtypes)["vec"]
    return nodes.select("node", "weight", "vec").mapInArrow(
        assign, f"cell long, home long, probes array<int>, node long, weight long, vec {element}")


def near_strips(x: np.ndarray, y: np.ndarray, cosine: float
                ) -> Iterator[tuple[slice, np.ndarray]]:
    """Strips of rows of x that reach the cosine with some row of y, and which
    rows do; rows of both are unit vectors. Single precision rules out what is
    clearly below; the rest is taken in double."""
    # A product of d terms is off by no more than about d roundings.
    slack = 1e-6 * (4 + x.shape[1] / 8)
    thin = y.astype(np.float32).T
    for at in range(0, len(x) if len(y) else 0, STRIP):
        part = x[at:at + STRIP]
        maybe = part.astype(np.float32) @ thin >= cosine - slack
        rows, columns = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
        if len(rows):
            links = np.zeros(maybe.shape, bool)
            links[np.ix_(rows, columns)] = part[rows] @ y[columns].T >= cosine
            if links.any():
                yield slice(at, at + len(part)), links


def compare_blocks(group: pd.DataFrame, cosine: float, cells: int) -> pd.DataFrame:
    """A block of residents of one cell against another block of residents or
    of guests: (node, links, root) per linked node, links the weight of its
    partners here, root the smallest node connected to it here. A pair that
    two cells find counts in the lower one."""
    i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
    cell = int(group["cell"].iloc[0])
    group = group.sort_values("node")
    x, y = group[group["block"] == i], group[group["block"] == j]
    a, b = x["node"].to_numpy(), y["node"].to_numpy()
    if not len(a) or not len(b):
        return pd.DataFrame({"node": [], "links": [], "root": []})
    strips = list(near_strips(*(unit(np.stack(side["vec"]).astype(np.float64))
                                for side in (x, y)), cosine))
    for s, links in strips:
        if j < 0:  # the guest's home is a lower cell that the resident visits, too
            visits = np.zeros((len(links), cells), bool)
            for k, probes in enumerate(x["probes"].iloc[s]):
                visits[k, probes] = True
            home = y["home"].to_numpy()
            links &= ~(visits[:, home] & (home < cell)[None, :])
        elif i == j:
            links[np.arange(len(links)), np.arange(s.start, s.stop)] = False
    strips = [(s, links) for s, links in strips if links.any()]
    root_a, root_b = a.copy(), b.copy()
    most = np.iinfo(np.int64).max
    moved = bool(strips)
    while moved:  # smallest label through links, to and fro, until nothing moves
        down, up = root_b.copy(), root_a.copy()
        for s, links in strips:
            np.minimum(down, np.where(links, root_a[s, None], most).min(0), out=down)
        for s, links in strips:
            up[s] = np.minimum(up[s], np.where(links, down[None, :], most).min(1))
        if i == j:
            down = up = np.minimum(up, down)
        moved = (down != root_b).any() or (up != root_a).any()
        root_a, root_b = up, down
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    for s, links in strips:
        links_a[s] = links @ y["weight"].to_numpy()
        links_b += links.T @ x["weight"].to_numpy()[s]
    out = [pd.DataFrame({"node": a, "links": links_a, "root": root_a})]
    if i != j:
        out.append(pd.DataFrame({"node": b, "links": links_b, "root": root_b}))
    out = pd.concat(out)
    return out[out["links"] > 0]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = 0.95, max_fit_rows: int = 20_000) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept).

    Vectors link when their cosine, in double precision, is at least
    ``cosine``; component_id is the smallest id reachable through links and
    kept marks it. Null, zero and empty vectors and those with a null or
    non-finite component link with nothing and are kept; so do vectors of
    different lengths. Repeated rows are vectors of their own that link with
    one another. A null id takes part, but gives no component_id where another
    id is there. Other columns are not read. An empty table gives no rows. The
    k-means is fitted on ``max_fit_rows`` vectors at most; all are assigned.
    """
    vectors = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).alias("vec"))
    vectors = vectors.withColumn(
        "node", F.when(comparable(F.col("vec")), F.xxhash64(F.size("vec"), "vec")))
    nodes = landed(vectors.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"),
        F.first("vec").alias("vec")), "embedding-nodes")
    widths = {r["size"]: r["n"] for r in nodes.groupBy(F.size("vec").alias("size"))
              .agg(F.count("*").alias("n")).where(F.col("n") >= 2 * FEW).collect()}
    size = F.size("vec").cast("long")
    # Widths of a handful of nodes are one cell each, all in one job.
    few = nodes.where(~size.isin(list(widths))).select(
        size.alias("cell"), size.alias("home"), F.lit(None).cast("array<int>").alias("probes"),
        "node", "weight", "vec")
    found = None if few.isEmpty() else cell_links(landed(few, "embedding-cells"), cosine, 1, BLOCK)
    for width, n in sorted(widths.items()):
        k = min(max(CELLS, -(-n // CELL)), n // FEW, max_fit_rows // 16)
        part = nodes.where(F.size("vec") == width)
        centres = fit_cells(part, k, max_fit_rows)
        links = cell_links(landed(assigned(part, centres, cosine), "embedding-cells"), cosine,
                           len(centres), min(BLOCK, max(512, COMPONENTS // width)))
        found = links if found is None else found.union(links)
    joined = vectors.select("vec_id", "node")
    if found is None:
        facts = nodes.select("node", "weight", F.lit(0).alias("links"),
                             F.col("rep").alias("component"))
    else:
        found = landed(found, "embedding-links")
        sums = found.groupBy("node").agg(F.sum("links").alias("links"))
        roots = connected_components(found.select(F.col("node").alias("a"),
                                                  F.col("root").alias("b")), "embedding-components")
        labelled = (nodes.select("node", "rep", "weight").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")))
        least = labelled.groupBy("root").agg(F.min("rep").alias("component"))
        facts = (labelled.join(least, "root").join(sums, "node", "left")
                 .select("node", "weight", F.coalesce("links", F.lit(0)).alias("links"),
                         "component"))
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.join(facts, "node", "left").select(
        "vec_id", F.coalesce(F.col("weight") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def cell_links(placed: DataFrame, cosine: float, cells: int, block: int) -> DataFrame:
    """(node, links, root) of all linked nodes of a table of cells (see
    :func:`assigned`), several rows a node."""
    # Residents are dealt over blocks 0, 1, ..., guests over blocks -1, -2, ...
    # Guests meet residents only, so most rows go to a single group.
    at_home = F.col("cell") == F.col("home")
    blocks = placed.groupBy("cell").agg(
        F.ceil(F.count_if(at_home) / block).alias("residents"),
        F.ceil(F.count_if(~at_home) / (2 * block)).alias("guests")).where("residents > 0")
    residents = F.sequence(F.lit(0).cast("long"), F.col("residents") - 1)
    guests = F.when(F.col("guests") > 0, F.sequence(F.lit(-1).cast("long"), -F.col("guests"),
                                                    F.lit(-1).cast("long"))) \
        .otherwise(F.array().cast("array<bigint>"))
    dealt = (placed.join(blocks, "cell")
             .withColumn("block", F.when(at_home, F.pmod(F.xxhash64("node"), "residents"))
                         .otherwise(-1 - F.pmod(F.xxhash64("node"), "guests")))
             .withColumn("other", F.explode(F.when(at_home, F.concat(residents, guests))
                                            .otherwise(residents)))
             .withColumn("i", F.greatest("block", "other"))
             .withColumn("j", F.least("block", "other"))
             .withColumn("pair", F.xxhash64("cell", "i", "j")))
    return dealt.groupBy("pair").applyInPandas(
        lambda group: compare_blocks(group, cosine, cells), "node long, links long, root long")
