"""Near-duplicate vectors by a forest of random-projection trees with overlapping splits.

Each tree cuts the vectors by one random direction a level; the cut of each node is learned on a bounded sample. A
vector that is close to a cut goes to both sides, so a pair is parted only if it lies far on either side. Vectors are
compared within leaves alone, in double precision; a pair that meets in several leaves is counted in the first. Equal
vectors are one class throughout, and a leaf that is larger than a block is compared block by block in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm.common import written
from engage.llm.components import components, roots

TREES = 6
SAMPLE = 50_000  # vectors on which the cuts are learned, at most
LEAF = 1000  # vectors of a leaf, about
LEAST_SAMPLE = 16  # a node with fewer sampled vectors is not cut
BLOCK = 4096  # vectors of a leaf that are compared in one task
OVERLAP = 0.5  # half width of the overlap, in expected projections of a pair at the threshold
SEED = 7
_LEAF_BITS = 40


class Forest:
    """Directions and cuts. ``cuts[t]`` is indexed by node (children of k: 2 k and 2 k + 1); NaN is a leaf."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        n, d = sample.shape
        random = np.random.default_rng(seed)
        most = int(np.log2(max(1, n / LEAST_SAMPLE))) if n else 0
        self.depth = min(most, int(np.ceil(np.log2(max(1, rows / leaf)))))
        self.margin = OVERLAP * float(np.sqrt(2 - 2 * threshold)) / np.sqrt(max(1, d))
        self.directions = random.standard_normal((trees, d, max(1, self.depth)))
        self.directions /= np.linalg.norm(self.directions, axis=1, keepdims=True)
        self.cuts = np.full((trees, 2 << self.depth), np.nan)
        for t in range(trees):
            self._grow(t, sample @ self.directions[t])

    def _grow(self, t: int, projected: np.ndarray) -> None:
        nodes = {1: np.arange(len(projected))}
        for level in range(self.depth):
            below: dict[int, np.ndarray] = {}
            for node, rows in nodes.items():
                if len(rows) < LEAST_SAMPLE:
                    continue
                p = np.sort(projected[rows, level])
                tried = np.quantile(p, np.linspace(0.3, 0.7, 21))
                near = np.searchsorted(p, tried + self.margin) - np.searchsorted(p, tried - self.margin)
                # The emptiest place; a node that is dense everywhere stays a leaf.
                best = int(np.argmin(near + 1e-3 * np.abs(np.arange(21) - 10)))
                if near[best] > 0.5 * len(rows):
                    continue
                self.cuts[t, node] = tried[best]
                left = projected[rows, level] < tried[best]
                below[2 * node], below[2 * node + 1] = rows[left], rows[~left]
            nodes = below

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every place of the given unit vectors, in order of rows."""
        found_rows, found_leaves = [], []
        for t in range(len(self.cuts)):
            projected = x @ self.directions[t]
            rows, nodes = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
            for level in range(self.depth + 1):
                cut = self.cuts[t, nodes]
                leaf = np.isnan(cut)
                found_rows.append(rows[leaf])
                found_leaves.append((t << _LEAF_BITS) + nodes[leaf])
                rows, nodes, cut = rows[~leaf], nodes[~leaf], cut[~leaf]
                if not len(rows):
                    break
                p = projected[rows, level]
                left, right = p < cut + self.margin, p >= cut - self.margin
                rows = np.concatenate([rows[left], rows[right]])
                nodes = np.concatenate([2 * nodes[left], 2 * nodes[right] + 1])
        rows, leaves = np.concatenate(found_rows), np.concatenate(found_leaves)
        order = np.lexsort((leaves, rows))
        return rows[order], leaves[order]


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large and very small components neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links_of_block(threshold: float):
    """Compare the vectors of one pair of blocks of one leaf."""

    def compare(table: pa.Table) -> pa.Table:
        leaf, one, two = (table.column(c)[0].as_py() for c in ("leaf", "one", "two"))
        rep, size = table.column("rep").to_numpy(), table.column("size").to_numpy()
        block = table.column("block").to_numpy()
        x = _unit(_matrix(table.column("vector")))
        places = table.column("leaves").combine_chunks()
        width = np.diff(places.offsets.to_numpy())
        held = np.full((len(rep), int(width.max())), -1, dtype=np.int64)
        held[np.arange(held.shape[1]) < width[:, None]] = places.flatten().to_numpy()
        a = np.flatnonzero(block == one)
        b = a if one == two else np.flatnonzero(block == two)
        pairs_a, pairs_b = [], []
        for start in range(0, len(a), 512):
            i, j = np.nonzero(x[a[start : start + 512]] @ x[b].T >= threshold)
            i, j = a[start + i], b[j]
            if one == two:
                i, j = i[i < j], j[i < j]
            for s in range(0, len(i), 20_000):
                p, q = held[i[s : s + 20_000]], held[j[s : s + 20_000]]
                common = ((p[:, :, None] == q[:, None, :]) & (p[:, :, None] >= 0)).any(axis=2)
                first = np.where(common, p, np.iinfo(np.int64).max).min(axis=1) == leaf
                pairs_a.append(i[s : s + 20_000][first])
                pairs_b.append(j[s : s + 20_000][first])
        i = np.concatenate(pairs_a) if pairs_a else np.zeros(0, dtype=np.int64)
        j = np.concatenate(pairs_b) if pairs_b else np.zeros(0, dtype=np.int64)
        links = np.zeros(len(rep), dtype=np.int64)
        np.add.at(links, i, size[j])
        np.add.at(links, j, size[i])
        linked = np.flatnonzero(links)
        root = np.zeros(len(rep), dtype=np.int64)
        if len(i):
            nodes, lowest = roots(rep[i], rep[j])
            root[linked] = lowest[np.searchsorted(nodes, rep[linked])]
        return pa.table({"rep": rep[linked], "links": links[linked], "root": root[linked]})

    return compare


def usable(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda c: c != 0), F.lit(False))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.95,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors(vec_id, embedding)``.

    ``n_links`` counts the other rows found with a cosine (double precision) of at least the threshold, ``component_id`` is the
    smallest ``vec_id`` reachable by such links, ``kept`` tells whether that is the row itself. No pair below the threshold
    is linked; a pair at or above it is missed only if every tree parts it.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing. Vectors of different lengths
    are never compared. Repeated vectors are linked with each other and share their links; a row with a null id counts as a
    vector but names no component. An empty table gives no rows; other columns are ignored.
    """
    v = F.col("embedding")
    one, two = F.xxhash64(v), F.xxhash64(v, F.lit(1))
    named = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(v), one).alias("h1"), F.when(usable(v), two).alias("h2")
    )
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(usable(v))
    classes = held.groupBy(one.alias("h1"), two.alias("h2")).agg(
        F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("embedding").cast("array<double>").alias("vector")
    )
    # Vectors are told apart by themselves, not by their ids, which may be null or repeated and only name components.
    classes = written(classes.withColumn("rep", F.col("h1")), "vectors")
    found = []
    for length, rows in sorted(tuple(r) for r in classes.groupBy(F.size("vector")).count().collect()):
        own = classes.where(F.size("vector") == length)
        span = 1 << 30
        picked = own.where(F.pmod(F.xxhash64("h1"), F.lit(span)) < int(span * min(1.0, sample / rows)))
        forest = Forest(_unit(_matrix(picked.select("vector").toArrow().column(0))) if rows else np.zeros((0, length)), rows, threshold, trees, leaf)
        found.append(_links(own, forest, threshold, block))
    if not found:
        return named.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = written(links, "links")
    total = links.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(links.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    joined = (
        classes.select("h1", "h2", "rep", "least", "size")
        .join(reached.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("root", F.coalesce("component", "rep"))
    )
    names = joined.where("component IS NOT NULL").groupBy("root").agg(F.min("least").alias("name"))
    told = (
        joined.join(total, "rep", "left")
        .join(names, "root", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("name", "least").alias("component"),
        )
    )
    result = named.join(told, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(classes: DataFrame, forest: Forest, threshold: float, block: int) -> DataFrame:
    """``rep, links, root``: links counted and components met in each pair of blocks of each leaf."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, leaves = forest.leaves(_unit(_matrix(batch.column(2))))
            offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(leaves))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), lists], names=["rep", "size", "vector", "leaves"]
            )

    placed = written(
        classes.select("rep", "size", "vector").mapInArrow(place, "rep long, size long, vector array<double>, leaves array<long>"),
        "leaves",
    )
    entries = placed.select("*", F.explode("leaves").alias("leaf"))
    blocks = (
        placed.select(F.explode("leaves").alias("leaf"))
        .groupBy("leaf")
        .agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    pairs = (
        entries.join(blocks, "leaf")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "rep", "size", "vector", "leaves", "leaf", "block",
            F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        )
    )
    return pairs.groupBy("leaf", "one", "two").applyInArrow(_links_of_block(threshold), "rep long, links long, root long")
