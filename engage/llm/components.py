"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import written

LINKS = "u long, v long"
TASK = 1_000_000  # links that a task holds at once (16 MB)


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links and the smallest node of each one's component: labels fall along links and through labels."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A star for each component of the links of a partition, ``TASK`` links at a time: no more links than nodes."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(2))
        nodes, root = roots(u, v)
        own = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(root[own])], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= TASK:
            yield stars(held)
            held = []
    if sum(b.num_rows for b in held):
        yield stars(held)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links(u, v)``; ``component`` is the smallest node reachable.

    Links in any direction, repeated ones and loops are allowed, rows with a null are ignored; a node that has only loops does
    not appear. Links are first contracted to stars where they lie. Stars that fit into one task are contracted there once more,
    which settles them. Else the star rules are applied in turn until nothing changes: the neighbours above a node are hung on its smallest neighbour, then those below it. All rounds
    are joins and aggregations, each written to the shared folder; a node with very many links is combined before the shuffle
    and its join can be split.
    """
    stars = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    stars = stars.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").mapInArrow(_contract, LINKS)
    edges, last = written(stars, "stars"), None
    if edges.count() <= TASK:
        return _listed(written(edges.coalesce(1).mapInArrow(_contract, LINKS), "stars"))
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Large stars point downwards only: u > v.
        large = large.distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(below.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"links not settled after {most_rounds} rounds")
    return _listed(edges)


def _listed(stars: DataFrame) -> DataFrame:
    """Each leaf of a star with its centre, and each centre with itself."""
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())
