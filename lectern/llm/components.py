"""Connected components of an edge table: alternating large-star and small-star rounds.

Every node ends up with one edge to the smallest node of its component. Rounds are tables in the
shared folder, so lineage stays short and the joins can split a node with very many edges. A table of no
more than ``FEW`` edges needs no rounds: one task unites them, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import WRITTEN, remove_stored, stored, tidy


def _is_star(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, or only larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "small")
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


#: Edges that one task unites, and rows of a table that is broadcast: a few MB at most.
FEW = 250_000


def hinted(df: DataFrame) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if it has few."""
    return F.broadcast(df) if df.count() <= FEW else df


def unite(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all ends of the edges."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)  # a component's root takes the least root that it meets
        np.minimum.at(new, label[b], least)
        while (new != (short := new[new])).any():
            new = short
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _united(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if held:
            node, component = unite(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(component)], names=["node", "component"])

    return edges.select("u", "v").coalesce(1).mapInArrow(tidy(run), "node long, component long")


def components(edges: DataFrame) -> DataFrame:
    """From (u, v) to (node, component), for the nodes that have an edge to another node."""
    mark = len(WRITTEN)
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v"), "edges")
    if now.count() <= FEW:
        return _united(now)
    now = stored(now.distinct(), "edges")
    while not _is_star(now):
        now = stored(_small_star(stored(_large_star(now), "stars")), "edges")
        remove_stored(edges.sparkSession, mark, but=WRITTEN[-1])
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
