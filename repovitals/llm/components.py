"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

#: Edges that a task holds at a time to shorten them.
HELD = 1 << 20


def _to_least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least node it reaches by these; fewer than there were, or as many."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    one, two = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        # The least label across an edge is taken by both ends' labels, then labels are followed to their ends.
        left, right = least[one], least[two]
        apart = left != right
        if not apart.any():
            break
        np.minimum.at(least, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while ((further := least[least]) != least).any():
            least = further
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars, HELD at a time."""
    held: list[pa.RecordBatch] = []

    def stars() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        a, b = _to_least(table.column("a").to_numpy(), table.column("b").to_numpy())
        return pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=held[0].schema)

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= HELD:
            yield stars()
            held = []
    if held:
        yield stars()


def _least(edges: DataFrame) -> DataFrame:
    """The least of each node's neighbours and itself. Combined in the map tasks, so hubs are cheap."""
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.join(_least(both), "a").where("b > a")
    return met.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    met = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return met.unionByName(own).where("a <> b").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Are these edges stars already: does every node point to one other, which points to none?"""
    ends = edges.select("a", F.lit(1).alias("points"), F.lit(0).alias("met")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("points"), F.lit(1).alias("met"))
    )
    of_node = ends.groupBy("a").agg(F.sum("points").alias("points"), F.max("met").alias("met"))
    return of_node.where("points > 1 or (points = 1 and met = 1)").isEmpty()


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """Rows (node, root) for every node that has an edge; root is the least node of its component.

    edges: columns a and b of one integer type, directions and repeats do not matter; no NULLs.
    Each round is written to `folder`, so the plan does not grow and a lost executor costs one round.
    The rounds needed grow with the logarithm of the number of nodes; in each, a task first makes stars of
    its own edges, which leaves no more of them, and no node with a greater least neighbour.
    """
    several = edges.where("a <> b").select("a", "b")
    now, turn = stored(several.mapInArrow(_shortened, several.schema).distinct(), f"{folder}/round=0"), 0
    while not _is_done(now):
        turn += 1
        shorter = now.mapInArrow(_shortened, now.schema)
        now = stored(_small_star(_large_star(shorter)), f"{folder}/round={turn}")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
