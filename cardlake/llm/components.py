"""Connected components of a graph given as edges, by contraction and repeated star operations.

Every task first replaces its share of the edges by one edge per node, to the smallest node
that the share links it to. Edges that fill one partition are settled by that. Those of more
partitions go on in rounds: every node points its larger neighbours, then its smaller ones, to
the smallest node it knows. The number of rounds grows with the logarithm of the longest path,
every step is an aggregation or an equi-join, and a node with very many edges is one row on
the aggregated side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.shipping import ship_package
from cardlake.session import stage


def smallest_linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that these edges link each to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    left, right = ends[:len(a)], ends[len(a):]
    while len(left):
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        apart = low < high
        left, right = left[apart], right[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _contracted(edges: DataFrame) -> DataFrame:
    """One row per node and task: the node and the smallest one linked by the task's edges."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(column.to_numpy(zero_copy_only=False) for column in batch.columns) for batch in batches]
        if held:
            found = smallest_linked(*(np.concatenate(side) for side in zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    return edges.mapInArrow(contract, "a long, b long")


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, or larger ones only."""
    none = F.lit(None).cast("long")
    ends = edges.where("a <> b").select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("smaller")),
        F.struct(F.col("b").alias("node"), none.alias("smaller")))).alias("e")).select("e.*")
    # A node that is the smaller end of an edge has a row without a smaller neighbour.
    return ends.groupBy("node").agg(
        F.min("smaller").alias("low"), F.max("smaller").alias("high"), F.count("smaller").alias("up"), F.count("*").alias("n"),
    ).where("low < high OR (up > 0 AND up < n)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Maps every node of ``edges`` (``a``, ``b``: long) to the smallest node it can reach.

    Returns ``node`` and ``component``. Loops, repeated edges and either direction are
    allowed; edges with a null end are ignored. An empty input gives no rows.
    """
    ship_package(edges.sparkSession)
    ordered = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull()).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    first = current = stage(_contracted(ordered), "edges")
    while not _settled(current):
        # Every larger neighbour of a node learns the node's smallest neighbour.
        both = current.where("a <> b")
        both = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("m_node")).agg(F.min("b").alias("m"))
        large = both.join(least, F.col("a") == F.col("m_node")).where("b > a").select(
            F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        # Every smaller neighbour, and the node itself, learns the smallest of them.
        lowest = large.groupBy(F.col("a").alias("m_node")).agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, F.col("a") == F.col("m_node"))
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                      F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a <> b").distinct()
        )
        current = stage(small, "edges")
    # Every node stands in the first rows, also one that lost its edges or had none but loops.
    known = first.select("a", F.col("a").alias("b")).union(current)
    return known.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
