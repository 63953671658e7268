"""Connected components of an edge list, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.plans.staging import materialize

#: Lists of up to so many different edges between whole numbers are settled in
#: one task (some 100 bytes an edge); longer ones in rounds.
TOGETHER = 2_000_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges, and the smallest node that each can reach."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return nodes, nodes[root]
        np.minimum.at(root, high[apart], low[apart])  # roots hang on the smallest root they meet
        while (root[root] != root).any():
            root = root[root]


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if parts:
        nodes, least = smallest_reachable(*(np.concatenate(x) for x in zip(*parts)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(least)], names=["node", "component"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges``.

    Alternates large-star (every larger neighbour of a node links to the node's
    smallest neighbour) and small-star (the same for smaller neighbours) until
    nothing changes, where a list is too long for one task; a logarithmic number of rounds, each one aggregation and
    one join on the edge list.  Each round is written, so an executor that is
    lost costs one round at most.  Whether anything has changed is told from the
    number of edges and the exclusive or of their hashes.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    digest = lambda df: tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
    current = materialize(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    state = digest(current)
    if state[0] <= TOGETHER and {kind for _, kind in current.dtypes} == {"bigint"}:
        return materialize(current.coalesce(1).mapInArrow(_settled, "node long, component long"), "components")
    while True:
        around = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "components")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        following = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "components")
        current, before, state = following, state, digest(following)
        if state == before:
            break
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
