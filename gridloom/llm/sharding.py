"""Sharding by Karmarkar-Karp differencing.

Equal texts form an indivisible group.  Differencing keeps a heap of partial
partitions into k shards; the two with the largest spread are combined, the
heaviest shard of one onto the lightest of the other, until one is left.

Groups are dealt by hash to blocks of bounded size and each block is
differenced on its own.  What a block leaves behind is one partial partition of
k sums, and those are differenced again, level by level, always in bounded
blocks.  Each level returns, for every partial partition, which final shard its
j-th part goes to, so assignments travel back down by joins on block numbers.
A group that outweighs a shard stays whole, as groups are indivisible: its
block's spread is then the largest, and it is combined first at every level.

Edge cases: a null text is a text of no bytes and groups with other nulls and
empty texts; repeated rows are two rows; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.plans.staging import materialize

#: Groups (or partial partitions) that one task differences, at up to 40 shards.
BLOCK = 20_000
#: Rows that are numbered together; numbering within a shard goes by chunks.
CHUNK = 10_000


def difference(parts: np.ndarray) -> np.ndarray:
    """Combines n partial partitions (n x k sums) into one.  Returns an n x k
    array: the shard, 0 to k - 1, that each part of each partition goes to;
    shards are numbered by ascending final sums."""
    n, k = parts.shape
    if n == 0:
        return np.empty((0, k), np.int64)
    order = np.argsort(parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, axis=1))
    heap = [(int(s[0] - s[-1]), i) for i, s in enumerate(sums)]
    heapq.heapify(heap)
    left, right, perm = [], [], []  # of combined nodes, numbered from n on
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = sums[a] + sums[b][::-1]
        by = np.argsort(joined, kind="stable")
        sums[a] = sums[b] = None
        joined = joined[by]
        left.append(a)
        right.append(b)
        perm.append(by)
        sums.append(joined)
        heapq.heappush(heap, (int(joined[0] - joined[-1]), len(sums) - 1))
    # from the last node down: where each sorted place of a node ends up
    where: list = [None] * len(sums)
    where[-1] = np.arange(k)
    for node in range(len(sums) - 1, n - 1, -1):
        to = np.empty(k, np.int64)
        to[perm[node - n]] = where[node]  # place before sorting -> final shard
        where[left[node - n]], where[right[node - n]] = to, to[::-1]
        where[node] = None
    out = np.empty((n, k), np.int64)
    np.put_along_axis(out, order, np.stack(where[:n]), axis=1)
    return out


def _leaf(shards: int):
    """One block of groups: group -> part, and the block's sums per part."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "k1", "k2"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        size = pdf["bytes"].to_numpy(np.int64)
        parts = np.zeros((len(size), shards), np.int64)
        parts[:, -1] = size
        part = difference(parts)[:, -1]
        sums = np.bincount(part, weights=size, minlength=shards).astype(np.int64)
        out = pdf[["block", "k1", "k2"]].assign(part=part, sums=None)
        head = pd.DataFrame({"block": [pdf["block"].iloc[0]], "k1": [None], "k2": [None], "part": [None], "sums": [sums]})
        return pd.concat([out.astype(object), head.astype(object)], ignore_index=True)

    return run


def _inner(shards: int):
    """One block of partial partitions: their parts' places, and its sums."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node").reset_index(drop=True)
        parts = np.stack(pdf["sums"].to_numpy()).astype(np.int64)
        to = difference(parts)
        sums = np.zeros(shards, np.int64)
        np.add.at(sums, to, parts)
        up = int(pdf["up"].iloc[0])
        out = pd.DataFrame({"up": up, "node": pdf["node"], "places": list(to), "sums": None})
        return pd.concat([out.astype(object), pd.DataFrame({"up": [up], "node": [None], "places": [None], "sums": [sums]}).astype(object)], ignore_index=True)

    return run


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(k1, k2, shard) for groups (k1, k2, bytes)."""
    n = groups.count()
    blocks = max(1, -(-n * max(shards, 40) // (40 * BLOCK)))  # fewer groups to a block of many shards
    dealt = groups.withColumn("block", F.pmod(F.xxhash64("k1", "k2"), F.lit(blocks)))
    leaves = materialize(
        dealt.groupBy("block").applyInPandas(_leaf(shards), "block long, k1 long, k2 long, part long, sums array<long>"), "shard-leaves"
    )
    part = leaves.where(F.col("part").isNotNull()).select("k1", "k2", F.col("block").alias("node"), "part")
    nodes = leaves.where(F.col("part").isNull()).select(F.col("block").alias("node"), "sums")
    fan = max(2, BLOCK // shards)
    while True:
        ups = max(1, -(-blocks // fan))
        level = materialize(
            nodes.withColumn("up", F.col("node") % ups).groupBy("up").applyInPandas(_inner(shards), "up long, node long, places array<long>, sums array<long>"),
            "shard-level",
        )
        places = level.where(F.col("places").isNotNull()).select("node", "up", "places")
        part = part.join(places, "node").select("k1", "k2", F.col("up").alias("node"), F.element_at("places", (F.col("part") + 1).cast("int")).alias("part"))
        if ups == 1:
            return part.select("k1", "k2", F.col("part").cast("int").alias("shard"))
        nodes = level.where(F.col("places").isNull()).select(F.col("up").alias("node"), "sums")
        blocks = ups


def number_rows(rows: DataFrame, key: str, order: list[str], count: int) -> DataFrame:
    """Adds ``slot``: a gapless number from 0 within each ``key``, whatever the
    key's share of the rows; each task sorts a chunk of CHUNK different rows on
    average.  Rows alike in all columns are counted first and take a range."""
    chunks = max(1, -(-count // CHUNK))
    counted = rows.groupBy(key, *order).agg(F.count("*").alias("_n"))
    dealt = counted.withColumn("_chunk", F.pmod(F.xxhash64(*order, F.lit("chunk")), F.lit(chunks)))
    sizes = dealt.groupBy(key, "_chunk").agg(F.sum("_n").alias("_all"))
    upto = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(key, "_chunk", F.coalesce(F.sum("_all").over(upto), F.lit(0)).alias("_start"))
    inside = W.partitionBy(key, "_chunk").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    placed = dealt.withColumn("_at", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, [key, "_chunk"])
    part = F.lit(4_096).cast("long")
    spread = placed.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / part))))
    spread = spread.withColumn("_q", F.explode(F.sequence(F.lit(0).cast("long"), F.least(part, F.col("_n") - F.col("_p") * part) - 1)))
    slot = F.col("_start") + F.col("_at") + F.col("_p") * part + F.col("_q")
    return spread.withColumn("slot", slot.cast("long")).drop("_chunk", "_at", "_start", "_n", "_p", "_q")


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("second"), t).alias("k2"),
    )
    slim = materialize(slim, "shard-docs")
    groups = materialize(slim.groupBy("k1", "k2").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = slim.join(assign_groups(groups, shards), ["k1", "k2"])
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "shard"), "shard-placed")
    return number_rows(placed, "shard", ["doc_id", "text_crc32", "size"], placed.count()).select("doc_id", "size", "text_crc32", "shard", "slot")


def query(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
