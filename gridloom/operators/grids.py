"""Grid operators that need more than one relational statement."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gridloom.operators.rasters import crowns
from gridloom.plans.components import connected_components
from gridloom.plans.staging import discard, materialize


def plateau_components(cells: DataFrame, value: str = "z") -> DataFrame:
    """(cx, cy, component): 8-connected cells of equal value.

    Half of the neighbour offsets make the edges, by equi-joins."""
    node = lambda x, y: F.col(x) * 1_000_000 + F.col(y)
    own = cells.select("cx", "cy", F.col(value).alias("v"), node("cx", "cy").alias("a"))
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1))])
    reach = own.select("v", "a", "cx", "cy", F.explode(steps).alias("s")).select("v", "a", (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"))
    edges = reach.join(own.select("cx", "cy", "v", F.col("a").alias("b")), ["cx", "cy", "v"]).select("a", "b")
    comp = connected_components(edges)
    return own.join(comp.withColumnRenamed("node", "a"), "a", "left").select("cx", "cy", F.col("v").alias(value), F.coalesce("component", "a").alias("component"))


def watershed_crowns(cells: DataFrame, block: int = 256) -> DataFrame:
    """(cx, cy, crown) of cells (cx, cy, z, seed); see ``rasters.crowns``."""
    turned = cells.select(F.col("cy").alias("row"), F.col("cx").alias("col"), "z", "seed")
    return crowns(turned, block=block).select(F.col("col").alias("cx"), F.col("row").alias("cy"), "crown")


def greedy_coloring(edges: DataFrame) -> DataFrame:
    """(node, colour): nodes by falling degree, then id, take the smallest colour
    that no neighbour before them has.

    In rounds over priority: a node is coloured once all its neighbours that come
    before it are, so a round is a join and any graph spreads over tasks."""
    both = edges.where("a <> b").select("a", "b").unionByName(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    degree = both.groupBy("a").agg(F.count("*").alias("n"))
    order = lambda t: F.struct((-F.col("n" + t)).alias("k"), F.col(t).alias("i"))
    side = lambda t: degree.select(F.col("a").alias(t), F.col("n").alias("n" + t))
    before = materialize(both.join(side("a"), "a").join(side("b"), "b").where(order("b") < order("a")).select("a", "b"), "colour-links")  # b goes before a
    open_ = materialize(degree.select(F.col("a").alias("node")), "colour-open")
    done = None
    while not open_.isEmpty():
        held = before.join(open_.select(F.col("node").alias("b")), "b", "left_semi").select(F.col("a").alias("node")).distinct()
        ready = open_.join(held, "node", "left_anti")
        if done is None:
            new = ready.withColumn("colour", F.lit(1).cast("long"))
        else:
            taken = before.join(done.select(F.col("node").alias("b"), "colour"), "b").groupBy(F.col("a").alias("node")).agg(F.collect_set("colour").alias("t"))
            free = F.array_min(F.array_except(F.sequence(F.lit(1).cast("long"), F.size("t") + 1), F.col("t")))
            new = ready.join(taken, "node", "left").select("node", F.coalesce(free, F.lit(1)).cast("long").alias("colour"))
        new = materialize(new, "colours")
        done = new if done is None else done.union(new)
        old, open_ = open_, materialize(open_.join(new, "node", "left_anti"), "colour-open")
        discard(old)
    return edges.select(F.col("a").alias("node"), F.lit(1).cast("long").alias("colour")).limit(0) if done is None else done


def _eigen(pdf: pd.DataFrame) -> pd.DataFrame:
    xyz = pdf[["x", "y", "z"]].to_numpy()
    values, vectors = np.linalg.eigh(np.cov(xyz.T, bias=True))
    low, mid, top = np.maximum(values, 0)
    ok = len(xyz) >= 4 and top > 1e-12
    share = lambda v: float(v / top) if ok else None
    return pd.DataFrame({
        "bx": pdf["bx"].iloc[:1], "byy": pdf["byy"].iloc[:1], "n": [len(xyz)], "linearity": [share(top - mid)], "planarity": [share(mid - low)],
        "scattering": [share(low)], "normal_z": [abs(float(vectors[2, 0])) if ok else None], "thickness": [float(np.sqrt(low)) if ok else None],
    })


def eigen_features(points: DataFrame, patch: float = 5.0) -> DataFrame:
    """Shape of the points of each square patch, from their covariance."""
    cell = lambda c: F.floor(F.col(c) / patch).cast("long")
    kind = "bx long, byy long, n long, linearity double, planarity double, scattering double, normal_z double, thickness double"
    return points.select(cell("x").alias("bx"), cell("y").alias("byy"), "x", "y", "z").groupBy("bx", "byy").applyInPandas(_eigen, kind)
