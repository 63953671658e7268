"""Registry of the operators that are more than one SQL statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.operators import grids, matching, surfaces
from gridloom.plans.dialect import DuckDB, Spark
from gridloom.plans.relations import with_relations
from gridloom.streaming import windows


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared relations as a DataFrame."""
    from gridloom.plans import catalog

    return catalog.run_sql(spark, sf_dir, with_relations(f"SELECT * FROM {name}", [name], Spark()))


def plateau_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = relation(spark, sf_dir, "cells").select("cx", "cy", F.floor(F.col("z") / 2).cast("long").alias("z"))
    return grids.plateau_components(cells)


PLATEAUS = """WITH c AS (SELECT cx, cy, cast(floor(z / 2) AS BIGINT) AS z, cx * 1000000 + cy AS a FROM cells),
e AS (SELECT p.a, q.a AS b FROM c p JOIN c q ON abs(p.cx - q.cx) <= 1 AND abs(p.cy - q.cy) <= 1 AND p.z = q.z),
r AS (SELECT a, a AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT c.cx, c.cy, c.z, min(r.b) AS component FROM c JOIN r ON c.a = r.a GROUP BY c.cx, c.cy, c.z"""


def match_one_to_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    tops = relation(spark, sf_dir, "tops")
    side = lambda kind: tops.where(F.col("event_type") == kind).select("id", "x", "y")
    return matching.match_one_to_one(side("signup"), side("view"), 6.0)


def knn_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surfaces.nearest_members(relation(spark, sf_dir, "tops").select("id", "x", "y"), 5, 20.0)


def watershed_crowns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = relation(spark, sf_dir, "cells")
    top = cells.groupBy(F.floor(F.col("cx") / 5).alias("bx"), F.floor(F.col("cy") / 5).alias("byy")).agg(F.max(F.struct("z", "cx", "cy")).alias("m"))
    seeds = top.select(F.col("m.cx").alias("cx"), F.col("m.cy").alias("cy"), (F.col("m.cx") * 1000 + F.col("m.cy") + 1).alias("seed"))
    return grids.watershed_crowns(cells.join(seeds, ["cx", "cy"], "left").select("cx", "cy", "z", F.coalesce("seed", F.lit(0)).alias("seed")))


def greedy_coloring(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("a"), F.col("n_regionkey").alias("r"))
    m = n.select(F.col("a").alias("b"), "r")
    return grids.greedy_coloring(n.join(m, "r").where("a < b").select("a", "b"))


def eigen_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids.eigen_features(relation(spark, sf_dir, "pts"))


def queries() -> dict:
    return {
        "plateau_components": plateau_components,
        "match_one_to_one": match_one_to_one,
        "knn_neighbors": knn_neighbors,  # its SQL is the statement of that name
        "watershed_crowns": watershed_crowns,
        "greedy_coloring": greedy_coloring,
        "eigen_features": eigen_features,
        "stream_hourly_counts": windows.stream_hourly_counts,
        "stream_dedup": windows.stream_dedup,
    }


def oracle_sql() -> dict[str, str]:
    d = DuckDB()
    return {
        "plateau_components": with_relations(PLATEAUS, ["cells"], d).replace("WITH pts", "WITH RECURSIVE pts", 1),
        "stream_hourly_counts": f"SELECT cast(floor({d.seconds('ts')} / 3600e0) AS BIGINT) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2",
        "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    }
