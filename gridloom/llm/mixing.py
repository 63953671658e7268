"""Mixing sources to target weights (DataFrame functions only).

Targets by capped water-filling: every source gets its weight's share of the
budget, is clamped at a maximum of epochs over its own size, and what is left
over is shared again among the others by weight, until no target is above its
cap.  Sources sorted by cap over weight are clamped in that order, so the fixed
point falls out of running sums over the sources, with no loop.

A source at rate q = target / size is taken floor(q) times whole; of the rest,
documents are taken once more in the order of a seeded hash until the running
size is nearest the target.  That threshold is found from sums in two levels of
4096 hash bins, so no task ever orders the documents of a source.

Edge cases: null text has size 0; a null source is a source, after all others;
rows that are equal in id and size are taken alike; an empty table or a source
of size 0 takes nothing.  Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.llm.text import word_count
from gridloom.plans.staging import materialize

BINS = 4096
#: Up to this many sources, the plan (some 60 bytes each) is broadcast.
BROADCAST_SOURCES = 10_000


def draw(seed: int, doc_id: str, size: str) -> Column:
    """A document's place in the order of its source, 0 to 2^24 - 1."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.col(size).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 6), 16, 10).cast("long")


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to rows of (source, weight, source_size).

    ``budget`` is the part of all sizes that the mix takes."""
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    total = F.sum("source_size").over(W.partitionBy())
    order = W.partitionBy().orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    x = sources.withColumns({"_cap": cap, "_ratio": cap / F.col("weight"), "_budget": F.lit(float(budget)) * total})
    x = x.withColumn(
        "_clamped",
        (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) * F.col("weight")
        >= F.col("_cap") * F.sum("weight").over(after),
    )
    everyone = W.partitionBy()
    left = F.first("_budget").over(everyone) - F.sum(F.when(F.col("_clamped"), F.col("_cap")).otherwise(0.0)).over(everyone)
    free = F.sum(F.when(F.col("_clamped"), 0.0).otherwise(F.col("weight"))).over(everyone)
    target = F.when(F.col("_clamped"), F.col("_cap")).otherwise(F.least("_cap", F.col("weight") * left / free))
    return x.withColumn("target", target).drop("_cap", "_ratio", "_budget", "_clamped")


def default_weights(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0)) -> DataFrame:
    """Sources by code point, nulls last, take ``weights`` in turn."""
    place = F.row_number().over(W.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``whole`` (full repetitions) and ``cut``: documents drawn below it
    are taken once more."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("whole", F.floor(rate).cast("long")).withColumn(
        "_want", F.col("target") - F.col("whole") * F.col("source_size")
    )
    plan = materialize(plan, "mix-plan")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    running = W.partitionBy("source").orderBy("_bin")

    def level(bins: DataFrame, p: DataFrame, base: Column) -> DataFrame:
        """The bin of each source in which the running size passes the want."""
        sums = bins.withColumn("_upto", F.sum("_size").over(running)).withColumnRenamed("source", "_source")
        j = p.join(sums, F.col("source").eqNullSafe(F.col("_source")) & (base + F.col("_upto") > F.col("_want"))).drop("_source")
        return j.groupBy("source").agg(F.min(F.struct("_bin", (base + F.col("_upto")).alias("upto"), "_size")).alias("_at"))

    coarse = sized.groupBy("source", F.floor(F.col("_u") / BINS).alias("_bin")).agg(F.sum("size").alias("_size"))
    top = level(coarse, plan.select("source", "_want"), F.lit(0))
    top = materialize(
        top.select(F.col("source"), F.col("_at._bin").alias("_hi"), (F.col("_at.upto") - F.col("_at._size")).alias("_base")), "mix-coarse"
    )
    hi = F.broadcast(top) if top.count() <= BROADCAST_SOURCES else top
    inside = sized.join(hi.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")) & (F.floor(F.col("_u") / BINS) == F.col("_hi")))
    fine = inside.groupBy("source", (F.col("_u") % BINS).alias("_bin")).agg(F.sum("size").alias("_size"))
    p2 = plan.select(F.col("source").alias("_s2"), "_want").join(top, F.col("_s2").eqNullSafe(F.col("source"))).drop("_s2")
    low = level(fine, p2, F.col("_base"))
    # the bin that passes the want is taken where that ends nearer to it
    low = p2.withColumnRenamed("source", "_s3").join(low, F.col("_s3").eqNullSafe(F.col("source"))).select(
        F.col("source").alias("_s4"),
        (F.col("_hi") * BINS + F.col("_at._bin") + F.when(2 * F.col("_want") >= 2 * F.col("_at.upto") - F.col("_at._size"), 1).otherwise(0)).alias("cut"),
    )
    out = plan.join(low, F.col("source").eqNullSafe(F.col("_s4")), "left")
    # no bin passes the want: all of the source; nothing wanted: none of it
    cut = F.when(F.col("_want") > 0, F.coalesce("cut", F.lit(BINS * BINS))).otherwise(F.lit(0))
    return out.select("source", "weight", "source_size", "target", "whole", cut.cast("long").alias("cut"))


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    budget: float = 1.5, max_epochs: float = 2.0, weights: tuple[float, ...] = (5.0, 2.0, 1.0), seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """The documents with their sizes (no text) and the plan per source."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    sized = materialize(sized.withColumn("_u", draw(seed, "doc_id", "size")), "mix-sized")
    sources = default_weights(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    return sized, materialize(thresholds(sized, water_fill(sources, budget, max_epochs)), "mix-cuts")


def repetitions(sized: DataFrame, plan: DataFrame, source: str = "source", u: str = "_u") -> DataFrame:
    """Joins the plan to documents; ``reps`` is how often each one is taken."""
    p = plan.withColumnRenamed("source", "_plan_source")
    if plan.count() <= BROADCAST_SOURCES:
        p = F.broadcast(p)
    return sized.join(p, F.col(source).eqNullSafe(F.col("_plan_source")), "left").withColumn(
        "reps", F.col("whole") + F.when(F.col(u) < F.col("cut"), 1).otherwise(0)
    )


def mix_documents(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    _, plan = plan_mix(docs, seed=seed, **options)
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", word_count("text").alias("size"))
    sized = sized.withColumn("_u", draw(seed, "doc_id", "size"))
    taken = repetitions(sized, plan.select("source", "whole", "cut")).where(F.col("reps") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("reps").cast("int")))).select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    sized, plan = plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return repetitions(sized, plan).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).cast("long").alias("taken")
    )


def sql(docs: str = "documents", budget: float = 1.5, max_epochs: float = 2.0, seed: int = 17) -> str:
    """DuckDB's SQL for the default weights, on running sums over documents'
    draws instead of bins."""
    return rf"""
WITH q1_d AS (SELECT *, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, '-') || ':' || size::varchar), 1, 6))::bigint AS u
  FROM (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size FROM {docs})),
q1_s AS (SELECT *, [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::int]::double AS weight
  FROM (SELECT source, sum(size)::bigint AS source_size FROM q1_d GROUP BY 1)),
q1_c AS (SELECT *, {max_epochs}::double * source_size AS cap, {budget}::double * (sum(source_size) OVER ())::bigint AS b FROM q1_s),
q1_k AS (SELECT *, (b - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
    >= cap * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS clamped
  FROM q1_c WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
q1_t AS (SELECT *, CASE WHEN clamped THEN cap ELSE least(cap, weight * (b - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER ()) END AS target FROM q1_k),
q1_p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::bigint AS whole FROM q1_t),
q1_w AS (SELECT *, target - whole * source_size AS want FROM q1_p),
q1_b AS (SELECT source, u, sum(size)::bigint AS bin FROM q1_d GROUP BY 1, 2),
q1_r AS (SELECT *, sum(bin) OVER (PARTITION BY source ORDER BY u) AS upto FROM q1_b),
q1_x AS (SELECT r.source, r.u, (w.want > upto OR (upto - bin <= w.want AND 2 * w.want >= 2 * upto - bin)) AS more
  FROM q1_r r JOIN q1_w w ON r.source IS NOT DISTINCT FROM w.source)
SELECT d.doc_id, d.size, w.source_size, w.target, (d.size * (w.whole + CASE WHEN x.more THEN 1 ELSE 0 END))::bigint AS taken
FROM q1_d d JOIN q1_w w ON d.source IS NOT DISTINCT FROM w.source JOIN q1_x x ON d.source IS NOT DISTINCT FROM x.source AND d.u = x.u"""
