"""Queries that score stratified samples, with reference SQL.

The SQL states the estimators by their formulas: linearised values with the
derivatives of a ratio written out, so it shares nothing with the engine's
numerical ones.  Limits that need quantiles of t or beta are held against tables
in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.functions import intervals
from gridloom.operators import estimation as E
from gridloom.plans.dialect import Spark

_UNITS = """SELECT doc_id AS id, lang || '|' || CASE WHEN n_chars < 800 THEN 'CANOPY_NEAR' WHEN n_chars < 3000 THEN 'CANOPY_FAR' ELSE 'NONCAN' END AS stratum,
  CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN 'UNSURE' WHEN doc_id % 7 < 5 THEN 'TREE' WHEN doc_id % 5 = 0 THEN 'ROOF_OR_BUILDING' ELSE 'GROUND_OR_OPEN' END AS label,
  doc_id % 4 <> 1 AS retained, doc_id % 5 < 3 AS canopy, doc_id % 3 = 0 AS candidate_near, doc_id % 6 > 0 AS same,
  CASE WHEN doc_id % 10 < 4 THEN 'YES' WHEN doc_id % 10 < 8 THEN 'NO' WHEN doc_id % 10 = 8 THEN 'UNSURE' END AS roof,
  CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'UNSURE' WHEN 2 THEN 'MERGED' WHEN 3 THEN 'SPLIT' WHEN 4 THEN 'NOT_A_TREE' ELSE 'CORRECT' END AS crown FROM documents"""
_SIZES = "SELECT stratum, count(*) * 40 + 17 AS population FROM u GROUP BY stratum"
NAMES = ("score_treetops", "score_cells", "score_omission", "combined_omission", "score_crowns", "stratum_table", "exact_sign_test", "stratum_decisions", "point_scores", "queue_sizes", "spot_checks", "score_objects", "percent_table")


def _units(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    from gridloom.plans.catalog import run_sql

    units = run_sql(spark, sf_dir, _UNITS)
    return units, units.groupBy("stratum").agg((F.count("*") * 40 + 17).alias("population"))


_KEPT = ("key", "estimate", "sqrt(variance) AS error", "degrees", "status")


def score_treetops(spark, sf_dir):
    return E.score_treetops(*_units(spark, sf_dir), new_candidates=500, replicates=50).selectExpr(*_KEPT)


def score_cells(spark, sf_dir):
    return E.score_cells(*_units(spark, sf_dir), 0.25, replicates=50).selectExpr(*_KEPT)


def score_omission(spark, sf_dir):
    return E.score_omission(*_units(spark, sf_dir), 0.25, replicates=50).selectExpr(*_KEPT)


def combined_omission(spark, sf_dir):
    units, sizes = _units(spark, sf_dir)
    return E.combined_omission(units, sizes, units, sizes, replicates=50).selectExpr(*_KEPT)


def score_crowns(spark, sf_dir):
    units, sizes = _units(spark, sf_dir)
    return E.score_crowns(units.withColumn("label", F.col("crown")), sizes, replicates=50).selectExpr(*_KEPT)


def stratum_table(spark, sf_dir):
    units, sizes = _units(spark, sf_dir)
    return E.stratum_table(units, sizes, F.col("label") == "TREE", F.col("retained"))


def exact_sign_test(spark, sf_dir):
    units, _ = _units(spark, sf_dir)
    pairs = units.groupBy("stratum").agg(F.count_if(F.col("retained") & ~F.col("canopy")).alias("b"), F.count_if(~F.col("retained") & F.col("canopy")).alias("c"))
    return pairs.select("stratum", "b", "c", intervals.log10_sign_test(F.col("b"), F.col("c")).alias("log_p"))


def stratum_decisions(spark, sf_dir):
    units, _ = _units(spark, sf_dir)
    errors = units.groupBy("stratum").agg(F.count_if(F.col("label") == "ROOF_OR_BUILDING").alias("k"), F.count_if(E.usable()).alias("n"))
    return errors.select("stratum", intervals.decision(F.col("k"), F.col("n"), 12, 0.3).alias("decision"))


def point_scores(spark, sf_dir):
    from gridloom.plans.catalog import run_sql

    return E.point_scores(run_sql(spark, sf_dir, _POINTS))


_POINTS = "SELECT l_orderkey AS part, cast(l_orderkey % 3 AS INT) AS label, cast(CASE WHEN l_linenumber < 3 THEN l_orderkey % 3 ELSE l_partkey % 3 END AS INT) AS predicted FROM lineitem"


def queue_sizes(spark, sf_dir):
    from gridloom.plans.catalog import run_sql

    return E.queue_size(run_sql(spark, sf_dir, "SELECT event_type AS queue, CASE WHEN event_id % 3 = 0 THEN 'ANSWERED' ELSE 'OPEN' END AS state FROM events"), {"signup": 120.0, "view": 90.0, "click": 60.0, "purchase": 30.0})


def spot_checks(spark, sf_dir):
    from gridloom.plans.catalog import run_sql

    rows = "SELECT event_type AS task, CASE WHEN user_id % 5 > 0 THEN 'A' ELSE 'B' END AS call, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'UNSURE' WHEN user_id % 7 > 0 THEN 'A' ELSE 'B' END AS answer FROM events"
    return E.spot_check(run_sql(spark, sf_dir, rows), 1500, 0.715)


def score_objects(spark, sf_dir):
    """A lattice of true objects and shifted candidates, so the optimum is known."""
    truth = spark.range(400).select("id", (F.col("id") % 20 * 10.0).alias("x"), (F.floor(F.col("id") / 20) * 10.0).alias("y"))
    moved = truth.where("id % 5 < 4").select("id", (F.col("x") + 0.5).alias("x"), "y")
    twins = truth.where("id % 10 = 0").select((F.col("id") + 1000).alias("id"), (F.col("x") - 1.0).alias("x"), "y")
    far = truth.where("id % 7 = 0").select((F.col("id") + 2000).alias("id"), (F.col("x") + 4.0).alias("x"), "y")
    return E.score_objects(truth, moved.unionByName(twins).unionByName(far))


def percent_table(spark, sf_dir):
    """Pooled rates of groups that come with their own sizes."""
    from gridloom.plans.catalog import run_sql

    rows = run_sql(spark, sf_dir, "SELECT o_orderpriority AS task, o_custkey % 50 AS n, (o_orderkey % 100) * 1e0 AS pct FROM orders")
    return rows.groupBy("task").agg((F.sum(F.col("n") * F.col("pct")) / F.sum("n")).alias("pooled"))


def queries() -> dict:
    return {n: globals()[n] for n in NAMES}


def _linear(values: str, terms: list[tuple[str, str, str]], where: str = "label IS NOT NULL AND label <> 'UNSURE'", source: str = "u") -> str:
    """SQL of estimates.  ``values``: columns of a unit; ``terms``: (key, estimate
    by totals, linearised value of a unit by totals t and unit columns)."""
    parts = " UNION ALL ".join(
        f"SELECT '{key}' AS key, any_value({point}) AS estimate, stratum, count(*) AS n, any_value(population) AS size, var_samp({line}) AS s2, count(DISTINCT {line}) AS kinds FROM j GROUP BY stratum" for key, point, line in terms
    )
    names = [v.split(" AS ")[-1] for v in values.split(" ;; ")]
    values = values.replace(" ;; ", ", ")
    totals = ", ".join(f"sum(population * m_{n}) AS T_{n}" for n in names)
    means = ", ".join(f"avg({n}) AS m_{n}" for n in names)
    return f"""WITH u AS ({_UNITS}), z AS ({_SIZES}), v AS (SELECT stratum, {values} FROM {source} WHERE {where}), h AS (SELECT stratum, {means} FROM v GROUP BY stratum),
    t AS (SELECT {totals} FROM h JOIN z USING (stratum)), j AS (SELECT * FROM v JOIN z USING (stratum) CROSS JOIN t), p AS ({parts}),
    c AS (SELECT key, estimate, n, power(size, 2) * (1 - n / size) * s2 / n AS v FROM p),
    a AS (SELECT bool_or(k = 1) AS alike FROM (SELECT count(DISTINCT ({", ".join(names)}, 0)) AS k FROM v GROUP BY stratum) d),
    e AS (SELECT key, any_value(estimate) AS estimate, sqrt(sum(v)) AS error, power(sum(v), 2) / sum(v * v / (n - 1)) AS degrees FROM c GROUP BY key)
    SELECT key, estimate, CASE WHEN NOT alike THEN error END AS error, CASE WHEN NOT alike THEN degrees END AS degrees, CASE WHEN alike THEN 'HOMOGENEOUS_OR_DEGENERATE_SAMPLE' ELSE 'ANALYTIC_TAYLOR_T' END AS status FROM e, a"""


def _share(key: str, a: str, b: str, scale: str = "1", add_a: str = "", add_b: str = "") -> tuple[str, str, str]:
    """Terms of a ratio of sums of columns, with constants added to either total."""
    total = lambda s: "(" + " + ".join(f"T_{x}" for x in s.split("+")) + ")"
    unit = lambda s: "(" + " + ".join(s.split("+")) + ")"
    top, low = f"({total(a)}{add_a})", f"({total(b)}{add_b})"
    return key, f"{top} / {low}", f"{unit(a)} / {low} - {unit(b)} * {top} / ({low} * {low})"


def _sum(key: str, a: str, scale: str = "1") -> tuple[str, str, str]:
    return key, f"T_{a} * {scale}", f"{a} * {scale}"


def oracle_sql() -> dict[str, str]:
    y = "(label = 'TREE')::INT"
    r, c, d = "retained::INT", "canopy::INT", "candidate_near::INT"
    one = "(1 - {})"
    tops = f"{r} AS kept ;; {y} * {r} AS kt ;; {one.format(y)} * {r} AS kf ;; {y} * {one.format(r)} AS rt ;; {one.format(y)} * {one.format(r)} AS rf ;; {y} AS tree"
    cells = f"{c} AS mapped ;; {y} AS tree ;; {c} * {one.format(y)} AS fc ;; {y} * {one.format(c)} AS mi ;; {c} * {one.format(y)} - {y} * {one.format(c)} AS bias"
    om = f"{y} AS tree ;; {y} * {one.format(c)} AS still ;; {y} * {c} AS rec ;; {one.format(y)} * {c} AS added ;; {y} * {one.format(c)} * {one.format(d)} AS alone ;; 1 AS cells"
    both = f"{y} * {one.format(c)} AS mi ;; {y} AS tree"
    combined = _linear(both, [_share("omission_rate", "mi", "tree")], source="(SELECT * FROM u UNION ALL SELECT * REPLACE (stratum || '*' AS stratum) FROM u WHERE split_part(stratum, '|', -1) LIKE 'CANOPY%')")
    combined = combined.replace(f"z AS ({_SIZES})", f"z0 AS ({_SIZES}), z AS (SELECT * FROM z0 UNION ALL SELECT stratum || '*', population FROM z0)")
    s, k = "same::INT", "coalesce(roof IN ('YES', 'NO'), false)::INT"
    crown = " ;; ".join(f"(crown = '{n}')::INT * {s} AS {n}" for n in E.CROWN_LABELS) + f" ;; coalesce(roof = 'YES', false)::INT * {s} AS roofed ;; {k} * {s} AS known ;; {s} AS crowns"
    units = f"WITH u AS ({_UNITS}), z AS ({_SIZES})"
    zz = "3.841458820694124e0"
    return {
        "score_treetops": _linear(tops, [
            _share("precision", "kt", "kept"), _share("precision_if_new_false", "kt", "kept", add_b=" + 500"), _share("precision_if_new_true", "kt", "kept", add_a=" + 500", add_b=" + 500"),
            _share("baseline_precision", "tree", "kept+rt+rf"), _sum("candidates_kept", "kept"), _sum("true_kept", "kt"), _sum("false_kept", "kf"), _sum("true_removed", "rt"), _sum("false_removed", "rf"),
            _share("share_of_false_removed", "rf", "rf+kf"), _share("share_of_true_removed", "rt", "rt+kt"),
        ]),
        "score_cells": _linear(cells, [
            _share("commission", "fc", "mapped"), _share("omission", "mi", "tree"), _sum("area_bias_m2", "bias", "0.25"), _share("relative_bias", "bias", "tree"), _sum("true_canopy_m2", "tree", "0.25"),
            _sum("mapped_canopy_m2", "mapped", "0.25"), _sum("false_canopy_m2", "fc", "0.25"), _sum("missed_canopy_m2", "mi", "0.25"),
        ]),
        "score_omission": _linear(om, [
            _share("tree_share_of_noncanopy", "tree", "cells"), _sum("baseline_missed_m2", "tree", "0.25"), _sum("missed_m2", "still", "0.25"), _sum("recovered_m2", "rec", "0.25"),
            _sum("false_added_m2", "added", "0.25"), _sum("missed_without_nearby_candidate_m2", "alone", "0.25"),
        ]),
        "combined_omission": combined,
        "score_crowns": _linear(crown, [_share(f"share_{n.lower()}", n, "crowns") for n in E.CROWN_LABELS] + [_share("share_includes_roof", "roofed", "known")], "crown IS NOT NULL AND crown <> 'UNSURE'"),
        "stratum_table": f"""{units}, g AS (SELECT stratum, count(*) AS sampled, count(label) AS labelled, sum((coalesce(label, '') = 'UNSURE')::INT) AS unsure, count(*) FILTER (label <> 'UNSURE' AND retained) AS usable,
            count(*) FILTER (label = 'TREE' AND retained) AS successes FROM u GROUP BY stratum), w AS (SELECT stratum, population, sampled, labelled, unsure, usable, successes, successes / nullif(usable, 0) AS share, nullif(usable, 0) AS n FROM z JOIN g USING (stratum))
            SELECT * EXCLUDE n, CASE WHEN n IS NOT NULL THEN greatest(0, (share + {zz} / (2 * n) - sqrt({zz}) * sqrt(share * (1 - share) / n + {zz} / (4 * n * n))) / (1 + {zz} / n)) END AS low,
            CASE WHEN n IS NOT NULL THEN least(1, (share + {zz} / (2 * n) + sqrt({zz}) * sqrt(share * (1 - share) / n + {zz} / (4 * n * n))) / (1 + {zz} / n)) END AS high, usable BETWEEN 1 AND 4 AS unstable FROM w""",
        "exact_sign_test": f"""{units}, g AS (SELECT stratum, count(*) FILTER (retained AND NOT canopy) AS b, count(*) FILTER (NOT retained AND canopy) AS c FROM u GROUP BY stratum)
            SELECT stratum, b, c, log10(least(1, 2 * (SELECT sum(exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))) FROM range(0, 1000) r(i) WHERE i <= least(b, c)))) AS log_p FROM g""",
        "stratum_decisions": f"""{units}, g AS (SELECT stratum, count(*) FILTER (label = 'ROOF_OR_BUILDING') AS k, count(*) FILTER (label <> 'UNSURE') AS n FROM u GROUP BY stratum)
            SELECT stratum, CASE WHEN n < 12 THEN 'WAITING' WHEN (k / n + {zz} / (2 * n) + sqrt({zz} * (k / n * (1 - k / n) / n + {zz} / (4 * n * n)))) / (1 + {zz} / n) <= 0.3 THEN 'PASS' ELSE 'FAIL' END AS decision FROM g""",
        "point_scores": f"""WITH p AS ({_POINTS}), v AS (SELECT part, label, predicted, count(*) AS n FROM p GROUP BY ALL), w AS (SELECT part, label, predicted, row_number() OVER (PARTITION BY part, label ORDER BY n DESC, predicted) AS r FROM v)
            SELECT label, (SELECT count(*) FROM p WHERE p.label = w.label) AS points, (SELECT count(*) FROM p WHERE p.label = w.label AND p.predicted = p.label) AS points_right, count(*) AS parts, sum((label = predicted)::INT) AS parts_right FROM w WHERE r = 1 GROUP BY label""",
        "queue_sizes": "SELECT event_type AS queue, count(*) AS units, sum((event_id % 3 <> 0)::INT) AS open, sum((event_id % 3 <> 0)::INT) / (CASE event_type WHEN 'signup' THEN 120.0 WHEN 'view' THEN 90.0 WHEN 'click' THEN 60.0 WHEN 'purchase' THEN 30.0 END) AS hours FROM events GROUP BY event_type",
        "spot_checks": """WITH a AS (SELECT event_type AS task, sum((event_id % 4 > 1)::INT) AS checked, sum((event_id % 4 > 1 AND (user_id % 7 > 0) = (user_id % 5 > 0))::INT) AS hits FROM events GROUP BY event_type)
            SELECT task, checked, hits, checked >= 1500 AND hits >= 0.715 * checked AS passed FROM a""",
        "score_objects": """WITH n AS (SELECT count(*) FILTER (i % 5 < 4) AS moved, count(*) FILTER (i % 10 = 0) AS twins, count(*) FILTER (i % 7 = 0) AS far FROM range(400) r(i))
            SELECT 400 AS truth, moved + twins + far AS candidates, moved AS tp, twins + far AS fp, 400 - moved AS fn, twins AS duplicates, moved / (moved + twins + far) AS precision, moved / 400 AS recall, 2 * moved / (400 + moved + twins + far) AS f1 FROM n""",
        "percent_table": "SELECT o_orderpriority AS task, sum((o_custkey % 50) * (o_orderkey % 100)) / sum(o_custkey % 50) AS pooled FROM orders GROUP BY 1",
    }
