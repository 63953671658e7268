"""Queries of the summaries, with reference SQL written apart from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.operators import summaries as U
from gridloom.plans.dialect import DuckDB, Spark
from gridloom.plans.relations import with_relations

c = F.col
_CELLS = "SELECT l_suppkey AS id, CASE WHEN l_linenumber % 4 > 0 THEN l_quantity END AS roof, CASE WHEN l_partkey % 9 > 0 THEN (l_partkey % 30) * 1e0 END AS ground, l_suppkey % 10 = 3 AS part FROM lineitem"
_HEIGHTS = "SELECT o_orderkey AS id, (o_custkey % 40) * 0.5e0 AS reference, CASE WHEN o_orderkey % 6 > 0 THEN (o_custkey % 40) * 0.5e0 + (o_orderkey % 17) * 0.5e0 - 4 END AS lidar FROM orders"
_FITS = "SELECT event_id AS id, ((event_id * 37 + user_id * 11) % 2000) * 0.5e0 AS x, ((event_id * 53 + user_id * 29) % 2000) * 0.5e0 AS y, (event_id % 21 - 10) / 8e0 AS dx, (user_id % 17 - 8) / 8e0 AS dy, event_id % 3 > 0 AS reliable FROM events WHERE event_type = 'signup'"
_FACES = """SELECT l_suppkey AS id, l_quantity / 4 AS plan, l_quantity / 4 * (1 + l_linenumber / 16e0) AS area, CASE WHEN l_linenumber = 7 THEN 0e0 ELSE l_quantity + 1 END AS perimeter, (l_partkey % 85) * 1e0 AS slope,
  CASE WHEN l_partkey % 85 > 0 THEN (l_orderkey % 360) * 1e0 END AS azimuth, (l_partkey % 7) * 1e0 + 3 AS z_min, (l_partkey % 7) * 1e0 + 3 + l_linenumber AS z_max, 1e0 AS ground FROM lineitem"""
_MODEL = "SELECT l_suppkey AS id, l_quantity AS lidar, CASE WHEN l_linenumber <> 5 THEN l_quantity + (l_partkey % 33 - 16) / 8e0 END AS model FROM lineitem"
_GRADES = "SELECT event_type AS task, CASE WHEN user_id % 3 = 0 THEN 'high' ELSE 'low' END AS confidence, CASE WHEN user_id % 5 > 0 THEN 'A' ELSE 'B' END AS call, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN 'UNSURE' WHEN user_id % 7 > 0 THEN 'A' ELSE 'B' END AS answer FROM events"
_LABELS = "SELECT CASE o_custkey % 4 WHEN 0 THEN 'TREE' WHEN 1 THEN 'ROOF' WHEN 2 THEN 'WIRE' ELSE 'GROUND' END AS label, CASE o_custkey % 4 WHEN 0 THEN 'VEGETATION' WHEN 1 THEN 'BUILDING' WHEN 3 THEN 'GROUND' END AS expected, CASE o_orderkey % 5 WHEN 0 THEN 'VEGETATION' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'GROUND' END AS family, o_orderkey % 40 AS points FROM orders"
_STATES = "SELECT o_orderpriority AS zone, o_orderstatus AS class, o_custkey % 4 AS state FROM orders"


def _read(spark, sf_dir, text: str, names: tuple = ()) -> DataFrame:
    from gridloom.plans.catalog import run_sql

    return run_sql(spark, sf_dir, with_relations(text, list(names), Spark()))


def classed_values(spark, sf_dir):
    rows = _read(spark, sf_dir, "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 > 0 THEN (o_custkey % 40) * 1e0 END AS v FROM orders")
    ranges = [(0.0, 5.0, "S"), (5.0, 20.0, "M"), (20.0, None, "L")]
    return rows.select("id", U.digitize(c("v"), [10, 15, 20, 25, 30]).alias("code"), U.size_class(c("v"), ranges).alias("size"), U.roof_band(c("v") / 16 - 0.25).alias("band"))


def group_heights(spark, sf_dir):
    return U.height_statistics(_read(spark, sf_dir, _CELLS), "id", "roof")


def building_heights(spark, sf_dir):
    return U.footprint_heights(_read(spark, sf_dir, _CELLS), c("part"))


def height_report(spark, sf_dir):
    return U.height_differences(_read(spark, sf_dir, _HEIGHTS))[0]


def height_outliers(spark, sf_dir):
    return U.height_differences(_read(spark, sf_dir, _HEIGHTS))[1]


def collapsed_crosstab(spark, sf_dir):
    pairs = _read(spark, sf_dir, "SELECT cls AS reference, rn AS predicted, count(*) AS n FROM pts GROUP BY 1, 2", ("pts",))
    return U.crosstab_collapse(pairs, 1)


def label_agreement(spark, sf_dir):
    return U.agreement_by_label(_read(spark, sf_dir, _LABELS))


def gate_counts(spark, sf_dir):
    rows = _read(spark, sf_dir, "SELECT cls AS classification, rc AS shape, rn = 1 AS single, z / 16e0 AS near_m FROM pts", ("pts",))
    return U.gate_summary(rows)


def gate_funnel(spark, sf_dir):
    rows = _read(spark, sf_dir, "SELECT cls, rn, z, x FROM pts", ("pts",))
    return U.funnel(rows, [("vegetation", c("cls") == 5), ("single", c("rn") == 1), ("high", c("z") >= 20), ("west", c("x") < 50)])


def shift_medians(spark, sf_dir):
    return U.cell_medians(_read(spark, sf_dir, _FITS), 125.0)


def shift_neighbours(spark, sf_dir):
    return U.local_field(_read(spark, sf_dir, _FITS), 40.0)


def shift_field(spark, sf_dir):
    # its SQL is the statement of that name
    return U.shift_field(_read(spark, sf_dir, "SELECT id, x, y, (id % 21 - 10) / 10e0 AS sx FROM tops WHERE event_type = 'click'", ("tops",)), 60.0)


def zone_states(spark, sf_dir):
    return U.state_counts(_read(spark, sf_dir, _STATES), 0.25)


def building_roofs(spark, sf_dir):
    return U.roof_attributes(_read(spark, sf_dir, _FACES))


def model_errors(spark, sf_dir):
    return U.level_errors(_read(spark, sf_dir, _MODEL))


def model_grades(spark, sf_dir):
    return U.grade_models(_read(spark, sf_dir, _GRADES), 300, 0.71)


def run_comparison(spark, sf_dir):
    one = lambda text: _read(spark, sf_dir, text)
    return U.compare_runs(one("SELECT o_orderpriority AS metric, sum(o_custkey % 7) * 1e0 AS value FROM orders GROUP BY 1"), one("SELECT o_orderpriority AS metric, sum(o_custkey % 8) * 1e0 AS value FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1"))


def aligned_points(spark, sf_dir):
    a = _read(spark, sf_dir, "SELECT event_id AS point_index, value AS x, user_id * 1e0 AS y, 0e0 AS z, event_type AS kind FROM events")
    b = _read(spark, sf_dir, "SELECT event_id AS point_index, value AS x, user_id * 1e0 AS y, 0e0 AS z, user_id % 5 AS code FROM events")
    return U.zip_points(a, b).groupBy("kind", "code").agg(F.count("*").alias("n"))


def eyes_parts(spark, sf_dir):
    items = _read(spark, sf_dir, "SELECT o_orderkey AS id, o_orderpriority AS stratum, o_custkey % 10 = 0 AS risky FROM orders")
    return U.eyes_split(items, c("risky"), 40, 3).groupBy("stratum", "part").agg(F.count("*").alias("n"))


def queries() -> dict:
    return {f.__name__: f for f in (
        classed_values, group_heights, building_heights, height_report, height_outliers, collapsed_crosstab, label_agreement, gate_counts, gate_funnel, shift_medians, shift_neighbours, shift_field, zone_states, building_roofs,
        model_errors, model_grades, run_comparison, aligned_points, eyes_parts,
    )}


def oracle_sql() -> dict[str, str]:
    d = DuckDB()
    pts = lambda body: with_relations(body, ["pts"], d)
    sloped = "use AND slope >= 10 AND slope <= 60"
    return {
        "classed_values": "WITH i AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 > 0 THEN (o_custkey % 40) * 1e0 END AS v FROM orders) SELECT id, CASE WHEN v IS NULL THEN 0 ELSE 1 + (v >= 10)::INT + (v >= 15)::INT + (v >= 20)::INT + (v >= 25)::INT + (v >= 30)::INT END AS code, CASE WHEN v < 5 THEN 'S' WHEN v < 20 THEN 'M' WHEN v >= 20 THEN 'L' END AS size, CASE WHEN v IS NULL THEN -1 ELSE (v / 16 - 0.25 > 0.5)::INT + (v / 16 - 0.25 > 2)::INT END AS band FROM i",
        "group_heights": f"WITH i AS ({_CELLS}) SELECT id, count(roof) AS n, median(roof) AS p50, quantile_cont(roof, 0.9) AS p90, max(roof) AS max FROM i GROUP BY id",
        "building_heights": f"""WITH i AS ({_CELLS}), p AS (SELECT *, roof - ground AS h FROM i), g AS (SELECT id, count(*) AS cells, count(h) AS roof_cells, median(CASE WHEN h IS NOT NULL THEN roof END) AS roof_p50, median(CASE WHEN h IS NOT NULL THEN ground END) AS ground_p50, median(h) AS p50,
            quantile_cont(h, 0.95) AS p95, max(h) AS max, count(*) FILTER (h < 0) AS negative, bool_or(part) AS pa FROM p GROUP BY id), f AS (SELECT *, roof_cells * 100.0 / cells AS coverage FROM g)
            SELECT * EXCLUDE pa, coalesce(nullif(concat_ws(';', CASE WHEN roof_cells = 0 THEN 'NO_ROOF_SUPPORT' END, CASE WHEN roof_cells > 0 AND coverage < 50 THEN 'LOW_ROOF_SUPPORT' END, CASE WHEN negative > 0 THEN 'NEGATIVE_HEIGHT' END, CASE WHEN pa THEN 'PARTIAL_AOI' END), ''), 'OK') AS status FROM f""",
        "height_report": f"WITH i AS ({_HEIGHTS}), k AS (SELECT *, lidar - reference AS d FROM i WHERE reference > 0 AND lidar IS NOT NULL) SELECT count(*) AS n, median(lidar / reference) AS median_ratio, median(d) AS bias, avg(d) AS mean, median(abs(d)) AS median_abs, quantile_cont(abs(d), 0.9) AS p90_abs FROM k",
        "height_outliers": f"WITH i AS ({_HEIGHTS}) SELECT *, lidar - reference AS difference FROM i WHERE reference > 0 AND abs(lidar - reference) > 3",
        "collapsed_crosstab": pts("SELECT cls AS reference, count(*) AS points, sum((rn = 1)::INT) AS positive, avg((rn = 1)::INT) AS share FROM pts GROUP BY 1"),
        "label_agreement": f"WITH i AS ({_LABELS}), e AS (SELECT *, expected IS NOT NULL AND points >= 12 AS el FROM i) SELECT label, count(*) AS units, sum(el::INT) AS eligible, sum((el AND coalesce(family = expected, false))::INT) AS agree, sum((el AND family IS NULL)::INT) AS abstain, sum((el AND coalesce(family = expected, false))::INT) / nullif(sum(el::INT), 0) AS agreement FROM e GROUP BY label",
        "gate_counts": pts("SELECT cls AS classification, rc AS shape, count(*) AS n, sum((rn = 1)::INT) AS single, sum((z <= 16)::INT) AS near_building FROM pts GROUP BY 1, 2"),
        "gate_funnel": pts("SELECT 0 AS step_no, 'vegetation' AS step, count(*) AS n FROM pts WHERE cls = 5 UNION ALL SELECT 1, 'single', count(*) FROM pts WHERE cls = 5 AND rn = 1 UNION ALL SELECT 2, 'high', count(*) FROM pts WHERE cls = 5 AND rn = 1 AND z >= 20 UNION ALL SELECT 3, 'west', count(*) FROM pts WHERE cls = 5 AND rn = 1 AND z >= 20 AND x < 50"),
        "shift_medians": f"WITH i AS ({_FITS}) SELECT cast(floor(x / 125) AS BIGINT) AS cx, cast(floor(y / 125) AS BIGINT) AS cy, count(*) AS n, median(dx) AS dx, median(dy) AS dy FROM i GROUP BY 1, 2 HAVING count(*) >= 10",
        "shift_neighbours": f"""WITH i AS ({_FITS}), p AS (SELECT a.id, a.dx AS adx, a.dy AS ady, b.dx, b.dy FROM i a JOIN i b ON b.reliable AND a.id <> b.id AND b.x BETWEEN a.x - 40 AND a.x + 40 AND b.y BETWEEN a.y - 40 AND a.y + 40 AND sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) <= 40),
            m AS (SELECT *, median(dx) OVER (PARTITION BY id) AS mx, median(dy) OVER (PARTITION BY id) AS my FROM p), g AS (SELECT id, count(*) AS n, any_value(mx) AS mx, any_value(my) AS my, median(sqrt(power(dx - mx, 2) + power(dy - my, 2))) AS spread FROM m GROUP BY id)
            SELECT i.id, coalesce(n, 0) AS n, CASE WHEN n >= 5 THEN mx END AS local_dx, CASE WHEN n >= 5 THEN my END AS local_dy, CASE WHEN n >= 5 THEN spread END AS spread, CASE WHEN n >= 5 THEN sqrt(mx * mx + my * my) END AS local_m, CASE WHEN n >= 5 THEN sqrt(power(i.dx - mx, 2) + power(i.dy - my, 2)) END AS resid_m FROM i LEFT JOIN g ON i.id = g.id""",
        "zone_states": f"WITH i AS ({_STATES}) SELECT zone, class, state, count(*) AS cells, count(*) * 0.25 / 10000 AS ha, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY zone, class) AS pct FROM i GROUP BY zone, class, state",
        "building_roofs": f"""WITH i AS ({_FACES}), u AS (SELECT *, plan >= 4 OR max(plan) OVER (PARTITION BY id) < 4 AS use FROM i) SELECT id, sum((plan >= 4)::INT) AS planes, count(*) AS faces, sum(plan) FILTER (use) AS plan, sum(area) FILTER (use) AS area, sum(area * slope) FILTER (use) / sum(area) FILTER (use) AS slope_mean,
            (arg_max(slope, area * 1000 + slope) FILTER (use)) AS slope_main, max(z_max) - 1 AS ridge, min(z_min) - 1 AS eave, coalesce(sum(area) FILTER (use AND slope < 10), 0) AS flat_area, coalesce(sum(area) FILTER ({sloped} AND (azimuth >= 315 OR azimuth < 45)), 0) AS north,
            coalesce(sum(area) FILTER ({sloped} AND azimuth >= 45 AND azimuth < 135), 0) AS east, coalesce(sum(area) FILTER ({sloped} AND azimuth >= 135 AND azimuth < 225), 0) AS south, coalesce(sum(area) FILTER ({sloped} AND azimuth >= 225 AND azimuth < 315), 0) AS west,
            sum((plan < 0.5)::INT) AS tiny, sum((perimeter > 0 AND 2 * plan < 0.4 * perimeter)::INT) AS slivers, sum((slope > 75)::INT) AS steep FROM u GROUP BY id""",
        "model_errors": f"WITH i AS (SELECT *, model - lidar AS e FROM ({_MODEL}) m) SELECT id, count(*) AS cells, median(e) AS bias, median(abs(e)) AS abs_p50, quantile_cont(abs(e), 0.95) AS abs_p95, 100.0 * count(*) FILTER (abs(e) <= 0.5) / count(e) AS within_05, 100.0 * count(*) FILTER (abs(e) <= 1) / count(e) AS within_1, 100.0 * count(*) FILTER (e > 1) / count(e) AS above_1, 100.0 * (count(*) - count(e)) / count(*) AS missing FROM i GROUP BY id",
        "model_grades": f"WITH i AS (SELECT * FROM ({_GRADES}) g WHERE answer <> 'UNSURE'), n AS (SELECT task, confidence, count(*) AS n, sum((answer = call)::INT) AS hits FROM i GROUP BY ALL) SELECT *, n >= 300 AND hits >= 0.71 * n AS passed FROM n",
        "run_comparison": "WITH a AS (SELECT o_orderpriority AS metric, sum(o_custkey % 7) AS base, CASE WHEN o_orderpriority <> '5-LOW' THEN sum(o_custkey % 8) END AS new FROM orders GROUP BY 1) SELECT *, new - base AS difference, 100.0 * (new - base) / base AS percent FROM a",
        "aligned_points": "SELECT event_type AS kind, user_id % 5 AS code, count(*) AS n FROM events GROUP BY ALL",
        "eyes_parts": "WITH i AS (SELECT o_orderpriority AS stratum, o_custkey % 10 = 0 AS risky, count(*) AS n FROM orders GROUP BY ALL) SELECT stratum, 'EYES' AS part, n FROM i WHERE risky UNION ALL SELECT stratum, 'SAMPLE', least(n, 40) FROM i WHERE NOT risky UNION ALL SELECT stratum, 'RULE', n - 40 FROM i WHERE NOT risky AND n > 40",
    }
