"""Queries on polygons, with reference SQL over their corner lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.functions import rings as R
from gridloom.operators import polygons as P
from gridloom.plans.dialect import DuckDB, Spark

#: Corners of a slanted hexagon with a four-cornered hole, relative to its base.
_HEXAGON = [(0, 0, 0, 0), (0, 1, 40, 5), (0, 2, 50, 30), (0, 3, 35, 60), (0, 4, 10, 50), (0, 5, -5, 20), (1, 0, 10, 15), (1, 1, 10, 35), (1, 2, 25, 38), (1, 3, 30, 20)]


def _values(d, rows, names) -> str:
    lines = " UNION ALL ".join("SELECT " + ", ".join(f"{v} AS {n}" for v, n in zip(row, names)) for row in rows)
    return f"({lines})"


def corners(d) -> str:
    """id, ring, k, x, y of polygons with a hole, one for each supplier."""
    return f"""SELECT s_suppkey AS id, o.ring, o.k, ((s_suppkey * 37) % 20) * 50e0 + o.dx + 0.25e0 AS x, ((s_suppkey * 53) % 25) * 40e0 + o.dy + 0.25e0 AS y
    FROM supplier CROSS JOIN {_values(d, _HEXAGON, ('ring', 'k', 'dx', 'dy'))} o"""


def rectangles(d, key: str, table: str, w: int, h: int) -> str:
    """id, x0, y0, x1, y1 of rectangles of different sizes."""
    return f"""SELECT {key} AS id, ({key} * 71 % 1900) * 0.5e0 AS x0, ({key} * 113 % 1900) * 0.5e0 AS y0, ({key} * 71 % 1900) * 0.5e0 + {w} + {key} % 13 AS x1,
    ({key} * 113 % 1900) * 0.5e0 + {h} + {key} % 7 AS y1 FROM {table}"""


PLACES = "SELECT event_id AS pid, ((event_id * 37 + user_id * 11) % 2000) * 0.5e0 AS x, ((event_id * 53 + user_id * 29) % 2000) * 0.5e0 AS y FROM events"


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    from gridloom.plans.catalog import run_sql

    return run_sql(spark, sf_dir, text)


def hexagons(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = _sql(spark, sf_dir, corners(Spark()))
    ring = points.groupBy("id", "ring").agg(F.array_sort(F.collect_list(F.struct("k", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))).alias("p"))
    ring = ring.withColumn("p", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))))
    return ring.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "p"))), lambda s: s["p"]).alias("rings"))


def boxes(spark: SparkSession, sf_dir: str, *args) -> DataFrame:
    found = _sql(spark, sf_dir, rectangles(Spark(), *args))
    at = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return found.select("id", F.array(F.array(at("x0", "y0"), at("x1", "y0"), at("x1", "y1"), at("x0", "y1"))).alias("rings"))


LEFT, RIGHT = ("s_suppkey", "supplier", 40, 30), ("c_custkey", "customer", 12, 9)


def polygon_measures(spark, sf_dir):
    b = R.bounds(F.col("rings"))
    return hexagons(spark, sf_dir).select("id", R.area(F.col("rings")).alias("area"), R.perimeter(F.col("rings")).alias("perimeter"), b["xmin"].alias("xmin"), b["ymax"].alias("ymax"))


def polygon_points(spark, sf_dir):
    return P.points_in_polygons(_sql(spark, sf_dir, PLACES), hexagons(spark, sf_dir)).select("pid", "id")


def polygon_state(spark, sf_dir):
    return P.footprint_state(_sql(spark, sf_dir, PLACES), hexagons(spark, sf_dir))


def polygon_cells(spark, sf_dir):
    return P.rasterize(hexagons(spark, sf_dir), 0.0, 1000.0, 4.0, 250, 200).groupBy("id").agg(F.count("*").alias("cells"), F.sum(F.col("row") * 1000 + F.col("col")).alias("places"))


def polygon_truncated(spark, sf_dir):
    return P.truncated(hexagons(spark, sf_dir), 0.0, 1000.0, 4.0, 250, 200)


def polygon_nearest(spark, sf_dir):
    return P.nearest_polygon(_sql(spark, sf_dir, PLACES), boxes(spark, sf_dir, *LEFT), 25.0)


def overlap_pairs(spark, sf_dir):
    return P.overlaps(boxes(spark, sf_dir, *LEFT), boxes(spark, sf_dir, *RIGHT)).select("a", "b", "area_a", "area_b", "shared", P.iou(F.col("area_a"), F.col("area_b"), F.col("shared")).alias("iou"))


def overlap_best(spark, sf_dir):
    right = boxes(spark, sf_dir, *LEFT)
    return P.once_per_shape(boxes(spark, sf_dir, *RIGHT), lambda shapes: P.best_overlap(P.overlaps(shapes, right), 0.3))


def overlap_class(spark, sf_dir):
    right = boxes(spark, sf_dir, *LEFT)
    return P.once_per_shape(boxes(spark, sf_dir, *RIGHT), lambda shapes: P.match_class(shapes, P.overlaps(shapes, right), 0.12))


def overlap_share(spark, sf_dir):
    return P.covered_share(boxes(spark, sf_dir, *LEFT), boxes(spark, sf_dir, *RIGHT), boxes(spark, sf_dir, "p_partkey", "part", 5, 5))


def overlap_none(spark, sf_dir):
    return P.disjoint(boxes(spark, sf_dir, *RIGHT), boxes(spark, sf_dir, *LEFT)).select("id")


def overlap_groups(spark, sf_dir):
    return P.compare_layers(boxes(spark, sf_dir, *LEFT), boxes(spark, sf_dir, *RIGHT), 0.5, 0.1)


def coverage_in_hand(spark, sf_dir):
    return P.coverage(boxes(spark, sf_dir, *RIGHT), boxes(spark, sf_dir, *LEFT))


def evaluation_distances(spark, sf_dir):
    marks = _sql(spark, sf_dir, "SELECT c_custkey AS id, (c_custkey * 131 % 2000) * 0.5e0 AS x, (c_custkey * 37 % 2000) * 0.5e0 AS y FROM customer")
    return P.evaluation_distance(_sql(spark, sf_dir, PLACES), marks, boxes(spark, sf_dir, *LEFT), 12.0)


def roof_faces(spark, sf_dir):
    """Slope, area and bearing of a tilted square for each part."""
    parts = _sql(spark, sf_dir, "SELECT p_partkey AS id, p_size * 0.125e0 AS sx, (p_partkey % 9 - 4) * 0.125e0 AS sy FROM part")
    at = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), (F.col("sx") * x + F.col("sy") * y).alias("z"))
    face = parts.select("id", R.plane_face(F.array(at(0, 0), at(4, 0), at(4, 4), at(0, 4))).alias("f"))
    return face.select("id", "f.*")


def queries() -> dict:
    return {f.__name__: f for f in (
        polygon_measures, polygon_points, polygon_state, polygon_cells, polygon_truncated, polygon_nearest, overlap_pairs, overlap_best, overlap_class, overlap_share, overlap_none,
        overlap_groups, coverage_in_hand, evaluation_distances, roof_faces,
    )}


def oracle_sql() -> dict[str, str]:
    d = DuckDB()
    edges = f"""WITH RECURSIVE v AS ({corners(d)}), e AS (SELECT id, x AS x0, y AS y0, lead(x, 1, first_x) OVER w AS x1, lead(y, 1, first_y) OVER w AS y1 FROM
    (SELECT *, first(x) OVER (PARTITION BY id, ring ORDER BY k) AS first_x, first(y) OVER (PARTITION BY id, ring ORDER BY k) AS first_y FROM v) f WINDOW w AS (PARTITION BY id, ring ORDER BY k)),
    p AS ({PLACES}), hit AS (SELECT pid, id FROM p JOIN e ON ((y0 > y) <> (y1 > y)) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0 GROUP BY pid, id HAVING count(*) % 2 = 1)"""
    a, b = rectangles(d, *LEFT), rectangles(d, *RIGHT)
    part = rectangles(d, "p_partkey", "part", 5, 5)
    pairs = lambda one, two: f"""WITH RECURSIVE l AS ({one}), r AS ({two}), o AS (SELECT l.id AS a, r.id AS b, (l.x1 - l.x0) * (l.y1 - l.y0) AS area_a, (r.x1 - r.x0) * (r.y1 - r.y0) AS area_b,
    (least(l.x1, r.x1) - greatest(l.x0, r.x0)) * (least(l.y1, r.y1) - greatest(l.y0, r.y0)) AS shared FROM l JOIN r ON l.x0 < r.x1 AND r.x0 < l.x1 AND l.y0 < r.y1 AND r.y0 < l.y1)"""  # noqa: E731
    best = "(SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS n FROM o"
    gap = "sqrt(power(greatest(x0 - x, 0, x - x1), 2) + power(greatest(y0 - y, 0, y - y1), 2))"
    return {
        "polygon_measures": f"{edges} SELECT id, abs(sum(x0 * y1 - x1 * y0)) / 2 AS area, sum(sqrt(power(x1 - x0, 2) + power(y1 - y0, 2))) AS perimeter, min(x0) AS xmin, max(y0) AS ymax FROM e GROUP BY id",
        "polygon_points": f"{edges} SELECT pid, id FROM hit",
        "polygon_state": f"""{edges}, n AS (SELECT pid, min(sqrt(power(x - (x0 + t * (x1 - x0)), 2) + power(y - (y0 + t * (y1 - y0)), 2))) AS edge FROM
            (SELECT p.pid, x, y, x0, y0, x1, y1, least(1, greatest(0, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / (power(x1 - x0, 2) + power(y1 - y0, 2)))) AS t FROM p
            JOIN (SELECT id, min(x0) AS xmin, max(x0) AS xmax, min(y0) AS ymin, max(y0) AS ymax FROM e GROUP BY id) g ON x BETWEEN xmin - 10 AND xmax + 10 AND y BETWEEN ymin - 10 AND ymax + 10 JOIN e ON e.id = g.id) s GROUP BY pid),
            ar AS (SELECT id, abs(sum(x0 * y1 - x1 * y0)) / 2 AS area FROM e GROUP BY id), h AS (SELECT pid, max(area) AS area FROM hit JOIN ar ON hit.id = ar.id GROUP BY pid)
            SELECT p.pid, h.pid IS NOT NULL AS inside, coalesce(n.edge, 99) AS edge, h.area FROM p LEFT JOIN n ON p.pid = n.pid LEFT JOIN h ON p.pid = h.pid""",
        "polygon_cells": f"""{edges}, c AS (SELECT r.range AS row, k.range AS col, (k.range + 0.5) * 4e0 AS cx, 1000 - (r.range + 0.5) * 4e0 AS cy FROM range(250) r, range(200) k),
            m AS (SELECT id, row, col FROM c JOIN e ON ((y0 <= cy) <> (y1 <= cy)) AND cx < x0 + (cy - y0) / (y1 - y0) * (x1 - x0) GROUP BY id, row, col HAVING count(*) % 2 = 1)
            SELECT id, count(*) AS cells, sum(row * 1000 + col) AS places FROM m GROUP BY id""",
        "polygon_truncated": f"{edges} SELECT id, min(x0) < 0 OR max(x0) > 800 OR min(y0) < 0 OR max(y0) > 1000 AS truncated FROM e GROUP BY id",
        "polygon_nearest": f"WITH p AS ({PLACES}), l AS ({a}) SELECT pid, id, distance FROM (SELECT pid, id, {gap} AS distance, row_number() OVER (PARTITION BY pid ORDER BY {gap}, id) AS n FROM p JOIN l ON x BETWEEN x0 - 25 AND x1 + 25 AND y BETWEEN y0 - 25 AND y1 + 25 WHERE {gap} <= 25) s WHERE n = 1",
        "overlap_pairs": f"{pairs(a, b)} SELECT *, shared / (area_a + area_b - shared) AS iou FROM o",
        "overlap_best": f"{pairs(b, a)} SELECT a, b, area_a, area_b, shared FROM {best} WHERE shared / area_a >= 0.3 OR shared / area_b >= 0.3) s WHERE n = 1",
        "overlap_class": f"""{pairs(b, a)}, s AS (SELECT * FROM {best}) WHERE n = 1), m AS (SELECT l.id AS a, CASE WHEN shared >= 0.1 * area_a THEN b END AS b, CASE WHEN shared >= 0.1 * area_a THEN shared / (area_a + area_b - shared) END AS iou FROM l LEFT JOIN s ON l.id = s.a)
            SELECT *, CASE WHEN iou IS NULL THEN 'ONLY' WHEN iou >= 0.12 THEN 'MATCH' ELSE 'PARTIAL' END AS class FROM m""",
        "overlap_share": f"""{pairs(a, b)}, q AS ({part}), t AS (SELECT a, shared FROM o UNION ALL SELECT l.id, (least(l.x1, q.x1) - greatest(l.x0, q.x0)) * (least(l.y1, q.y1) - greatest(l.y0, q.y0)) FROM l JOIN q
            ON l.x0 < q.x1 AND q.x0 < l.x1 AND l.y0 < q.y1 AND q.y0 < l.y1) SELECT l.id AS a, coalesce((SELECT sum(shared) FROM t WHERE t.a = l.id), 0) / ((x1 - x0) * (y1 - y0)) AS share FROM l""",
        "overlap_none": f"{pairs(b, a)} SELECT id FROM l WHERE id NOT IN (SELECT a FROM o)",
        "overlap_groups": f"""{pairs(a, b)}, k AS (SELECT 'l' || a AS u, 'r' || b AS v, shared FROM o WHERE shared >= 0.5 * least(area_a, area_b)), duo AS (SELECT u, v FROM k UNION SELECT v, u FROM k),
            every AS (SELECT 'l' || id AS n, 'l' AS kind, id, (x1 - x0) * (y1 - y0) AS area FROM l UNION ALL SELECT 'r' || id, 'r', id, (x1 - x0) * (y1 - y0) FROM r),
            reach(n, m) AS (SELECT n, n FROM every UNION SELECT reach.n, duo.v FROM reach JOIN duo ON reach.m = duo.u), g AS (SELECT n, min(m) AS g FROM reach GROUP BY n),
            t AS (SELECT g, coalesce(string_agg(CASE WHEN kind = 'l' THEN cast(id AS VARCHAR) END, ';' ORDER BY cast(id AS VARCHAR)), '') AS left_ids, coalesce(string_agg(CASE WHEN kind = 'r' THEN cast(id AS VARCHAR) END, ';' ORDER BY cast(id AS VARCHAR)), '') AS right_ids,
            count(*) FILTER (kind = 'l') AS n_left, count(*) FILTER (kind = 'r') AS n_right, coalesce(sum(area) FILTER (kind = 'l'), 0) AS left_area, coalesce(sum(area) FILTER (kind = 'r'), 0) AS right_area FROM every JOIN g ON every.n = g.n GROUP BY g),
            s AS (SELECT g, sum(shared) AS shared FROM k JOIN g ON k.u = g.n GROUP BY g), f AS (SELECT t.*, CASE WHEN n_left = 1 AND n_right = 1 THEN shared / (left_area + right_area - shared) END AS iou FROM t LEFT JOIN s ON t.g = s.g)
            SELECT CASE WHEN n_right = 0 THEN 'LEFT_ONLY' WHEN n_left = 0 THEN 'RIGHT_ONLY' WHEN iou IS NOT NULL THEN (CASE WHEN iou >= 0.1 THEN 'MATCH' ELSE 'RESHAPED' END) WHEN n_right = 1 THEN 'JOINS' WHEN n_left = 1 THEN 'SPLITS' ELSE 'TANGLE' END AS class,
            left_ids, right_ids, n_left, n_right, iou, left_area, right_area FROM f""",
        "coverage_in_hand": f"{pairs(b, a)} SELECT id, coalesce((SELECT max(shared / area_a) FROM o WHERE o.a = l.id), 0) >= 0.5 AS in_hand FROM l",
        "evaluation_distances": f"""WITH p AS ({PLACES}), l AS ({a}), m AS (SELECT (c_custkey * 131 % 2000) * 0.5e0 AS mx, (c_custkey * 37 % 2000) * 0.5e0 AS my FROM customer),
            t AS (SELECT pid, sqrt(power(x - mx, 2) + power(y - my, 2)) AS g FROM p JOIN m ON mx BETWEEN x - 12 AND x + 12 AND my BETWEEN y - 12 AND y + 12 UNION ALL SELECT pid, {gap} FROM p JOIN l ON x BETWEEN x0 - 12 AND x1 + 12 AND y BETWEEN y0 - 12 AND y1 + 12)
            SELECT p.pid, min(g) AS distance FROM p LEFT JOIN t ON p.pid = t.pid AND g <= 12 GROUP BY p.pid""",
        "roof_faces": """WITH s AS (SELECT p_partkey AS id, p_size * 0.125e0 AS sx, (p_partkey % 9 - 4) * 0.125e0 AS sy FROM part), t AS (SELECT *, sqrt(1 + sx * sx + sy * sy) AS f FROM s)
            SELECT id, 16e0 AS plan, 16 * f AS area, degrees(acos(1 / f)) AS slope, CASE WHEN degrees(acos(1 / f)) >= 0.5 THEN (degrees(atan2(-sx, -sy)) + 360) % 360 END AS azimuth FROM t""",
    }
