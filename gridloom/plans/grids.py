"""Queries on grids, with reference SQL by joins over cell offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.operators import rasters as G
from gridloom.plans.dialect import DuckDB, Spark
from gridloom.plans.relations import with_relations

#: Small blocks, so that borders matter in tables of any size.
B = 16
#: Cells of 2 m: rows from y, columns from x; some are missing.
_GRID = """SELECT cy AS row, cx AS col, z, n6, n FROM cells WHERE (cx * 7 + cy * 13) % 41 <> 0"""
#: A smoother surface: a sum of two slopes and a bowl, in whole steps.
_HILL = "SELECT cy AS row, cx AS col, ((cx * 3 + cy * 5) % 17) * 0.5e0 + abs(cx - 23) * 0.25e0 + abs(cy - 21) * 0.25e0 + (z / 64e0) AS z FROM cells WHERE (cx * 7 + cy * 13) % 41 <> 0"
BANDS = ((2.0, 20.0, 2.0), (20.0, 40.0, 4.0), (40.0, None, 6.0))


def _read(spark, sf_dir, text: str, names: list[str] | None = None) -> DataFrame:
    from gridloom.plans.catalog import run_sql

    return run_sql(spark, sf_dir, with_relations(text, ["cells"] if names is None else names, Spark()))


def grid(spark, sf_dir) -> DataFrame:
    found = _read(spark, sf_dir, _GRID)
    return found.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("z").cast("double").alias("z"), "n6", "n")


def hill(spark, sf_dir) -> DataFrame:
    found = _read(spark, sf_dir, _HILL)
    return found.select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("z").cast("double").alias("z"))


def disk_mean(spark, sf_dir):
    return G.focal_mean(grid(spark, sf_dir), 2, block=B)


def disk_range(spark, sf_dir):
    return G.focal_range(grid(spark, sf_dir), 2, block=B)


def distance_bands(spark, sf_dir):
    return G.distance_to(grid(spark, sf_dir).withColumn("m", F.col("n6") >= 12), "m", 7.0, 2.0, block=B)


def closing_cells(spark, sf_dir):
    return G.closed_cells(grid(spark, sf_dir).where("n6 >= 8"), block=B)


def opening_cells(spark, sf_dir):
    return G.opened_cells(grid(spark, sf_dir).where("n6 >= 5"), block=B)


def roof_regions(spark, sf_dir):
    found = G.roof_regions(grid(spark, sf_dir).where("n6 >= 11"), 2.0, 16.0, block=B)
    return found.groupBy("region").agg(F.count("*").alias("cells"), F.count_if("support").alias("supported"), F.sum(F.col("row") * 100 + F.col("col")).alias("places")).drop("region")


def banded_treetops(spark, sf_dir):
    return G.treetops(grid(spark, sf_dir), 2.0, BANDS, 1, block=B)


def crown_cells(spark, sf_dir):
    cells = grid(spark, sf_dir)
    tops = G.treetops(cells, 2.0, BANDS, 1, block=B).select("row", "col", (F.col("row") * 1000 + F.col("col") + 1).alias("seed"))
    return G.crowns(cells.join(tops, ["row", "col"], "left").select("row", "col", "z", "seed"), 2.0, block=B)


def terrain_grid(spark, sf_dir):
    return G.terrain(hill(spark, sf_dir), 2.0, 2, block=B)


def contour_steps(spark, sf_dir):
    return G.contours(hill(spark, sf_dir), 2.5)


def drainage(spark, sf_dir):
    return G.flow_direction(hill(spark, sf_dir), block=B)


def drained_cells(spark, sf_dir):
    return G.flow_accumulation(G.flow_direction(hill(spark, sf_dir), block=B))


def rim_influence(spark, sf_dir):
    return G.boundary_influence(G.flow_direction(hill(spark, sf_dir), block=B))


def filled_surface(spark, sf_dir):
    return G.filled(hill(spark, sf_dir), block=B)


def _groups(spark, sf_dir) -> DataFrame:
    return hill(spark, sf_dir).withColumn("id", F.floor(F.col("row") / 9) * 10 + F.floor(F.col("col") / 11) + 1)


def interior_cells(spark, sf_dir):
    return G.interior(_groups(spark, sf_dir), 2, block=B)


def group_slopes(spark, sf_dir):
    return G.group_slope(_groups(spark, sf_dir), 2.0, block=B)


def stratum_cells(spark, sf_dir):
    cells = grid(spark, sf_dir).select("row", "col", F.when((F.col("row") + F.col("col")) % 9 > 0, F.when(F.col("z") > 42, F.lit(3.0)).otherwise(F.lit(1.0))).alias("chm"), (F.col("n6") >= 14).alias("building"))
    return G.cell_strata(cells, 2.0, near=3.0, edge=4.0, dense_radius=4.0, dense=0.8, block=B)


def sieved_classes(spark, sf_dir):
    return G.sieve(hill(spark, sf_dir).select("row", "col", F.floor(F.col("z") / 4).cast("double").alias("k")), "k", 4, block=B)


def patch_counts(spark, sf_dir):
    return G.patch_census(hill(spark, sf_dir).select("row", "col", F.floor(F.col("z") / 4).cast("double").alias("k")), "k", 4, block=B)


def cell_indices(spark, sf_dir):
    places = _read(spark, sf_dir, "SELECT o_orderkey AS id, (o_custkey % 220) * 0.25e0 - 1 AS x, (o_orderkey % 230) * 0.25e0 - 2 AS y FROM orders", [])
    return places.select("id", G.cell_index(F.col("x"), F.col("y"), 0.0, 50.0, 0.5, 100, 100).alias("c")).select("id", "c.row", "c.col")


_PIECES = "SELECT cy AS row, cx AS col, cast(floor(cx / 6) + 10 * floor(cy / 7) + 1 AS BIGINT) AS label, CASE WHEN (cx + cy) % 5 > 0 THEN cast(floor(cx / 12) + 1 AS BIGINT) END AS owner FROM cells WHERE (cx * 7 + cy * 13) % 41 <> 0 AND NOT (cx % 6 = 0 AND cy % 3 > 0)"


def rejoined_pieces(spark, sf_dir):
    return G.rejoin_contacts(_read(spark, sf_dir, _PIECES), 3, 30)


def dominant_owner(spark, sf_dir):
    return G.dominant(_read(spark, sf_dir, _PIECES), "label", "owner")


def sheet_mosaic(spark, sf_dir):
    return G.mosaic(_read(spark, sf_dir, _SHEETS, ["pts"]))


_SHEETS = "SELECT l_suppkey AS sheet, cast(floor(y / 4e0) AS BIGINT) AS row, cast(floor(x / 4e0) AS BIGINT) AS col, max(z) AS value FROM pts GROUP BY 1, 2, 3"
_SPARSE = "SELECT event_id AS pid, ((event_id * 37 + user_id * 11) % 2000) * 0.05e0 AS x, ((event_id * 53 + user_id * 29) % 2000) * 0.05e0 AS y, abs(value) AS z FROM events WHERE event_type = 'signup'"


def evidence_clusters(spark, sf_dir):
    points = _read(spark, sf_dir, _SPARSE, [])
    found = G.clusters(points, 1.0, 3, 15.0, block=B)
    named = found.withColumn("cluster", F.min("pid").over(_by("region", "kx", "ky"))).select("pid", "cluster")
    return G.cluster_summary(points.join(named, "pid"), 1.0, 0.5)


def _by(*cols):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)


def band_radii(spark, sf_dir):
    tops = _read(spark, sf_dir, "SELECT event_id AS id, abs(value) AS h FROM events", [])
    return tops.select("id", G.band_radius(F.col("h"), G.parse_bands("2-6:1.0, 6-12:1.5, 12-20:2.0, 20-:2.5")).alias("radius"))


def queries() -> dict:
    return {f.__name__: f for f in (
        disk_mean, disk_range, distance_bands, closing_cells, opening_cells, roof_regions, banded_treetops, crown_cells, terrain_grid, contour_steps, drainage, drained_cells, rim_influence,
        filled_surface, interior_cells, group_slopes, stratum_cells, sieved_classes, patch_counts, cell_indices, rejoined_pieces, dominant_owner, sheet_mosaic, evidence_clusters, band_radii,
    )}


def oracle_sql() -> dict[str, str]:
    d = DuckDB()

    def on(body: str, text: str = _GRID, names: list[str] | None = None) -> str:
        return with_relations(f"WITH g AS ({text}), {body}", ["cells"] if names is None else names, d).replace("WITH ", "WITH RECURSIVE ", 1)

    off = lambda r: f"o AS (SELECT i AS dr, j AS dc, sqrt(i * i + j * j) AS dd FROM range({-r}, {r + 1}) a(i), range({-r}, {r + 1}) b(j))"
    near = "g a JOIN o ON true JOIN g b ON b.row = a.row + dr AND b.col = a.col + dc"
    square = f"{off(1)}, grown AS (SELECT DISTINCT row + dr AS row, col + dc AS col FROM s, o)"
    closed = square + ", kept AS (SELECT k.row, k.col FROM (SELECT DISTINCT row, col FROM grown) k, o WHERE EXISTS (SELECT 1 FROM grown h WHERE h.row = k.row + dr AND h.col = k.col + dc) GROUP BY 1, 2 HAVING count(*) = 9)"
    region = lambda src, same, step: f"link AS (SELECT a.row * 100000 + a.col AS u, b.row * 100000 + b.col AS v FROM {src} a JOIN o ON {step} JOIN {src} b ON b.row = a.row + dr AND b.col = a.col + dc AND {same}), reach(u, v) AS (SELECT row * 100000 + col, row * 100000 + col FROM {src} UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u), reg AS (SELECT u, min(v) AS region FROM reach GROUP BY u)"
    slope = "(SELECT b.z FROM g b WHERE b.row = a.row + {} AND b.col = a.col + {})"
    at = lambda r, c: slope.format(r, c)
    flow = f"{off(1)}, fall AS (SELECT a.row, a.col, (a.z - b.z) / dd AS f, CASE (dr * 10 + dc) WHEN 1 THEN 1 WHEN 11 THEN 2 WHEN 10 THEN 4 WHEN 9 THEN 8 WHEN -1 THEN 16 WHEN -11 THEN 32 WHEN -10 THEN 64 WHEN -9 THEN 128 END AS code, b.row AS nr, b.col AS nc FROM {near} WHERE dd > 0 AND b.z < a.z), way AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY f DESC, code) AS n FROM fall) t WHERE n = 1)"
    smooth = f"{off(1)}, sm AS (SELECT a.row, a.col, a.z, avg(b.z) AS s FROM {near} WHERE dd <= 1 GROUP BY ALL), v AS (SELECT * FROM sm WHERE z >= 2 AND s >= 2)"
    tops = " UNION ".join(
        f"SELECT row, col, z FROM v a WHERE s >= {lo} AND s < {1e9 if hi is None else hi} AND NOT EXISTS (SELECT 1 FROM v b WHERE power(b.row - a.row, 2) + power(b.col - a.col, 2) <= {G.cells_of(r, 2.0) ** 2} AND b.s > a.s + 1e-12)" for lo, hi, r in BANDS
    )
    group = "cast(floor(row / 9) * 10 + floor(col / 11) + 1 AS BIGINT)"
    strata = "SELECT row, col, CASE WHEN (row + col) % 9 > 0 THEN (CASE WHEN z > 42 THEN 3 ELSE 1 END) END AS chm, n6 >= 14 AS building FROM g"
    pieces = f"p AS ({_PIECES})"
    return {
        "disk_mean": on(f"{off(2)} SELECT a.row, a.col, avg(b.z) AS mean FROM {near} WHERE dd <= 2 GROUP BY ALL"),
        "disk_range": on(f"{off(2)} SELECT a.row, a.col, min(b.z) AS low, max(b.z) AS high FROM {near} WHERE dd <= 2 GROUP BY ALL"),
        "distance_bands": on(f"{off(3)}, m AS (SELECT a.row, a.col, min(dd) * 2 AS distance FROM {near} WHERE dd <= 3 AND b.n6 >= 12 GROUP BY ALL) SELECT g.row, g.col, distance FROM g LEFT JOIN m ON g.row = m.row AND g.col = m.col"),
        "closing_cells": on(f"s AS (SELECT row, col FROM g WHERE n6 >= 8), {closed}, al AS (SELECT * FROM kept UNION SELECT * FROM s) SELECT al.row, al.col, s.row IS NOT NULL AS support FROM al LEFT JOIN s ON al.row = s.row AND al.col = s.col"),
        "opening_cells": on(f"s AS (SELECT row, col FROM g WHERE n6 >= 5), {off(1)}, er AS (SELECT s.row, s.col FROM s JOIN o ON true JOIN s t ON t.row = s.row + dr AND t.col = s.col + dc GROUP BY ALL HAVING count(*) = 9) SELECT DISTINCT er.row + dr AS row, er.col + dc AS col FROM er, o WHERE EXISTS (SELECT 1 FROM s WHERE s.row = er.row + dr AND s.col = er.col + dc)"),
        "roof_regions": on(f"s AS (SELECT row, col FROM g WHERE n6 >= 11), {closed}, al AS (SELECT k.row, k.col, s.row IS NOT NULL AS support FROM (SELECT * FROM kept UNION SELECT * FROM s) k LEFT JOIN s ON k.row = s.row AND k.col = s.col), {region('al', 'true', 'dd > 0')} SELECT count(*) AS cells, sum(support::INT) AS supported, sum(row * 100 + col) AS places FROM al JOIN reg ON u = row * 100000 + col GROUP BY region HAVING sum(support::INT) * 4 >= 16"),
        "banded_treetops": on(f"{smooth}, mx AS ({tops}), {region('mx', 'true', 'dd > 0')}, q AS (SELECT mx.*, region, max(z) OVER (PARTITION BY region) AS height, avg(row) OVER (PARTITION BY region) AS mr, avg(col) OVER (PARTITION BY region) AS mc FROM mx JOIN reg ON u = row * 100000 + col) SELECT row, col, height FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY power(row - mr, 2) + power(col - mc, 2), row, col) AS n FROM q WHERE z = height) t WHERE n = 1"),
        "terrain_grid": on(f"""{off(2)}, k AS (SELECT row, col, z, {at(0, 1)} AS e, {at(0, -1)} AS w, {at(-1, 0)} AS n, {at(1, 0)} AS s, {at(-1, 1)} AS ne, {at(-1, -1)} AS nw, {at(1, 1)} AS se, {at(1, -1)} AS sw FROM g a),
            q AS (SELECT row, col, z, (e - w) / 4 AS p, (n - s) / 4 AS q, (e - 2 * z + w) / 4 AS r, (n - 2 * z + s) / 4 AS t, (ne - nw - se + sw) / 16 AS u FROM k WHERE e + w + n + s + ne + nw + se + sw IS NOT NULL),
            m AS (SELECT a.row, a.col, avg(b.z) AS mean FROM {near} WHERE dd <= 2 GROUP BY ALL), f AS (SELECT q.*, p * p + q * q AS g2, z - mean AS tpi FROM q JOIN m USING (row, col))
            SELECT row, col, degrees(atan(sqrt(g2))) AS slope, 100 * sqrt(g2) AS percent, CASE WHEN g2 = 0 THEN -1 ELSE (degrees(atan2(-p, -q)) + 360) % 360 END AS aspect,
            CASE WHEN g2 = 0 THEN 0 ELSE -(p * p * r + 2 * p * q * u + q * q * t) / (g2 * power(1 + g2, 1.5)) END AS profile, CASE WHEN g2 = 0 THEN 0 ELSE -(q * q * r - 2 * p * q * u + p * p * t) / (g2 * sqrt(1 + g2)) END AS tangential,
            greatest(0, (sin(radians(45)) - cos(radians(45)) * (p * sin(radians(315)) + q * cos(radians(315)))) / sqrt(1 + g2)) * 255 AS hillshade, tpi FROM f""", _HILL),
        "contour_steps": on("""st AS (SELECT a.row, a.col, dr, dc, a.z AS z1, b.z AS z2 FROM g a JOIN (VALUES (0, 1), (1, 0)) o(dr, dc) ON true JOIN g b ON b.row = a.row + dr AND b.col = a.col + dc)
            SELECT row, col, dr, dc, k * 2.5 AS level, (k * 2.5 - z1) / (z2 - z1) AS share FROM st, range(0, 40) r(k) WHERE k * 2.5 >= least(z1, z2) AND k * 2.5 < greatest(z1, z2)""", _HILL),
        "drainage": on(f"{flow} SELECT g.row, g.col, coalesce(code, 0) AS direction FROM g LEFT JOIN way USING (row, col)", _HILL),
        "drained_cells": on(f"{flow}, path(r0, c0, row, col) AS (SELECT row, col, row, col FROM g UNION ALL SELECT r0, c0, nr, nc FROM path JOIN way USING (row, col)) SELECT row, col, count(*) AS cells FROM path GROUP BY ALL", _HILL),
        "rim_influence": on(f"{flow}, rim AS (SELECT a.row, a.col FROM {near} GROUP BY ALL HAVING count(*) < 9), wet(row, col) AS (SELECT row, col FROM rim UNION SELECT nr, nc FROM wet JOIN way USING (row, col)) SELECT g.row, g.col, wet.row IS NOT NULL AS marked FROM g LEFT JOIN wet USING (row, col)", _HILL),
        "interior_cells": on(f"{off(2)}, i AS (SELECT *, {group} AS id FROM g) SELECT a.row, a.col, count(*) = 25 AS inner FROM i a JOIN o ON true LEFT JOIN i b ON b.row = a.row + dr AND b.col = a.col + dc AND b.id = a.id GROUP BY a.row, a.col HAVING count(b.id) = 25 OR true", _HILL).replace("count(*) = 25 AS inner", "count(b.id) = 25 AS inner").replace(" HAVING count(b.id) = 25 OR true", ""),
        "group_slopes": on(f"i AS (SELECT *, {group} AS id FROM g) SELECT a.row, a.col, degrees(atan(sqrt(power((e.z - w.z) / 4, 2) + power((s.z - n.z) / 4, 2)))) AS slope FROM i a LEFT JOIN i e ON e.row = a.row AND e.col = a.col + 1 AND e.id = a.id LEFT JOIN i w ON w.row = a.row AND w.col = a.col - 1 AND w.id = a.id LEFT JOIN i s ON s.row = a.row + 1 AND s.col = a.col AND s.id = a.id LEFT JOIN i n ON n.row = a.row - 1 AND n.col = a.col AND n.id = a.id", _HILL),
        "stratum_cells": on(f"""{off(2)}, c AS ({strata}), f AS (SELECT a.row, a.col, a.chm, a.building, coalesce(max(CASE WHEN b.building AND dd * 2 <= 3 THEN 1 END), 0) = 1 AS near, coalesce(max(CASE WHEN b.chm >= 2 AND dd * 2 <= 4 THEN 1 END), 0) = 1 AS edge, sum(CASE WHEN b.chm >= 2 AND dd <= 2 THEN 1 ELSE 0 END) / 13.0 AS share
            FROM c a JOIN o ON true LEFT JOIN c b ON b.row = a.row + dr AND b.col = a.col + dc GROUP BY ALL) SELECT row, col, CASE WHEN chm IS NULL THEN 'OM_NODATA' WHEN chm >= 2 THEN '' WHEN building THEN 'OM_ROOF' WHEN near THEN 'OM_NEAR_BLDG' WHEN share >= 0.8 THEN 'OM_DENSE' WHEN edge THEN 'OM_EDGE' ELSE 'OM_OPEN' END AS omission,
            CASE WHEN chm IS NULL THEN '' ELSE CASE WHEN chm >= 2 THEN 'CANOPY' ELSE 'NONCAN' END || CASE WHEN near THEN '_NEAR' ELSE '_FAR' END END AS cell_stratum FROM f"""),
        "patch_counts": on(f"{off(1)}, c AS (SELECT row, col, floor(z / 4) AS k FROM g), {region('c', 'a.k = b.k', 'dd = 1')}, t AS (SELECT k, region, count(*) AS n FROM c JOIN reg ON u = row * 100000 + col GROUP BY ALL) SELECT k, sum(n) AS cells, count(*) AS patches, sum((n < 4)::INT) AS small FROM t GROUP BY k", _HILL),
        "cell_indices": """WITH i AS (SELECT o_orderkey AS id, (o_custkey % 220) * 0.25e0 - 1 AS x, (o_orderkey % 230) * 0.25e0 - 2 AS y FROM orders) SELECT id, CASE WHEN x >= 0 AND x < 50 AND y >= 0 AND y < 50 THEN 99 - cast(floor(y * 2) AS INT) ELSE -1 END AS row, CASE WHEN x >= 0 AND x < 50 AND y >= 0 AND y < 50 THEN cast(floor(x * 2) AS INT) ELSE -1 END AS col FROM i""",
        "rejoined_pieces": on(f"{pieces}, w AS (SELECT label, count(*) AS n FROM p GROUP BY label), ow AS (SELECT label, owner FROM (SELECT label, owner, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, owner) AS k FROM p WHERE owner > 0 GROUP BY label, owner) t WHERE k = 1), t AS (SELECT least(a.label, b.label) AS x, greatest(a.label, b.label) AS y FROM p a JOIN (VALUES (0, 1), (1, 0)) o(dr, dc) ON true JOIN p b ON b.row = a.row + dr AND b.col = a.col + dc AND b.label <> a.label), e AS (SELECT x, y FROM t GROUP BY ALL HAVING count(*) >= 3), f AS (SELECT x, y FROM e JOIN w wx ON wx.label = x JOIN w wy ON wy.label = y LEFT JOIN ow ox ON ox.label = x LEFT JOIN ow oy ON oy.label = y WHERE NOT (coalesce(ox.owner <> oy.owner, false) OR (ox.owner IS NULL AND wx.n < 30) OR (oy.owner IS NULL AND wy.n < 30))), duo AS (SELECT x, y FROM f UNION SELECT y, x FROM f), re(u, v) AS (SELECT label, label FROM w UNION SELECT re.u, duo.y FROM re JOIN duo ON re.v = duo.x) SELECT row, col, (SELECT min(v) FROM re WHERE u = label) AS label FROM p"),
        "dominant_owner": on(f"{pieces} SELECT label, owner FROM (SELECT label, owner, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, owner) AS k FROM p WHERE owner > 0 GROUP BY label, owner) t WHERE k = 1"),
        "sheet_mosaic": on("s AS (SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY sheet) AS k, count(*) OVER (PARTITION BY row, col) AS covers FROM g) SELECT row, col, value, covers FROM s WHERE k = 1", _SHEETS, ["pts"]),
        "evidence_clusters": on(f"""{off(1)}, c AS (SELECT DISTINCT cast(floor(y) AS BIGINT) AS row, cast(floor(x) AS BIGINT) AS col FROM g), {region('c', 'true', 'dd > 0')}, k AS (SELECT g.*, min(pid) OVER w AS cluster, count(*) OVER w AS points FROM g JOIN reg ON u = cast(floor(y) AS BIGINT) * 100000 + cast(floor(x) AS BIGINT) WINDOW w AS (PARTITION BY region, floor(x / 15), floor(y / 15))),
            m AS (SELECT *, median(x) OVER (PARTITION BY cluster) AS mx, median(y) OVER (PARTITION BY cluster) AS my FROM k WHERE points >= 3), p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY sqrt(power(x - mx, 2) + power(y - my, 2)), pid) AS n FROM m) t WHERE n = 1)
            SELECT p.cluster, p.points, p.pid AS pick, p.x, p.y, min(m.z) - 0.5 AS z_low, max(m.z) + 0.5 AS z_high, count(*) AS patch_points FROM p JOIN m ON m.cluster = p.cluster AND sqrt(power(m.x - p.x, 2) + power(m.y - p.y, 2)) <= 1 GROUP BY ALL""", _SPARSE, []),
        "band_radii": "WITH b(lo, hi, r) AS (VALUES (2, 6, 1.0), (6, 12, 1.5), (12, 20, 2.0), (20, 1e18, 2.5)) SELECT event_id AS id, r::DOUBLE AS radius FROM events LEFT JOIN b ON abs(value) >= lo AND abs(value) < hi",
    }
