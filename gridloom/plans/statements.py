"""The relational queries: name -> (relations read, writer of the SQL).

Literals with an exponent are doubles in both engines.  Joins over space are
equi-joins on bins or cell offsets with an exact test after them, never a
comparison of all pairs.
"""

from __future__ import annotations

STATEMENTS: dict = {}


def query(*relations: str):
    def add(write):
        STATEMENTS[write.__name__] = (list(relations), write)
        return write

    return add


# ---------------------------------------------------------------- point scans


@query("pts")
def las_class_histogram(d):
    return "SELECT cls, count(*) AS n, sum(CASE WHEN flags & 4 <> 0 THEN 1 ELSE 0 END) AS n_withheld FROM pts GROUP BY cls"


@query("pts")
def las_return_flags(d):
    return """SELECT rn, rc, rn = 1 AS is_first, rc = 1 AS is_single, (flags & 13) = 0 AS is_clean, count(*) AS n FROM pts GROUP BY 1, 2, 3, 4, 5"""


@query("pts")
def point_decode(d):
    return """SELECT pid, x, y, z, cls & 31 AS code, rn & 15 AS number, CASE WHEN rn = 1 AND rc = 1 THEN 'single' WHEN rn = 1 THEN 'first'
  WHEN rn = rc THEN 'last' ELSE 'intermediate' END AS return_type FROM pts WHERE (flags & 13) = 0"""


@query("pts")
def las_inventory(d):
    return """SELECT l_suppkey % 16 AS tile, count(*) AS points, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax, min(z) AS zmin, max(z) AS zmax,
  max(CASE WHEN cls = 2 THEN 1 ELSE 0 END) AS has_ground, max(CASE WHEN cls = 5 THEN 1 ELSE 0 END) AS has_vegetation, max(CASE WHEN cls = 6 THEN 1 ELSE 0 END) AS has_building
  FROM pts GROUP BY 1"""


@query("pts")
def neighbour_eligible_points(d):
    return "SELECT pid, x, y, z FROM pts WHERE cls NOT IN (2, 7, 18) AND (flags & 13) = 0 AND x BETWEEN 20 AND 80 AND y BETWEEN 20 AND 80"


@query("pts")
def hag_copy(d):
    return """WITH ground AS (SELECT cast(floor(x / 2e0) AS BIGINT) AS cx, cast(floor(y / 2e0) AS BIGINT) AS cy, min(z) AS g FROM pts WHERE cls = 2 GROUP BY 1, 2)
SELECT pid, p.z, g.g AS ground, p.z - g.g AS hag, CASE WHEN g.g IS NULL THEN -2147483648 ELSE cast((p.z - g.g) * 100 AS BIGINT) END AS hag_code,
  CASE WHEN g.g IS NULL OR p.z - g.g > 80 THEN 0 WHEN p.z - g.g <= 2 THEN 3 WHEN p.z - g.g <= 5 THEN 4 ELSE 5 END AS band
FROM pts p LEFT JOIN ground g ON cast(floor(p.x / 2e0) AS BIGINT) = g.cx AND cast(floor(p.y / 2e0) AS BIGINT) = g.cy"""


@query("pts")
def class_recode_audit(d):
    return "SELECT pid, cls AS old_code, CASE WHEN cls = 5 AND z > 40 AND rn = 1 THEN 6 ELSE cls END AS new_code, cls = 5 AND z > 40 AND rn = 1 AS changed FROM pts"


@query("pts")
def manifest_check(d):
    return f"""SELECT tile, url, bytes, points, CASE WHEN points = 0 THEN 'EMPTY' WHEN n_url > 1 THEN 'DUPLICATE' ELSE 'OK' END AS state FROM (
  SELECT *, count(*) OVER (PARTITION BY url) AS n_url FROM (SELECT l_suppkey AS tile, 'las/' || {d.text('l_suppkey % 90')} || '.las' AS url, count(*) * 30 + 227 AS bytes, count(*) AS points
  FROM pts GROUP BY l_suppkey) a) b"""


# ------------------------------------------------------------- scalar functions


@query("tops")
def band_radius(d):
    return """SELECT id, h, CASE WHEN h >= 2 AND h < 6 THEN 1.0e0 WHEN h >= 6 AND h < 12 THEN 1.5e0 WHEN h >= 12 AND h < 20 THEN 2.0e0 WHEN h >= 20 THEN 2.5e0 END AS radius,
  CASE WHEN h >= 2 THEN greatest(1, cast(floor((CASE WHEN h < 6 THEN 1.0e0 WHEN h < 12 THEN 1.5e0 WHEN h < 20 THEN 2.0e0 ELSE 2.5e0 END) / 0.5e0 + 0.5e0) AS BIGINT)) END AS radius_cells FROM tops"""


@query()
def parcel_norm(d):
    return f"SELECT s_suppkey, {d.sub('s_name', '[^A-Za-z0-9]', '')} AS parcel, length({d.sub('s_name', '[^0-9]', '')}) AS n_digits FROM supplier"


@query()
def unit_conversion(d):
    return """SELECT p_partkey, p_retailprice / 0.3048e0 AS feet, p_retailprice / 0.09290304e0 AS square_feet, p_size / 4046.8564224e0 AS acres,
  CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 25 THEN 'M' WHEN p_size < 40 THEN 'L' ELSE 'XL' END AS size_class FROM part"""


@query()
def ndvi_screen(d):
    return """SELECT o_orderkey, v AS ndvi, CASE WHEN v IS NULL THEN 'UNKNOWN' WHEN v < 0.3e0 THEN 'LOW_GREENNESS_REVIEW' ELSE 'GREEN_SPECTRAL_SUPPORT' END AS screen FROM (
  SELECT o_orderkey, CASE WHEN nir + red > 0 AND o_orderkey % 17 <> 0 THEN (nir - red) / (nir + red) END AS v FROM (
    SELECT o_orderkey, (o_orderkey % 97) * 1e0 AS red, (o_custkey % 193) * 1e0 AS nir FROM orders) b) s"""


@query("tops")
def roof_context(d):
    return """SELECT id, CASE WHEN dist > 1.0e0 THEN 'AWAY' WHEN roof IS NULL THEN 'UNKNOWN' WHEN h - roof <= 0.5e0 THEN 'ROOF_LEVEL' WHEN h - roof < 2.0e0 THEN 'ROOF_MID' ELSE 'ABOVE_ROOF' END AS context,
  CASE WHEN dist <= 1.0e0 THEN h - roof END AS above_roof FROM (SELECT id, h, (id % 40) / 10e0 AS dist, CASE WHEN id % 7 > 0 THEN (user_id % 30) * 1e0 END AS roof FROM tops) t"""


@query()
def json_props(d):
    k = f"cast({d.json('props', 'k')} AS BIGINT)"
    return f"SELECT event_type, {k} % 10 AS bucket, count(*) AS n, sum({k}) AS sum_k, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2"


@query()
def unit_tokens(d):
    return f"SELECT doc_id, substr({d.sha(d.text('doc_id') + chr(32) + '||' + chr(39) + '|' + chr(39) + '||' + ' source')}, 1, 24) AS token FROM documents"


@query()
def facing(d):
    return """SELECT o_orderkey, azimuth, CASE WHEN azimuth >= 315 OR azimuth < 45 THEN 'N' WHEN azimuth < 135 THEN 'E' WHEN azimuth < 225 THEN 'S' ELSE 'W' END AS facing
  FROM (SELECT o_orderkey, (o_orderkey * 37) % 360 AS azimuth FROM orders) t"""


# ----------------------------------------------------------- filters, predicates


@query("tops")
def tile_ownership(d):
    return """SELECT cast(floor(x / 250e0) AS BIGINT) AS tx, cast(floor(y / 250e0) AS BIGINT) AS ty, count(*) AS owned,
  sum(CASE WHEN x - floor(x / 250e0) * 250 < 10 OR x - floor(x / 250e0) * 250 >= 240 OR y - floor(y / 250e0) * 250 < 10 OR y - floor(y / 250e0) * 250 >= 240 THEN 1 ELSE 0 END) AS in_halo FROM tops GROUP BY 1, 2"""


@query("tops")
def exclusion_reasons(d):
    return """SELECT id, CASE WHEN x < 20 OR x >= 980 OR y < 20 OR y >= 980 THEN 'outside core' WHEN cast(floor(x / 100e0) AS BIGINT) = 3 THEN 'excluded tile'
  WHEN (x - 500) * (x - 500) + (y - 500) * (y - 500) <= 625 THEN 'evaluation buffer' ELSE '' END AS reason FROM tops"""


@query()
def eligibility_reasons(d):
    return f"""SELECT c_custkey, CASE WHEN reasons = '' THEN TRUE ELSE FALSE END AS eligible, reasons FROM (SELECT c_custkey,
  concat(CASE WHEN c_acctbal < 0 THEN 'negative;' ELSE '' END, CASE WHEN c_nationkey % 5 = 0 THEN 'region;' ELSE '' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'segment;' ELSE '' END) AS reasons FROM customer) t"""


# ------------------------------------------------------------------------ joins


@query("tops", "parcels")
def pip_ownership(d):
    return f"""WITH cover AS (SELECT pid, owner, x0, x1, y0, y1, cast(floor(x0 / 50e0) AS BIGINT) + o AS bx, cast(floor(y0 / 40e0) AS BIGINT) AS byy FROM parcels CROSS JOIN {d.offsets([0, 1], 'o')} q),
hits AS (SELECT t.id, c.pid, CASE WHEN c.pid % 4 = 0 THEN 'PUBLIC' ELSE 'PRIVATE' END AS category FROM tops t JOIN cover c
  ON cast(floor(t.x / 50e0) AS BIGINT) = c.bx AND cast(floor(t.y / 40e0) AS BIGINT) = c.byy WHERE t.x >= c.x0 AND t.x < c.x1 AND t.y >= c.y0 AND t.y < c.y1)
SELECT t.id, count(h.pid) AS matches, CASE WHEN count(h.pid) = 0 THEN 'NO_PARCEL' WHEN count(DISTINCT h.category) = 1 THEN min(h.category) ELSE 'OWNERSHIP_CONFLICT' END AS ownership
FROM tops t LEFT JOIN hits h ON t.id = h.id GROUP BY t.id"""


@query("tops", "parcels")
def ownership_totals(d):
    return f"""WITH o AS ({STATEMENTS['pip_ownership'][1](d).replace('WITH cover', 'WITH cover_', 1).replace('JOIN cover c', 'JOIN cover_ c')})
SELECT ownership, count(*) AS n, sum(CASE WHEN matches > 1 THEN 1 ELSE 0 END) AS multi FROM o GROUP BY ownership"""


@query("tops")
def ball_join_stats(d):
    return f"""WITH l AS (SELECT id, x, y, h, cast(floor(x / 10e0) AS BIGINT) + dx AS bx, cast(floor(y / 10e0) AS BIGINT) + dy AS byy FROM tops
  CROSS JOIN {d.offsets([-1, 0, 1], 'dx')} a CROSS JOIN {d.offsets([-1, 0, 1], 'dy')} b WHERE event_type = 'signup'),
r AS (SELECT id AS rid, x AS rx, y AS ry, h AS rh, cast(floor(x / 10e0) AS BIGINT) AS bx, cast(floor(y / 10e0) AS BIGINT) AS byy FROM tops WHERE event_type = 'view')
SELECT l.id, count(*) AS n, max(rh) AS top, min((rx - l.x) * (rx - l.x) + (ry - l.y) * (ry - l.y)) AS least_d2 FROM l JOIN r ON l.bx = r.bx AND l.byy = r.byy
WHERE (rx - l.x) * (rx - l.x) + (ry - l.y) * (ry - l.y) <= 100 GROUP BY l.id"""


@query("tops")
def nearest_building(d):
    return f"""WITH l AS (SELECT id, x, y, cast(floor(x / 25e0) AS BIGINT) + dx AS bx, cast(floor(y / 25e0) AS BIGINT) + dy AS byy FROM tops
  CROSS JOIN {d.offsets([-1, 0, 1], 'dx')} a CROSS JOIN {d.offsets([-1, 0, 1], 'dy')} b WHERE event_type = 'error'),
r AS (SELECT id AS rid, x AS rx, y AS ry, cast(floor(x / 25e0) AS BIGINT) AS bx, cast(floor(y / 25e0) AS BIGINT) AS byy FROM tops WHERE event_type = 'purchase'),
p AS (SELECT l.id, rid, (rx - l.x) * (rx - l.x) + (ry - l.y) * (ry - l.y) AS d2 FROM l JOIN r ON l.bx = r.bx AND l.byy = r.byy),
k AS (SELECT id, rid, d2, row_number() OVER (PARTITION BY id ORDER BY d2, rid) AS rank FROM p WHERE d2 <= 625)
SELECT t.id, k.rid AS nearest, sqrt(k.d2) AS distance FROM tops t LEFT JOIN k ON t.id = k.id AND k.rank = 1 WHERE t.event_type = 'error'"""


@query("tops")
def knn_neighbors(d):
    return f"""WITH l AS (SELECT id, x, y, cast(floor(x / 20e0) AS BIGINT) + dx AS bx, cast(floor(y / 20e0) AS BIGINT) + dy AS byy FROM tops
  CROSS JOIN {d.offsets([-1, 0, 1], 'dx')} a CROSS JOIN {d.offsets([-1, 0, 1], 'dy')} b),
r AS (SELECT id AS rid, x AS rx, y AS ry, cast(floor(x / 20e0) AS BIGINT) AS bx, cast(floor(y / 20e0) AS BIGINT) AS byy FROM tops),
p AS (SELECT l.id, rid, (rx - l.x) * (rx - l.x) + (ry - l.y) * (ry - l.y) AS d2 FROM l JOIN r ON l.bx = r.bx AND l.byy = r.byy)
SELECT id, rank, rid, d2 FROM (SELECT id, rid, d2, row_number() OVER (PARTITION BY id ORDER BY d2, rid) AS rank FROM p WHERE d2 <= 400) k WHERE rank <= 5"""


@query("pts", "chm")
def raster_sample(d):
    return """SELECT p.pid, c.chm, CASE WHEN c.cx IS NULL THEN 'OFF_GRID' WHEN c.chm IS NULL THEN 'UNOBSERVED' WHEN c.bld IS NOT NULL THEN 'BUILDING' WHEN c.veg IS NULL THEN 'NO_VEGETATION' WHEN c.chm < 2 THEN 'LOWER' ELSE 'KEPT' END AS status
FROM pts p LEFT JOIN chm c ON cast(floor(p.x / 0.5e0) AS BIGINT) = c.cx AND cast(floor(p.y / 0.5e0) AS BIGINT) = c.cy WHERE p.cls = 5 AND p.rn = 1"""


@query()
def plan_import(d):
    return """WITH incoming AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 1 - quality WHEN doc_id % 11 = 0 THEN NULL ELSE quality END AS quality FROM labels WHERE doc_id % 5 <> 0
  UNION ALL SELECT -doc_id - 1 AS doc_id, quality FROM labels WHERE doc_id % 13 = 0)
SELECT coalesce(l.doc_id, i.doc_id) AS doc_id, l.quality AS old_quality, i.quality AS new_quality, CASE WHEN l.doc_id IS NULL THEN 'UNKNOWN_UNIT' WHEN i.doc_id IS NULL THEN 'MISSING'
  WHEN i.quality IS NULL THEN 'BLANK' WHEN i.quality = l.quality THEN 'UNCHANGED' ELSE 'CHANGED' END AS action FROM labels l FULL OUTER JOIN incoming i ON l.doc_id = i.doc_id"""


@query()
def snapshot_diff(d):
    return """WITH old AS (SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 3 <> 0), new AS (SELECT doc_id, quality, CASE WHEN doc_id % 8 = 0 THEN 1 - toxic ELSE toxic END AS toxic FROM labels WHERE doc_id % 4 <> 0)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN o.doc_id IS NULL THEN 'joined' WHEN n.doc_id IS NULL THEN 'left' WHEN o.quality = n.quality AND o.toxic = n.toxic THEN 'stayed' ELSE 'differs' END AS state
FROM old o FULL OUTER JOIN new n ON o.doc_id = n.doc_id) s GROUP BY state"""


@query()
def restore_plan(d):
    return """WITH backup AS (SELECT conv_id, turn, length(text) AS size FROM conversations WHERE turn % 2 = 0), live AS (SELECT conv_id, turn, length(text) AS size, role FROM conversations WHERE conv_id % 3 <> 0)
SELECT coalesce(b.conv_id, l.conv_id) AS conv_id, coalesce(b.turn, l.turn) AS turn, CASE WHEN l.conv_id IS NULL THEN 'write' WHEN b.conv_id IS NULL THEN 'kept' WHEN l.role = 'system' THEN 'refused' WHEN l.size = b.size THEN 'unchanged' ELSE 'replace' END AS action
FROM backup b FULL OUTER JOIN live l ON b.conv_id = l.conv_id AND b.turn = l.turn"""


@query()
def auto_accept(d):
    return """SELECT d.doc_id, d.lang FROM documents d LEFT ANTI JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars BETWEEN 500 AND 5000 AND d.lang IN ('en', 'de')""" if type(d).__name__ == "Spark" else """SELECT d.doc_id, d.lang FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars BETWEEN 500 AND 5000 AND d.lang IN ('en', 'de')"""


@query("tops")
def seam_partners(d):
    return f"""WITH e AS (SELECT id, x, y, h, cast(floor(x / 250e0) AS BIGINT) AS tile, cast(floor(x / 4e0) AS BIGINT) AS bx, cast(floor(y / 4e0) AS BIGINT) AS byy FROM tops WHERE x - floor(x / 250e0) * 250 < 4 OR x - floor(x / 250e0) * 250 >= 246),
l AS (SELECT id, x, y, tile, bx + dx AS bx, byy + dy AS byy FROM e CROSS JOIN {d.offsets([-1, 0, 1], 'dx')} a CROSS JOIN {d.offsets([-1, 0, 1], 'dy')} b),
p AS (SELECT l.id, e.id AS partner, (l.x - e.x) * (l.x - e.x) + (l.y - e.y) * (l.y - e.y) AS d2 FROM l JOIN e ON l.bx = e.bx AND l.byy = e.byy WHERE l.tile <> e.tile)
SELECT id, partner, d2 FROM (SELECT id, partner, d2, row_number() OVER (PARTITION BY id ORDER BY d2, partner) AS k FROM p WHERE d2 <= 16) t WHERE k = 1"""


# ----------------------------------------------------------------- aggregations


@query("pts", "chm")
def chm_cells(d):
    return "SELECT cx, cy, veg, bld, dtm, chm FROM chm"


@query("pts", "chm")
def canopy_cover_by_zone(d):
    return """SELECT cx % 4 AS zone, count(*) AS cells, count(chm) AS observed, sum(CASE WHEN chm >= 2 THEN 1 ELSE 0 END) AS canopy, 100e0 * count(chm) / count(*) AS coverage_pct,
  CASE WHEN count(chm) > 0 THEN 100e0 * sum(CASE WHEN chm >= 2 THEN 1 ELSE 0 END) / count(chm) END AS obs_canopy_pct,
  100e0 * sum(CASE WHEN chm >= 2 THEN 1 ELSE 0 END) / count(*) AS canopy_low_pct, 100e0 * sum(CASE WHEN chm >= 2 OR chm IS NULL THEN 1 ELSE 0 END) / count(*) AS canopy_high_pct,
  CASE WHEN count(chm) = count(*) THEN 'COMPLETE' WHEN count(chm) > 0 THEN 'PARTIAL' ELSE 'NO_DATA' END AS status FROM chm GROUP BY 1"""


@query("pts", "chm")
def height_summary_by_zone(d):
    return f"""SELECT cx % 5 AS zone, count(*) AS n, count(chm) AS supported, {d.median('chm')} AS p50, {d.pct('chm', '0.95e0')} AS p95, max(chm) AS top, sum(CASE WHEN veg < dtm THEN 1 ELSE 0 END) AS negative FROM chm GROUP BY 1"""


@query()
def height_comparison(d):
    return f"""WITH r AS (SELECT p_brand, p_type, l_extendedprice / l_quantity - p_retailprice AS diff FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT p_brand, count(*) AS n, {d.median('diff')} AS median_bias, {d.pct('abs(diff)', '0.9e0')} AS p90_abs, max(abs(diff)) AS worst FROM r GROUP BY p_brand"""


@query("pts")
def class_shares(d):
    return """SELECT l_suppkey, count(*) AS n, sum(CASE WHEN cls = 6 THEN 1 ELSE 0 END) AS n6, sum(CASE WHEN cls = 5 THEN 1 ELSE 0 END) AS nveg, sum(CASE WHEN cls = 6 THEN 1 ELSE 0 END) / (1e0 * count(*)) AS share6,
  sum(CASE WHEN cls = 5 THEN 1 ELSE 0 END) / (1e0 * count(*)) AS shareveg, sum(CASE WHEN cls NOT IN (5, 6) THEN 1 ELSE 0 END) AS nother, sum(CASE WHEN cls NOT IN (5, 6) THEN 1 ELSE 0 END) / (1e0 * count(*)) AS shareother FROM pts GROUP BY l_suppkey"""


@query("votes")
def votes_majority(d):
    return """WITH c AS (SELECT unit, code, count(*) AS n FROM votes GROUP BY 1, 2), m AS (SELECT unit, sum(n) AS total, max(n) AS top FROM c GROUP BY unit)
SELECT m.unit, CASE WHEN count(*) > 1 THEN 0 ELSE max(c.code) END AS code, 1e0 * max(m.top) / max(m.total) AS agreement, count(*) > 1 AS tied, 2 * max(m.top) > max(m.total) AS strict
FROM m JOIN c ON m.unit = c.unit AND c.n = m.top WHERE m.total >= 3 GROUP BY m.unit"""


@query("votes")
def consensus_roof(d):
    return "SELECT unit, sum(CASE WHEN code = 6 THEN 1 ELSE 0 END) AS yes, count(*) AS n, sum(CASE WHEN code = 6 THEN 1 ELSE 0 END) >= 2 AS roof FROM votes WHERE turn <= 3 GROUP BY unit"


@query("votes")
def pairwise_agreement(d):
    return "SELECT a.turn AS run_a, b.turn AS run_b, count(*) AS n, sum(CASE WHEN a.code = b.code THEN 1 ELSE 0 END) / (1e0 * count(*)) AS agreement FROM votes a JOIN votes b ON a.unit = b.unit AND a.turn < b.turn GROUP BY 1, 2"


@query("votes")
def crosstab(d):
    return "SELECT a.code AS before_code, b.code AS after_code, count(*) AS n, 1e0 * count(*) / sum(count(*)) OVER (PARTITION BY a.code) AS share FROM votes a JOIN votes b ON a.unit = b.unit AND a.turn = 1 AND b.turn = 2 GROUP BY a.code, b.code"


@query("pts")
def source_bitmask(d):
    return "SELECT cast(floor(x / 4e0) AS BIGINT) AS cx, cast(floor(y / 4e0) AS BIGINT) AS cy, bit_or(CASE cls WHEN 2 THEN 1 WHEN 5 THEN 2 ELSE 4 END) AS sources, count(DISTINCT cls) AS n_sources FROM pts GROUP BY 1, 2"


@query("pts")
def change_map(d):
    return """WITH a AS (SELECT cast(floor(x / 2e0) AS BIGINT) AS cx, cast(floor(y / 2e0) AS BIGINT) AS cy, max(CASE WHEN l_linenumber <= 3 AND z >= 30 THEN 1 ELSE 0 END) AS old, max(CASE WHEN l_linenumber > 3 AND z >= 30 THEN 1 ELSE 0 END) AS new FROM pts GROUP BY 1, 2)
SELECT CASE WHEN old = 1 AND new = 1 THEN 'both' WHEN old = 1 THEN 'lost' WHEN new = 1 THEN 'gained' ELSE 'neither' END AS change, count(*) AS cells FROM a GROUP BY 1"""


@query("pts")
def rule_funnel(d):
    return """SELECT count(*) AS eligible, sum(CASE WHEN z >= 10 THEN 1 ELSE 0 END) AS tall, sum(CASE WHEN z >= 10 AND rn = 1 THEN 1 ELSE 0 END) AS tall_first, sum(CASE WHEN z >= 10 AND rn = 1 AND flags = 0 THEN 1 ELSE 0 END) AS changed FROM pts WHERE cls = 5"""


@query("pts")
def scope_summaries(d):
    # one scan: the scopes' sums side by side, turned into rows at the end
    scopes = ["x >= 0", "x < 50", "y < 50", "x < 50 AND y < 50", "rn = 1", "x >= 25 AND x < 75"]
    sums = ", ".join(f"sum(CASE WHEN {s} THEN 1 ELSE 0 END) AS n{i}, sum(CASE WHEN {s} AND cls = 6 THEN 1 ELSE 0 END) AS m{i}, max(CASE WHEN {s} THEN z END) AS t{i}" for i, s in enumerate(scopes, 1))
    pick = lambda c: "CASE s.scope " + " ".join(f"WHEN {i} THEN {c}{i}" for i in range(1, 7)) + " END"
    return f"SELECT s.scope, {pick('n')} AS n, {pick('m')} AS n6, {pick('t')} AS top FROM (SELECT {sums} FROM pts) a CROSS JOIN {d.series(6, 'scope')} s"


@query("pts")
def block_density(d):
    return f"""WITH g AS (SELECT bx, byy FROM {d.series(10, 'bx')} a CROSS JOIN {d.series(10, 'byy')} b), n AS (SELECT cast(floor(x / 10e0) AS BIGINT) + 1 AS bx, cast(floor(y / 10e0) AS BIGINT) + 1 AS byy, count(*) AS n FROM pts GROUP BY 1, 2),
c AS (SELECT coalesce(n.n, 0) / 100e0 AS density FROM g LEFT JOIN n ON g.bx = n.bx AND g.byy = n.byy)
SELECT count(*) AS blocks, min(density) AS low, {d.pct('density', '0.1e0')} AS p10, {d.median('density')} AS p50, {d.pct('density', '0.9e0')} AS p90, max(density) AS high FROM c"""


@query("pts")
def pulse_groups(d):
    return "SELECT l_orderkey AS pulse, count(*) AS n, min(rn) AS least, max(rn) AS most, count(DISTINCT rn) AS numbers, count(DISTINCT rn) = max(rc) AS complete FROM pts GROUP BY l_orderkey"


@query("pts")
def thin_pulses(d):
    return f"SELECT pid, l_orderkey AS pulse FROM pts WHERE {d.hash32('concat(' + chr(39) + 'thin|' + chr(39) + ', ' + d.text('l_orderkey') + ')')} < 4294967296 * 0.25e0"


@query()
def flight_groups(d):
    return f"SELECT dates, count(*) AS customers, min(o_custkey) AS first_customer FROM (SELECT o_custkey, {d.joined(d.text('cast(o_orderdate AS DATE)'))} AS dates FROM orders GROUP BY o_custkey) t GROUP BY dates"


@query()
def acquisition_summary(d):
    return f"""SELECT o_orderstatus, count(*) AS swaths, count(DISTINCT o_orderdate) AS dates, {d.text('min(cast(o_orderdate AS DATE))')} AS first_date, {d.text('max(cast(o_orderdate AS DATE))')} AS last_date,
  max({d.days('o_orderdate', "DATE '1992-01-01'")}) AS last_day, {d.median('o_totalprice')} AS median_price FROM orders GROUP BY o_orderstatus"""


@query("tops")
def shift_field(d):
    return f"""WITH t AS (SELECT id, x, y, (id % 21 - 10) / 10e0 AS sx, cast(floor(x / 60e0) AS BIGINT) AS bx, cast(floor(y / 60e0) AS BIGINT) AS byy FROM tops WHERE event_type = 'click'),
l AS (SELECT id, x, y, bx + dx AS bx, byy + dy AS byy FROM t CROSS JOIN {d.offsets([-1, 0, 1], 'dx')} a CROSS JOIN {d.offsets([-1, 0, 1], 'dy')} b)
SELECT l.id, count(*) AS n, {d.median('t.sx')} AS shift FROM l JOIN t ON l.bx = t.bx AND l.byy = t.byy WHERE l.id <> t.id AND (l.x - t.x) * (l.x - t.x) + (l.y - t.y) * (l.y - t.y) <= 3600 GROUP BY l.id HAVING count(*) >= 5"""


@query("pts")
def best_shift(d):
    return f"""WITH a AS (SELECT DISTINCT cast(floor(x) AS BIGINT) AS cx, cast(floor(y) AS BIGINT) AS cy FROM pts WHERE cls = 6 AND z > 35), b AS (SELECT DISTINCT cast(floor(x) AS BIGINT) AS cx, cast(floor(y) AS BIGINT) AS cy FROM pts WHERE cls = 2 AND z > 35),
s AS (SELECT dx, dy, cx + dx AS cx, cy + dy AS cy FROM b CROSS JOIN {d.offsets([-2, -1, 0, 1, 2], 'dx')} p CROSS JOIN {d.offsets([-2, -1, 0, 1, 2], 'dy')} q)
SELECT dx, dy, count(*) AS shared, rank() OVER (ORDER BY count(*) DESC, abs(dx) + abs(dy), dx, dy) AS place FROM s JOIN a ON s.cx = a.cx AND s.cy = a.cy GROUP BY dx, dy"""


@query()
def weighted_percentiles(d):
    return """WITH w AS (SELECT p_brand, p_retailprice, p_size, sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS cum, sum(p_size) OVER (PARTITION BY p_brand) AS total FROM part)
SELECT p_brand, min(CASE WHEN 2 * cum >= total THEN p_retailprice END) AS median_price, min(CASE WHEN 10 * cum >= 9 * total THEN p_retailprice END) AS p90_price, max(total) AS weight FROM w GROUP BY p_brand"""


@query("units")
def auc_by_ranks(d):
    # ranks run over the different values, not over all rows
    return """WITH v AS (SELECT n_chars, count(*) AS n, sum(quality) AS k FROM units WHERE quality IS NOT NULL GROUP BY n_chars),
r AS (SELECT n, k, sum(n) OVER (ORDER BY n_chars) - n + (n + 1) / 2e0 AS r FROM v)
SELECT sum(k) AS positives, sum(n) - sum(k) AS negatives, (sum(k * r) - sum(k) * (sum(k) + 1) / 2e0) / (1e0 * sum(k) * (sum(n) - sum(k))) AS auc FROM r"""


@query("pts", "cells")
def block_reduce(d):
    return "SELECT cast(floor(cx / 10e0) AS BIGINT) AS bx, cast(floor(cy / 10e0) AS BIGINT) AS byy, sum(n) AS n, sum(n6) AS n6, count(*) AS cells FROM cells GROUP BY 1, 2"


@query("units")
def top_values(d):
    return "SELECT attribute, val, n FROM (SELECT attribute, val, n, row_number() OVER (PARTITION BY attribute ORDER BY n DESC, val) AS k FROM (SELECT 'lang' AS attribute, lang AS val, count(*) AS n FROM units GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM units GROUP BY source UNION ALL SELECT 'stratum', stratum, count(*) FROM units GROUP BY stratum) c WHERE n >= 30) t WHERE k <= 12"


# ----------------------------------------------------- windows, order and sets


@query("pts")
def highest_point_per_cell(d):
    return "SELECT cx, cy, pid, z FROM (SELECT cast(floor(x / 2e0) AS BIGINT) AS cx, cast(floor(y / 2e0) AS BIGINT) AS cy, pid, z, row_number() OVER (PARTITION BY floor(x / 2e0), floor(y / 2e0) ORDER BY z DESC, pid) AS k FROM pts) t WHERE k = 1"


@query("units")
def round_robin(d):
    return "SELECT doc_id, source, turn FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS turn FROM units) t WHERE turn <= 10"


@query()
def queue_next(d):
    return "SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role = 'user') t WHERE k = 1"


@query()
def last_answer_wins(d):
    return "SELECT conv_id, role, turn, length(text) AS size FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC) AS k FROM conversations) t WHERE k = 1"


@query()
def layer_cuts(d):
    return """WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) > 8 THEN 1 ELSE 0 END AS cut FROM lineitem),
g AS (SELECT *, sum(cut) OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS layer FROM s)
SELECT l_orderkey, layer, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high FROM g GROUP BY 1, 2"""


@query()
def dense_renumber(d):
    return """SELECT c_custkey, c.c_nationkey, label FROM customer c
JOIN (SELECT c_nationkey, row_number() OVER (ORDER BY c_nationkey) AS label FROM (SELECT DISTINCT c_nationkey FROM customer) v) k ON c.c_nationkey = k.c_nationkey"""


@query()
def first_wins_union(d):
    return """SELECT id, src FROM (SELECT id, src, row_number() OVER (PARTITION BY id ORDER BY src) AS k FROM (SELECT c_custkey % 700 AS id, 1 AS src FROM customer UNION ALL SELECT s_suppkey * 3 AS id, 2 AS src FROM supplier UNION ALL SELECT p_partkey % 900 AS id, 3 AS src FROM part) u) t WHERE k = 1"""


@query()
def id_set_comparison(d):
    return """SELECT CASE WHEN a.id IS NULL THEN 'extra' WHEN b.id IS NULL THEN 'missing' WHEN b.n > 1 THEN 'duplicate' ELSE 'same' END AS state, count(*) AS n FROM (SELECT DISTINCT c_custkey AS id FROM customer) a
FULL OUTER JOIN (SELECT o_custkey * 2 AS id, count(*) AS n FROM orders GROUP BY 1) b ON a.id = b.id GROUP BY 1"""


@query()
def set_operations(d):
    return """SELECT 'both' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') a
UNION ALL SELECT 'only_f', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') b
UNION ALL SELECT 'any', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') c"""


# ------------------------------------------------------------ grids and rasters


@query("pts", "cells", "near")
def binary_closing(d):
    grow = "SELECT DISTINCT cx + dx AS cx, cy + dy AS cy FROM {} CROSS JOIN near"
    return f"""WITH roof AS (SELECT cx, cy FROM cells WHERE 2 * n6 > n), big AS ({grow.format('roof')}),
kept AS (SELECT o.cx, o.cy FROM (SELECT cx + dx AS nx, cy + dy AS ny, cx, cy FROM big CROSS JOIN near) o JOIN big b ON o.nx = b.cx AND o.ny = b.cy GROUP BY o.cx, o.cy HAVING count(*) = 9)
SELECT k.cx, k.cy, r.cx IS NULL AS added FROM kept k LEFT JOIN roof r ON k.cx = r.cx AND k.cy = r.cy"""


@query("pts", "cells", "near")
def terrain_slope(d):
    return """SELECT c.cx, c.cy, (e.z - w.z) / 4e0 AS dzdx, (n.z - s.z) / 4e0 AS dzdy, sqrt(((e.z - w.z) / 4e0) * ((e.z - w.z) / 4e0) + ((n.z - s.z) / 4e0) * ((n.z - s.z) / 4e0)) AS slope FROM cells c
JOIN cells e ON e.cx = c.cx + 1 AND e.cy = c.cy JOIN cells w ON w.cx = c.cx - 1 AND w.cy = c.cy JOIN cells n ON n.cx = c.cx AND n.cy = c.cy + 1 JOIN cells s ON s.cx = c.cx AND s.cy = c.cy - 1"""


@query("pts", "cells")
def map_algebra(d):
    return "SELECT cx, cy, CASE WHEN 2 * n6 > n THEN NULL WHEN z >= 30 THEN 3 WHEN z >= 15 THEN 2 ELSE 1 END AS band, z IS NULL AS empty, nullif(n6, 0) AS n6 FROM cells"


@query("pts")
def height_bands_pct(d):
    return "SELECT cls, sum(CASE WHEN z < 10 THEN 1 ELSE 0 END) * 100e0 / count(*) AS low_pct, sum(CASE WHEN z >= 10 AND z < 30 THEN 1 ELSE 0 END) * 100e0 / count(*) AS mid_pct, sum(CASE WHEN z >= 30 THEN 1 ELSE 0 END) * 100e0 / count(*) AS high_pct FROM pts GROUP BY cls"


@query("pts", "cells", "near")
def neighbourhood_complete(d):
    return "SELECT o.cx, o.cy, count(c.cx) = 9 AS complete FROM (SELECT cx + dx AS nx, cy + dy AS ny, cx, cy FROM cells CROSS JOIN near) o LEFT JOIN cells c ON o.nx = c.cx AND o.ny = c.cy GROUP BY o.cx, o.cy"


# ---------------------------------------------------------- points and features


@query("pts")
def patch_covariance(d):
    # coordinates are quarters, so n * sum(uv) - sum(u) * sum(v) is exact
    u, v = "cast(x * 4 AS BIGINT)", "cast(y * 4 AS BIGINT)"
    w = "cast(z AS BIGINT)"
    cov = lambda a, b: f"count(*) * sum({a} * {b}) - sum({a}) * sum({b})"
    return f"""SELECT cast(floor(x / 5e0) AS BIGINT) AS bx, cast(floor(y / 5e0) AS BIGINT) AS byy, count(*) AS n, {cov(u, u)} AS vx, {cov(v, v)} AS vy, {cov(w, w)} AS vz,
  {cov(u, v)} AS cxy, {cov(u, w)} AS cxz FROM pts GROUP BY 1, 2 HAVING count(*) >= 4"""


@query("pts")
def ground_relief(d):
    return """WITH g AS (SELECT cast(floor(x / 4e0) AS BIGINT) AS cx, cast(floor(y / 4e0) AS BIGINT) AS cy, min(z) AS g FROM pts WHERE cls = 2 GROUP BY 1, 2)
SELECT cx % 5 AS bx, cy % 5 AS byy, max(g) - min(g) AS relief, count(*) AS cells FROM g GROUP BY 1, 2"""


@query("parcels")
def ring_area(d):
    return "SELECT pid, (x1 - x0) * (y1 - y0) AS area, 2 * (x1 - x0 + y1 - y0) AS perimeter, least(x1 - x0, y1 - y0) AS width, greatest(x1 - x0, y1 - y0) AS length FROM parcels"


# ------------------------------------------------------ sampling and estimation


@query("units")
def stratified_totals(d):
    return "SELECT stratum, count(*) AS population, count(quality) AS sampled, sum(quality) AS successes, 1e0 * count(*) * sum(quality) / count(quality) AS total, count(quality) < 5 AS unstable FROM units GROUP BY stratum"


@query("units")
def wilson_by_stratum(d):
    return """SELECT stratum, n, k, greatest(0e0, (p + 1.9207294e0 / n - 1.959964e0 * sqrt(p * (1 - p) / n + 0.9603647e0 / (1e0 * n * n))) / (1 + 3.8414588e0 / n)) AS low,
  least(1e0, (p + 1.9207294e0 / n + 1.959964e0 * sqrt(p * (1 - p) / n + 0.9603647e0 / (1e0 * n * n))) / (1 + 3.8414588e0 / n)) AS high FROM (SELECT stratum, count(quality) AS n, sum(quality) AS k, sum(quality) / (1e0 * count(quality)) AS p FROM units WHERE quality IS NOT NULL GROUP BY stratum) t"""


@query("units")
def hash_sample(d):
    h = d.hash32("concat('seed7|', " + d.text("doc_id") + ")")
    return f"SELECT doc_id, stratum FROM (SELECT doc_id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY {h}, doc_id) AS k FROM units) t WHERE k <= 20"


@query("units")
def score_treetops(d):
    return """SELECT source, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1 ELSE 0 END) AS fn,
  CASE WHEN sum(quality) > 0 THEN sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) / (1e0 * sum(quality)) END AS prec FROM units GROUP BY source"""


@query("units")
def score_cells(d):
    return "SELECT lang, count(*) AS cells, sum(CASE WHEN quality = 0 THEN n_chars ELSE 0 END) AS commission, sum(CASE WHEN toxic = 1 THEN n_chars ELSE 0 END) AS omission, sum(CASE WHEN quality = 0 THEN n_chars ELSE 0 END) - sum(CASE WHEN toxic = 1 THEN n_chars ELSE 0 END) AS bias FROM units GROUP BY lang"


@query("units")
def projection(d):
    return "WITH s AS (SELECT stratum, count(*) AS pop, count(quality) AS n, 1 - sum(quality) / (1e0 * count(quality)) AS share FROM units GROUP BY stratum) SELECT sum(pop) AS population, sum(n) AS labelled, sum(pop * share) AS projected, sum(CASE WHEN n >= 30 THEN pop ELSE 0 END) AS covered FROM s"


@query("units")
def block_split(d):
    h = d.hash32("concat('block|', source)")
    return f"SELECT source, CASE WHEN row_number() OVER (ORDER BY {h}, source) <= 4 THEN 'VALIDATION' ELSE 'TRAINING' END AS split, n FROM (SELECT source, count(*) AS n FROM units GROUP BY source) t"


# ----------------------------------------------------------------- rule engines


@query("votes")
def product_policy(d):
    return """SELECT unit, CASE WHEN noise > 0 THEN 7 WHEN ground = n THEN 2 WHEN tree > 0 AND bld > 0 THEN 1 WHEN tree > 0 THEN 5 WHEN bld > 0 THEN 6 ELSE 0 END AS product FROM (SELECT unit, count(*) AS n, sum(CASE WHEN unit % 50 = 0 AND turn = 1 THEN 1 ELSE 0 END) AS noise,
  sum(CASE WHEN code = 2 THEN 1 ELSE 0 END) AS ground, sum(CASE WHEN code = 5 THEN 1 ELSE 0 END) AS tree, sum(CASE WHEN code = 6 THEN 1 ELSE 0 END) AS bld FROM votes GROUP BY unit) t"""


@query("units")
def decision_precedence(d):
    return """SELECT doc_id, coalesce(CASE WHEN toxic = 1 THEN 'human' END, CASE WHEN quality = 0 THEN 'rule' END, CASE WHEN n_chars < 500 THEN 'group' END, 'unchecked') AS decided_by, CASE WHEN toxic = 1 OR quality = 0 THEN 'DROP' ELSE 'KEEP' END AS decision FROM units"""


# --------------------------------------------------- constraints and provenance


@query()
def referential_checks(d):
    return """SELECT 'orphan_lines' AS rule, count(*) AS broken FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL
UNION ALL SELECT 'orphan_orders', count(*) FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_custkey IS NULL
UNION ALL SELECT 'duplicate_lines', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) d
UNION ALL SELECT 'bad_discount', count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 1"""


@query()
def table_digest(d):
    h = d.hash32("concat(" + d.text("o_orderkey") + ", '|', o_orderstatus, '|', o_orderpriority)")
    return f"SELECT o_orderstatus, count(*) AS n, sum({h}) AS digest, min({h}) AS least, max({h}) AS most FROM orders GROUP BY o_orderstatus"


@query("pts", "chm")
def raster_equality(d):
    return """WITH a AS (SELECT cx, cy, chm FROM chm WHERE cx % 7 <> 0), b AS (SELECT cx, cy, CASE WHEN cy % 9 = 0 THEN chm + 1 ELSE chm END AS chm FROM chm WHERE cx % 5 <> 0)
SELECT sum(CASE WHEN a.cx IS NOT NULL AND b.cx IS NOT NULL THEN 1 ELSE 0 END) AS both_cells, sum(CASE WHEN b.cx IS NULL THEN 1 ELSE 0 END) AS only_left, sum(CASE WHEN a.cx IS NULL THEN 1 ELSE 0 END) AS only_right,
  sum(CASE WHEN abs(a.chm - b.chm) > 0.001e0 THEN 1 ELSE 0 END) AS differ, max(abs(a.chm - b.chm)) AS most FROM a FULL OUTER JOIN b ON a.cx = b.cx AND a.cy = b.cy"""


# ------------------------------------------------------------ event-time windows


@query()
def tumbling_counts(d):
    return f"SELECT cast(floor({d.seconds('ts')} / 3600e0) AS BIGINT) AS hour, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2"


@query()
def sliding_counts(d):
    return f"SELECT cast(floor({d.seconds('ts')} / 1800e0) AS BIGINT) - o AS slot, count(*) AS n FROM events CROSS JOIN {d.offsets([0, 1], 'o')} q GROUP BY 1"


@query()
def session_counts(d):
    return f"""WITH g AS (SELECT user_id, s, sum(new) OVER (PARTITION BY user_id ORDER BY s, event_id) AS session FROM (SELECT user_id, event_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s, event_id) <= 7200 THEN 0 ELSE 1 END AS new
  FROM (SELECT user_id, event_id, {d.seconds('ts')} AS s FROM events) e) l)
SELECT user_id, session, count(*) AS n, min(s) AS first_s, max(s) - min(s) AS length_s FROM g GROUP BY user_id, session"""


@query()
def dedup_first_event(d):
    return f"SELECT user_id, event_type, event_id FROM (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type, cast(floor({d.seconds('ts')} / 86400e0) AS BIGINT) ORDER BY ts, event_id) AS k FROM events) t WHERE k = 1"
