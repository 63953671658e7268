"""Queries on files, tiles, samples, answers and point evidence, with reference SQL
where the operator has one; draws by hash and eigenvalues are held in the tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.operators import reviews as V, surfaces as S, tiles as T
from gridloom.plans.dialect import DuckDB, Spark
from gridloom.plans.relations import with_relations
from gridloom.plans.staging import shared_dir
from gridloom.sources import las

c = F.col
_POINTS = "SELECT x, y, z, cast(cls AS INT) AS classification, cast(rn AS INT) AS return_number, cast(rc AS INT) AS return_count, cast(flags AS INT) AS flags FROM pts"
_ANSWERS = """SELECT o_orderkey AS id, CASE o_custkey % 6 WHEN 0 THEN ' tree' WHEN 1 THEN 'ROOF' WHEN 2 THEN 'MAYBE' WHEN 3 THEN NULL ELSE 'GROUND' END AS label,
  CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN repeat('x', 70) ELSE ' ab ' END AS reviewer, CASE WHEN o_custkey % 11 = 0 THEN repeat('n', 501) WHEN o_custkey % 3 = 0 THEN 'seen' END AS note,
  CASE o_orderkey % 7 WHEN 0 THEN '2026-02-30' WHEN 1 THEN '2099-01-01' WHEN 2 THEN NULL ELSE '2026-03-04' END AS date FROM orders"""
_UNITS = "SELECT o_orderkey AS id FROM orders WHERE o_custkey % 13 > 0"
_GROUPS = "SELECT o_orderkey AS id, o_orderpriority AS kind, CASE o_custkey % 3 WHEN 0 THEN 'waiting' WHEN 1 THEN 'rule' ELSE 'person' END AS by, CASE WHEN o_custkey % 3 > 0 THEN 'OLD' END AS decision FROM orders"
_VOTES = """SELECT cast(CASE WHEN o_orderkey % 10 = 0 THEN 0 WHEN o_orderkey % 10 = 1 THEN 99 ELSE 5 END AS INT) AS code, CASE WHEN o_custkey % 17 = 0 THEN 0.5e0 ELSE (o_custkey % 3 + 1) / 3e0 END AS agreement,
  o_orderkey % 10 = 0 AS tied, (o_custkey % 3 > 0) AS strict FROM orders"""
_CUES = """SELECT o_orderkey AS id, (o_custkey % 90) / 10e0 AS h, (o_orderkey % 200) / 10e0 AS w, (o_custkey % 120) * 1e0 AS area, (o_orderkey % 60) * 1e0 AS roof, (o_custkey % 40) * 1e0 AS shed, o_orderkey % 23 = 0 AS trunk, o_custkey % 9 AS tops,
  CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 50) / 10e0 END AS relief, CASE o_custkey % 6 WHEN 0 THEN 'JOINS' WHEN 1 THEN 'RESHAPED' WHEN 2 THEN 'SPLITS' WHEN 3 THEN 'TANGLE' WHEN 4 THEN 'LEFT_ONLY' ELSE 'RIGHT_ONLY' END AS kind,
  o_orderkey % 5 = 0 AS vehicle, cast(o_orderkey % 21 AS INT) AS base, cast(CASE WHEN o_custkey % 3 = 0 THEN 5 ELSE 0 END AS INT) AS tree, cast(CASE WHEN o_orderkey % 4 = 0 THEN 6 ELSE 0 END AS INT) AS building FROM orders"""
_PATCHES = "SELECT event_id AS id, ((event_id * 37 + user_id * 11) % 400) * 0.25e0 AS ux, ((event_id * 53 + user_id * 29) % 400) * 0.25e0 AS uy, 5e0 AS z_low, 45e0 AS z_high, 1e0 AS radius, 2e0 AS ground_z FROM events WHERE event_type = 'click'"
_TOPS = "SELECT event_id AS id, ((event_id * 37 + user_id * 11) % 400) * 0.25e0 AS x, ((event_id * 53 + user_id * 29) % 400) * 0.25e0 AS y, abs(value) AS h FROM events WHERE event_type = 'signup'"


def _read(spark: SparkSession, sf_dir: str, text: str, names: tuple = ()) -> DataFrame:
    from gridloom.plans.catalog import run_sql

    return run_sql(spark, sf_dir, with_relations(text, list(names), Spark()))


def _points(spark, sf_dir) -> DataFrame:
    d = _read(spark, sf_dir, _POINTS, ("pts",))
    return d.select(*[c(n).cast("double").alias(n) for n in "xyz"], "classification", "return_number", "return_count", "flags")


def _las(spark, sf_dir) -> str:
    las.register(spark)
    path = f"{shared_dir(spark)}/las-{uuid.uuid4().hex}"
    _points(spark, sf_dir).write.format("las").option("scale", "0.01").option("wkt", "LOCAL_CS[\"grid\"]").mode("append").save(path)
    return path


def las_round_trip(spark, sf_dir):
    read = spark.read.format("las").load(_las(spark, sf_dir))
    return read.select(F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), F.round("z", 2).alias("z"), "classification", "return_number", "return_count", "flags")


def las_headers(spark, sf_dir):
    heads = spark.read.format("las").option("part", "headers").load(_las(spark, sf_dir))
    near = lambda how, name: F.round(how(name), 2).alias(name)
    return heads.groupBy("version", "format", "wkt").agg(F.sum("points").alias("points"), near(F.min, "xmin"), near(F.max, "xmax"), near(F.min, "zmin"), near(F.max, "zmax"))


def las_pushed_filter(spark, sf_dir):
    read = spark.read.format("las").load(_las(spark, sf_dir)).where("z > 40 and classification = 6 and x < 60")
    return read.groupBy("return_number").agg(F.count("*").alias("n"), F.round(F.min("z"), 2).alias("low"))


def las_recode(spark, sf_dir):
    path = _las(spark, sf_dir)
    points = spark.read.format("las").load(path)
    changes = points.where("classification = 5 and z > 40 and return_number = 1").select("file", "point_index", F.lit(6).alias("classification"))
    done = las.rewrite(points.select("file").distinct(), changes, path + "-new", ["classification"]).agg(F.sum("changed").alias("changed")).first()
    return spark.read.format("las").load(path + "-new").groupBy("classification").agg(F.count("*").alias("n")).withColumn("changed", F.lit(done.changed))


def las_inventory_files(spark, sf_dir):
    found = las.inventory(spark, _las(spark, sf_dir))
    return found.select(F.explode("classes").alias("classification", "n")).groupBy("classification").agg(F.sum("n").alias("n"))


def tile_cores(spark, sf_dir):
    tiles = T.tile_grid(spark, T.Extent(3.0, 1.0, 98.0, 93.0), 20.0, 4.0)
    return T.owning_tile(_points(spark, sf_dir).select("x", "y"), tiles, 20.0).groupBy("name").agg(F.count("*").alias("n"))


def tile_halos(spark, sf_dir):
    return T.tile_neighbours(T.tile_grid(spark, T.Extent(0.0, 0.0, 100.0, 60.0), 20.0, 4.0), 4.0, 20.0)


def edge_strips(spark, sf_dir):
    return T.edge_strip(_points(spark, sf_dir), T.Extent(0.0, 0.0, 100.0, 100.0), 5.0).groupBy("classification").agg(F.count("*").alias("n"))


def scope_rows(spark, sf_dir):
    rows = _read(spark, sf_dir, "SELECT s_name AS tile, s_nationkey AS k FROM supplier")
    return T.scopes(rows, {"pilot": ["Supplier#000000001", "Supplier#000000004"], "all": [f"Supplier#{i:09d}" for i in range(1, 9)]}).groupBy("scope").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


def answer_checks(spark, sf_dir):
    return V.checked_answers(_read(spark, sf_dir, _ANSWERS), _read(spark, sf_dir, _UNITS), ["TREE", "ROOF", "GROUND"], "2026-11-26").select("id", "label", "reviewer", "note", "problem")


def decision_merge(spark, sf_dir):
    groups = _read(spark, sf_dir, _GROUPS)
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    answers = groups.where("id % 7 = 0").select("id", F.lit("ANSWERED").alias("decision"))
    return V.merged_decisions(groups, answers, table([("1-URGENT", "RULED")], "kind string, decision string"), table([("2-HIGH", "CALLED")], "kind string, decision string"), table([("3-MEDIUM",)], "kind string"))


def vote_problems(spark, sf_dir):
    return V.consensus_problems(_read(spark, sf_dir, _VOTES), 3, [1, 2, 5, 6])


def pass_spreads(spark, sf_dir):
    return V.pass_spread(_read(spark, sf_dir, "SELECT s_nationkey AS tile, (s_suppkey % 10) / 200e0 AS agreement FROM supplier"))


def flag_drop(spark, sf_dir):
    rows = _read(spark, sf_dir, "SELECT o_orderkey AS id FROM orders")
    return V.flagged_out(rows, _read(spark, sf_dir, "SELECT o_orderkey AS id, o_orderstatus AS flag FROM orders"), ["F", "P"])


def cue_flags(spark, sf_dir):
    args = [c(n) for n in ("h", "w", "area", "roof", "shed", "trunk", "tops", "relief")]
    rows = _read(spark, sf_dir, _CUES)
    products = [V.product_class(c("base"), c("tree"), c("building"), p, 70).cast("int").alias(p.replace("-", "_")) for p in ("tree-wins", "building-wins", "conflict-class")]
    return rows.select("id", V.tree_cues(*args).alias("flags"), V.rule_group(c("kind"), c("roof"), c("vehicle"), c("area")).alias("grp"), *products)


def patch_heights(spark, sf_dir):
    return S.patch_statistics(_read(spark, sf_dir, _PATCHES), _points(spark, sf_dir), 8.0)


def patch_votes(spark, sf_dir):
    points = _points(spark, sf_dir).withColumn("code", F.when(c("return_number") == 3, F.lit(0)).otherwise(c("classification")))
    return S.patch_votes(_read(spark, sf_dir, _PATCHES), points, {5: "VEGETATION", 6: "BUILDING", 2: "GROUND"}, 8.0)


def ground_rings(spark, sf_dir):
    places = _read(spark, sf_dir, "SELECT event_id AS pid, ((event_id * 37 + user_id * 11) % 480) * 0.25e0 - 8 AS x, ((event_id * 53 + user_id * 29) % 480) * 0.25e0 - 8 AS y FROM events")
    return S.ground_at(places, _points(spark, sf_dir).where("classification = 2 and z < 4"), 1.0, 3)


def evidence_measures(spark, sf_dir):
    points = _points(spark, sf_dir).select("x", "y", "z", c("classification").alias("cls"), c("return_number").alias("number"), c("return_count").alias("count")).distinct()
    found = S.treetop_measures(_read(spark, sf_dir, _TOPS), points, 25.0)
    return found.select("id", "n_building_1m", "n_top", "ctx_n", "building_dist_m", "ground_z", "roof_hag_m", "above_roof_m", "top_hag_m", "top_nonlast")


def review_places(spark, sf_dir):
    units = _read(spark, sf_dir, "SELECT o_orderkey AS id, o_orderpriority AS stratum FROM orders")
    placed = V.review_order(V.draw(units, "id", 1000, 7, ["stratum"]), 7)
    # every place once, and either batch in one run
    return placed.groupBy("batch").agg(F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("last"), F.countDistinct("place").alias("places"))


def spaced_units(spark, sf_dir):
    units = _read(spark, sf_dir, "SELECT event_id AS id, ((event_id * 37 + user_id * 11) % 2000) * 0.5e0 AS x, ((event_id * 53 + user_id * 29) % 2000) * 0.5e0 AS y, user_id AS rank FROM events WHERE event_type = 'signup'")
    return V.spaced(units, 12.0, ["rank"]).select("id")


def shape_evidence(spark, sf_dir):
    points = _points(spark, sf_dir).distinct().withColumn("pid", F.xxhash64("x", "y", "z", "classification", "return_number", "return_count", "flags"))
    rows = points.select("pid", "x", "y", "z", (c("return_number") == 1).alias("single"), (c("classification") == 6).alias("building"))
    return S.neighbourhood_shapes(rows, 16, 3.0, 1.0, 25.0)


def queries() -> dict:
    return {f.__name__: f for f in (
        las_round_trip, las_headers, las_pushed_filter, las_recode, las_inventory_files, tile_cores, tile_halos, edge_strips, scope_rows, answer_checks, decision_merge, vote_problems, pass_spreads, flag_drop, cue_flags,
        patch_heights, patch_votes, ground_rings, evidence_measures, review_places, spaced_units, shape_evidence,
    )}


def oracle_sql() -> dict[str, str]:
    d = DuckDB()
    on = lambda body: with_relations(f"WITH p AS ({_POINTS}), {body}", ["pts"], d)
    in_patch = "FROM u LEFT JOIN p ON x BETWEEN ux - 1 AND ux + 1 AND y BETWEEN uy - 1 AND uy + 1 AND sqrt(power(x - ux, 2) + power(y - uy, 2)) <= 1 AND z BETWEEN 5 AND 45"
    near = lambda r: f"p.x BETWEEN t.x - {r} AND t.x + {r} AND p.y BETWEEN t.y - {r} AND t.y + {r} AND sqrt(power(p.x - t.x, 2) + power(p.y - t.y, 2)) <= {r}"
    return {
        "las_round_trip": on("q AS (SELECT * FROM p) SELECT round(x, 2) AS x, round(y, 2) AS y, round(z, 2) AS z, classification, return_number, return_count, flags FROM q"),
        "las_headers": on("q AS (SELECT * FROM p) SELECT '1.4' AS version, 6 AS format, 'LOCAL_CS[\"grid\"]' AS wkt, count(*) AS points, min(x) AS xmin, max(x) AS xmax, min(z) AS zmin, max(z) AS zmax FROM q"),
        "las_pushed_filter": on("q AS (SELECT * FROM p WHERE z > 40 AND classification = 6 AND x < 60) SELECT return_number, count(*) AS n, min(z) AS low FROM q GROUP BY 1"),
        "las_recode": on("q AS (SELECT *, classification = 5 AND z > 40 AND return_number = 1 AS ch FROM p) SELECT CASE WHEN ch THEN 6 ELSE classification END AS classification, count(*) AS n, (SELECT sum(ch::INT) FROM q) AS changed FROM q GROUP BY 1"),
        "las_inventory_files": on("q AS (SELECT * FROM p) SELECT classification, count(*) AS n FROM q GROUP BY 1"),
        "tile_cores": on("q AS (SELECT *, cast(floor((x - 3) / 20) AS INT) AS tc, cast(floor((y - 1) / 20) AS INT) AS tr, x >= 3 AND x < 98 AND y >= 1 AND y < 93 AS inn FROM p) SELECT CASE WHEN inn THEN 'r' || lpad(cast(tr AS VARCHAR), 3, '0') || 'c' || lpad(cast(tc AS VARCHAR), 3, '0') END AS name, count(*) AS n FROM q GROUP BY 1"),
        "tile_halos": "WITH t AS (SELECT r, k, printf('r%03dc%03d', r, k) AS name FROM range(3) a(r), range(5) b(k)) SELECT a.name, b.name AS neighbour FROM t a JOIN t b ON abs(a.r - b.r) <= 1 AND abs(a.k - b.k) <= 1 AND a.name <> b.name",
        "edge_strips": on("q AS (SELECT * FROM p WHERE x < 5 OR x > 95 OR y < 5 OR y > 95) SELECT classification, count(*) AS n FROM q GROUP BY 1"),
        "scope_rows": "WITH s AS (SELECT s_name AS tile, s_nationkey AS k FROM supplier), u AS (SELECT tile AS scope, k FROM s UNION ALL SELECT 'pilot', k FROM s WHERE tile IN ('Supplier#000000001', 'Supplier#000000004') UNION ALL SELECT 'all', k FROM s WHERE tile BETWEEN 'Supplier#000000001' AND 'Supplier#000000008') SELECT scope, count(*) AS n, sum(k) AS k FROM u GROUP BY scope",
        "answer_checks": f"""WITH a AS ({_ANSWERS}), u AS ({_UNITS}), k AS (SELECT a.*, u.id IS NOT NULL AS known, upper(trim(coalesce(label, ''))) AS l, trim(reviewer) AS r FROM a LEFT JOIN u ON a.id = u.id)
            SELECT id, l AS label, r AS reviewer, note, CASE WHEN NOT known THEN 'unknown unit' WHEN l NOT IN ('TREE', 'ROOF', 'GROUND') THEN 'label is not in the domain' WHEN length(r) NOT BETWEEN 1 AND 64 THEN 'reviewer' WHEN length(note) > 500 THEN 'note'
            WHEN try_cast(date AS DATE) IS NULL THEN 'date' WHEN try_cast(date AS DATE) > DATE '2026-11-27' THEN 'date in the future' ELSE '' END AS problem FROM k""",
        "decision_merge": f"""WITH g AS ({_GROUPS.replace(" AS by,", " AS \"by\",")}) SELECT id, kind, CASE WHEN id % 7 = 0 AND "by" <> 'person' THEN 'person' WHEN "by" = 'waiting' AND kind = '1-URGENT' THEN 'rule' WHEN "by" = 'rule' AND kind = '2-HIGH' THEN 'call' WHEN "by" = 'rule' AND kind = '3-MEDIUM' THEN 'waiting' ELSE "by" END AS "by",
            CASE WHEN id % 7 = 0 AND "by" <> 'person' THEN 'ANSWERED' WHEN "by" = 'waiting' AND kind = '1-URGENT' THEN 'RULED' WHEN "by" = 'rule' AND kind = '2-HIGH' THEN 'CALLED' WHEN "by" = 'rule' AND kind = '3-MEDIUM' THEN NULL ELSE decision END AS decision FROM g""",
        "vote_problems": f"""WITH v AS ({_VOTES}) SELECT sum((code NOT IN (0, 1, 2, 5, 6))::INT) AS unknown_code, sum((agreement < 0.333 OR agreement > 1)::INT) AS agreement_range, sum((abs(agreement * 3 - round(agreement * 3)) > 1e-5)::INT) AS not_a_count, sum(((code = 0) <> tied)::INT) AS code_0_not_tie,
            sum(((agreement > 0.5 AND NOT tied) <> strict)::INT) AS strict_flag, sum((tied AND agreement > 0.5)::INT) AS tie_with_majority FROM v""",
        "pass_spreads": "SELECT s_nationkey AS tile, (max(s_suppkey % 10) - min(s_suppkey % 10)) / 200.0 AS spread, max((s_suppkey % 10) / 200e0) - min((s_suppkey % 10) / 200e0) <= 0.02 AS even FROM supplier GROUP BY 1",
        "flag_drop": "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O'",
        "cue_flags": f"""WITH i AS ({_CUES}) SELECT id, concat_ws(';', CASE WHEN h < 3 THEN 'SHRUB_LIKE' END, CASE WHEN h < 6 AND area >= 40 AND h * 2 < w THEN 'BRUSH_LIKE' END, CASE WHEN roof >= 25 OR shed >= 25 OR trunk THEN 'ROOF_OR_SHED' END, CASE WHEN tops > 5 OR w > 15 THEN 'MERGED_LIKE' END, CASE WHEN relief >= 3 THEN 'STEEP_GROUND' END) AS flags,
            CASE kind WHEN 'JOINS' THEN 'joins_wait' WHEN 'RESHAPED' THEN (CASE WHEN roof >= 30 THEN 'auto_reshaped_trees' WHEN roof >= 10 THEN 'decide_reshaped' ELSE 'auto_reshaped_lidar' END) WHEN 'SPLITS' THEN 'auto_splits' WHEN 'TANGLE' THEN 'tangle_wait'
            WHEN 'LEFT_ONLY' THEN (CASE WHEN roof >= 30 THEN 'auto_county_kept' ELSE 'auto_county_gone' END) ELSE (CASE WHEN vehicle THEN 'auto_vehicles' WHEN area < 20 THEN 'small_rest' ELSE 'auto_lidar_only' END) END AS grp,
            CASE WHEN base IN (2, 7, 18) THEN base WHEN tree = 5 THEN 5 WHEN building = 6 THEN 6 ELSE 0 END AS tree_wins, CASE WHEN base IN (2, 7, 18) THEN base WHEN building = 6 THEN 6 WHEN tree = 5 THEN 5 ELSE 0 END AS building_wins,
            CASE WHEN base IN (2, 7, 18) THEN base WHEN tree = 5 AND building = 6 THEN 70 WHEN tree = 5 THEN 5 WHEN building = 6 THEN 6 ELSE 0 END AS conflict_class FROM i""",
        "patch_heights": on(f"u AS ({_PATCHES}) SELECT id, count(z) AS n, min(z - ground_z) AS low, avg(z - ground_z) AS mean, max(z - ground_z) AS high {in_patch} GROUP BY id"),
        "patch_votes": on(f"u AS ({_PATCHES}), f AS (SELECT id, CASE WHEN return_number = 3 THEN 'ABSTAIN' WHEN classification = 5 THEN 'VEGETATION' WHEN classification = 6 THEN 'BUILDING' ELSE 'GROUND' END AS fam, count(*) AS n {in_patch} WHERE z IS NOT NULL GROUP BY ALL) SELECT id, sum(n) AS points, coalesce(sum(n) FILTER (fam = 'ABSTAIN'), 0) AS abstain, CASE WHEN max(n) * 2 > sum(n) AND arg_max(fam, n) <> 'ABSTAIN' THEN arg_max(fam, n) END AS family FROM f GROUP BY id"),
        "ground_rings": on("""q AS (SELECT event_id AS pid, floor(((event_id * 37 + user_id * 11) % 480) * 0.25e0 - 8) AS cx, floor(((event_id * 53 + user_id * 29) % 480) * 0.25e0 - 8) AS cy FROM events), g AS (SELECT floor(x) AS gx, floor(y) AS gy, min(z) AS g FROM p WHERE classification = 2 AND z < 4 GROUP BY ALL),
            m AS (SELECT pid, greatest(abs(gx - cx), abs(gy - cy)) AS ring, g FROM q JOIN g ON abs(gx - cx) <= 3 AND abs(gy - cy) <= 3), b AS (SELECT pid, g, row_number() OVER (PARTITION BY pid ORDER BY ring, g) AS n FROM m) SELECT q.pid, b.g AS ground FROM q LEFT JOIN b ON q.pid = b.pid AND n = 1"""),
        "evidence_measures": with_relations(f"""WITH p AS (SELECT DISTINCT x, y, z, cls, rn, rc FROM pts), t AS ({_TOPS}), g AS (SELECT t.id, median(z) AS ground_z FROM t JOIN p ON {near(5)} AND cls = 2 GROUP BY t.id),
            b AS (SELECT t.id, min(sqrt(power(p.x - t.x, 2) + power(p.y - t.y, 2))) AS d FROM t JOIN p ON {near(5)} AND cls = 6 GROUP BY t.id), b1 AS (SELECT t.id, count(*) AS n, quantile_cont(z, 0.9) AS z90 FROM t JOIN p ON {near(1)} AND cls = 6 GROUP BY t.id),
            o AS (SELECT t.id, z, rn, rc, max(z) OVER (PARTITION BY t.id) AS zmax FROM t JOIN p ON {near(1)} AND cls <> 2), tp AS (SELECT id, count(*) AS n, any_value(zmax) AS zmax, avg((rn < rc)::INT) AS nonlast FROM o WHERE z >= zmax - 1 GROUP BY id),
            cx AS (SELECT t.id, count(*) AS n FROM t JOIN g ON g.id = t.id JOIN p ON {near(3)} AND cls <> 2 AND z - ground_z >= 0.3 GROUP BY t.id)
            SELECT t.id, coalesce(b1.n, 0) AS n_building_1m, coalesce(tp.n, 0) AS n_top, coalesce(cx.n, 0) AS ctx_n, b.d AS building_dist_m, ground_z, z90 - ground_z AS roof_hag_m, h - (z90 - ground_z) AS above_roof_m, zmax - ground_z AS top_hag_m, nonlast AS top_nonlast
            FROM t LEFT JOIN g ON g.id = t.id LEFT JOIN b ON b.id = t.id LEFT JOIN b1 ON b1.id = t.id LEFT JOIN tp ON tp.id = t.id LEFT JOIN cx ON cx.id = t.id""", ["pts"], d),
        "review_places": "WITH s AS (SELECT least(count(*), 1000) AS n FROM orders GROUP BY o_orderpriority), b AS (SELECT cast(sum(ceil(n / 2)) AS BIGINT) AS one, cast(sum(n) AS BIGINT) AS every FROM s) SELECT 1 AS batch, one AS n, 1 AS first, one AS last, one AS places FROM b UNION ALL SELECT 2, every - one, one + 1, every, every - one FROM b",
    }
