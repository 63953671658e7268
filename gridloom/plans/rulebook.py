"""Queries that apply rule tables and name rules to rows of the driver's tables.

Each entry has the SQL of its input rows (integer arithmetic, so that all
branches occur and both engines agree), the operator applied to them, and the
rule once more as SQL of the reference engine, written from the rule itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from gridloom.functions import names, rules
from gridloom.plans.dialect import DuckDB, Spark

ENTRIES: dict[str, tuple[Callable, Callable, str]] = {}
c = F.col


def entry(name: str, inputs: str | Callable, oracle: str):
    """Registers ``apply(rows)``; ``oracle`` reads the rows as ``i``."""

    def add(apply: Callable[[DataFrame], DataFrame]):
        ENTRIES[name] = (inputs if callable(inputs) else lambda d: inputs, apply, oracle)
        return apply

    return add


def queries() -> dict:
    from gridloom.plans.catalog import run_sql

    def runner(inputs, apply):
        return lambda spark, sf_dir: apply(run_sql(spark, sf_dir, inputs(Spark())))

    return {name: runner(inputs, apply) for name, (inputs, apply, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH i AS ({inputs(DuckDB())}) {oracle}" for name, (inputs, _, oracle) in ENTRIES.items()}


# ------------------------------------------------------------------- buildings


@entry(
    "footprint_status",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_custkey % 40) / 40e0 END AS cover,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE (o_orderkey % 29) / 28e0 END AS s6, (o_custkey % 31) / 30e0 AS sveg FROM orders""",
    """SELECT id, CASE WHEN cover IS NULL OR s6 IS NULL OR cover < 0.1 THEN 'NO_RETURNS_ABOVE_2M' WHEN NOT (s6 < 0.5) THEN 'MATCHED'
    WHEN NOT (sveg < 0.5) AND NOT (s6 >= 0.1) THEN 'LIDAR_MISSED' ELSE 'PARTIAL' END AS status FROM i""",
)
def footprint_status(df: DataFrame) -> DataFrame:
    return df.select("id", rules.footprint_status(c("cover"), c("s6"), c("sveg")).alias("status"))


@entry(
    "region_status",
    "SELECT o_orderkey AS id, o_orderkey % 5 = 0 AS a_in, o_orderkey % 7 < 3 AS a_cov, o_custkey % 9 = 0 AS l_in, o_custkey % 4 = 0 AS b_in, o_custkey % 3 = 0 AS b_cov FROM orders",
    "SELECT id, list_max([CASE WHEN a_in OR b_in THEN 2 WHEN a_cov OR b_cov THEN 1 ELSE 0 END]) AS code, CASE WHEN a_in OR b_in THEN 'MATCHED' WHEN a_cov OR b_cov THEN 'NO_FOOTPRINT' ELSE 'NO_FOOTPRINT_COVERAGE' END AS status FROM i",
)
def region_status(df: DataFrame) -> DataFrame:
    status = rules.region_status({"county": c("a_in"), "lidar_same_method": c("l_in"), "osm_current": c("b_in")}, {"county": c("a_cov"), "osm_current": c("b_cov")})
    return df.select("id", status.alias("status")).withColumn("code", F.element_at(F.create_map(F.lit("MATCHED"), F.lit(2), F.lit("NO_FOOTPRINT"), F.lit(1), F.lit("NO_FOOTPRINT_COVERAGE"), F.lit(0)), c("status")))


@entry(
    "roof_height_basis",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 > 0 THEN (o_custkey % 90) / 10e0 END AS p90, o_custkey % 20 AS n6, CASE WHEN o_orderkey % 3 > 0 THEN (o_orderkey % 70) / 10e0 END AS p50 FROM orders",
    """SELECT id, CASE basis WHEN 'CLASS6_P90' THEN p90 WHEN 'ALL_FIRST_P50' THEN p50 END AS height, basis FROM (
    SELECT *, CASE WHEN n6 > 9 AND p90 IS NOT NULL THEN 'CLASS6_P90' WHEN p50 IS NOT NULL THEN 'ALL_FIRST_P50' END AS basis FROM i)""",
)
def roof_height_basis(df: DataFrame) -> DataFrame:
    return df.select("id", rules.roof_height(c("p90"), c("n6"), c("p50")).alias("r")).select("id", "r.*")


@entry(
    "candidate_flag",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 19 > 0 THEN (o_custkey % 120) / 10e0 END AS h, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 110) / 10e0 END AS local_roof,
    o_custkey % 2 = 0 AS inside, CASE WHEN o_custkey % 5 > 0 THEN (o_orderkey % 80) / 10e0 END AS fp_roof FROM orders""",
    """, r AS (SELECT *, CASE WHEN local_roof IS NOT NULL THEN 'CLASS6_1M' WHEN inside AND fp_roof IS NOT NULL THEN 'FOOTPRINT' END AS basis FROM i),
    a AS (SELECT *, CASE basis WHEN 'CLASS6_1M' THEN h - local_roof WHEN 'FOOTPRINT' THEN h - fp_roof END AS above FROM r)
    SELECT id, CASE WHEN basis IS NULL THEN 'CLEAR' WHEN above IS NULL THEN 'UNKNOWN' WHEN above >= 2 THEN 'OVERHANG' WHEN above > 0.5 THEN 'NEAR_ROOF'
    WHEN inside THEN 'ON_ROOF' ELSE 'ROOF_EDGE' END AS flag, above, basis FROM a""",
)
def candidate_flag(df: DataFrame) -> DataFrame:
    return df.select("id", rules.candidate_flag(c("h"), c("local_roof"), c("inside"), c("fp_roof")).alias("r")).select("id", "r.*")


@entry(
    "label_codes",
    """SELECT o_orderkey AS id, cast(o_orderkey % 9 AS INT) AS cls, o_custkey % 3 > 0 AS in_zone, o_custkey % 5 > 1 AS covered, o_custkey % 7 = 1 AS edge,
    CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 50) / 10e0 END AS above FROM orders""",
    """SELECT id, CASE WHEN cls = 6 THEN (CASE WHEN in_zone THEN 6 WHEN covered THEN 64 ELSE 67 END)
    WHEN cls = 5 AND in_zone THEN (CASE WHEN above > 2 THEN 68 ELSE 65 END) WHEN cls IN (3, 4) AND in_zone THEN 70
    WHEN cls IN (3, 4, 5) THEN (CASE WHEN edge THEN 66 WHEN covered THEN cls ELSE 69 END) ELSE cls END AS code FROM i""",
)
def label_codes(df: DataFrame) -> DataFrame:
    return df.select("id", rules.label_code(c("cls"), c("in_zone"), c("covered"), c("edge"), c("above")).alias("code"))


@entry(
    "refine_rules",
    lambda d: f"""SELECT o_orderkey AS id, cast(b.v AS INT) AS base, cast(m.v AS INT) AS model, (o_orderkey + o_custkey) % 5 > 0 AS unanimous, o_custkey % 11 = 0 AS withheld,
    CASE WHEN o_orderkey % 6 > 0 THEN (o_custkey % 900) / 10e0 - 1 END AS hag FROM orders o
    JOIN {d.offsets([1, 2, 3, 4, 5, 6, 9, 17, 20], 'v')} b ON b.v = CASE o_orderkey % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 5 WHEN 5 THEN 6 WHEN 6 THEN 9 WHEN 7 THEN 17 WHEN 8 THEN 20 ELSE 6 END
    JOIN {d.offsets([0, 1, 2, 5, 6, 9, 17, 64], 'v')} m ON m.v = CASE o_custkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 5 WHEN 4 THEN 6 WHEN 5 THEN 9 WHEN 6 THEN 17 ELSE 64 END""",
    """, t(base, model, rule) AS (VALUES (3, 6, 1), (4, 6, 1), (5, 6, 1), (3, 64, 2), (4, 64, 2), (5, 64, 2), (3, 1, 3), (4, 1, 3), (5, 1, 3), (3, 2, 7), (4, 2, 7), (5, 2, 7),
    (6, 64, 5), (6, 1, 6), (6, 5, 4), (6, 2, 12), (3, 9, 15), (4, 9, 15), (5, 9, 15), (6, 9, 15), (3, 17, 15), (4, 17, 15), (5, 17, 15), (6, 17, 15), (1, 5, 16), (1, 6, 16), (1, 64, 16)),
    k AS (SELECT i.*, CASE WHEN NOT unanimous OR withheld OR i.model = 0 THEN 0 WHEN i.base IN (2, 20) AND i.model <> 2 THEN 13 WHEN i.base IN (9, 17) AND i.model <> i.base THEN 13
    ELSE coalesce(t.rule, 0) END AS r, CASE WHEN hag <= 0.5 THEN 3 WHEN hag <= 2 THEN 4 WHEN hag <= 80 THEN 5 ELSE 0 END AS band FROM i LEFT JOIN t ON i.base = t.base AND i.model = t.model)
    SELECT id, cast(CASE WHEN r IN (1, 2, 3, 5, 6) THEN model WHEN r = 7 THEN 2 WHEN r = 4 AND band > 0 THEN band ELSE base END AS INT) AS code, CASE WHEN r = 4 AND band = 0 THEN 14 ELSE r END AS rule FROM k""",
)
def refine_rules(df: DataFrame) -> DataFrame:
    return df.select("id", rules.refine(c("base"), c("model"), c("unanimous"), c("withheld"), c("hag")).alias("r")).select("id", "r.*")


# ----------------------------------------------------------------------- owners

_OWNERS = """SELECT c_custkey AS id, CASE c_custkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '  - ' WHEN 2 THEN 'Millcreek  City' WHEN 3 THEN 'Salt Lake City Corp.' WHEN 4 THEN 'State of Utah; Division ' || c_name
  WHEN 5 THEN 'Salt Lake City Property Management' WHEN 6 THEN 'LAKE COUNTY TITLE BY ' || c_name WHEN 7 THEN 'united states of america' WHEN 8 THEN 'The Granite School District'
  WHEN 9 THEN 'Taylorsville-Bennion Improvement District' WHEN 10 THEN 'City of Millcreek LLC' ELSE c_name END AS owner FROM customer"""


def _owner_oracle() -> str:
    rows = ", ".join(f"('{rules._normal(name)}', '{group}')" for group, found in rules.PUBLIC_OWNERS.items() for name in found)
    return f""", t(name, grp) AS (SELECT DISTINCT * FROM (VALUES {rows}) v),
    n AS (SELECT id, array_to_string(list_filter(string_split(regexp_replace(upper(coalesce(owner, '')), '[^A-Z0-9&;]', ' ', 'g'), ' '), lambda w: w <> ''), ' ') AS name FROM i)
    SELECT id, CASE WHEN n.name = '' THEN 'UNKNOWN_OWNER' WHEN grp IS NOT NULL THEN 'PUBLIC_GOVERNMENT' WHEN mixed THEN 'UNKNOWN_OWNER' ELSE 'PRIVATE' END AS category,
    CASE WHEN n.name = '' THEN 'Missing owner of record' WHEN grp IS NOT NULL THEN grp WHEN mixed THEN 'Ambiguous or mixed government owner'
    ELSE 'Other named owner; includes private utilities, churches and nonprofits' END AS basis
    FROM (SELECT *, regexp_matches(name, '^LAKE COUNTY TITLE BY|^SALT LAKE CITY PROPERTY MANAGEMENT$|SALT LAKE COUNTY;|STATE OF UTAH;|COUNTY OF SALT LAKE;|UNITED STATES OF AMERICA;') AS mixed FROM n) n
    LEFT JOIN t ON n.name = t.name"""


@entry("owner_classify", _OWNERS, _owner_oracle())
def owner_classify(df: DataFrame) -> DataFrame:
    return df.select("id", rules.owner_class(c("owner")).alias("r")).select("id", "r.*")


@entry(
    "owner_review_table",
    _OWNERS,
    _owner_oracle().replace("\n    SELECT id, CASE", ", o AS (SELECT n.name AS owner, CASE", 1) + ") SELECT owner, category, basis, count(*) AS parcels FROM o GROUP BY ALL",
)
def owner_review_table(df: DataFrame) -> DataFrame:
    return df.select(rules.normal_owner(c("owner")).alias("owner"), rules.owner_class(c("owner")).alias("r")).groupBy("owner", "r.category", "r.basis").agg(F.count("*").alias("parcels"))


# ---------------------------------------------------------------- names, routes

_ROADS = """SELECT o_orderkey AS id, CASE o_custkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' END AS code,
  CASE WHEN o_orderkey % 6 = 0 THEN ' i-15 ' WHEN o_orderkey % 6 = 1 THEN 'US 89a' ELSE CASE WHEN o_orderkey % 6 = 2 THEN '  ' END END AS hwy,
  CASE WHEN o_orderkey % 4 = 0 THEN '0' || substr('000' || cast(o_custkey % 1000 AS VARCHAR(9)), length(cast(o_custkey % 1000 AS VARCHAR(9))) + 1, 3) || 'P' WHEN o_orderkey % 4 = 1 THEN '1200N' WHEN o_orderkey % 4 = 2 THEN '89P' END AS rt,
  CASE o_custkey % 7 WHEN 0 THEN 'HWY 0' || cast(o_custkey % 300 AS VARCHAR(9)) WHEN 1 THEN 'ut-152' WHEN 2 THEN 'MAIN ST' WHEN 3 THEN 'SR' WHEN 4 THEN 'sr 71 old' END AS a1,
  CASE o_orderkey % 3 WHEN 0 THEN 'I 80' WHEN 1 THEN 'US-40' END AS a2 FROM orders"""


@entry(
    "route_key",
    _ROADS,
    r""", w AS (SELECT *, list_filter(string_split(upper(replace(coalesce(a1, ''), '-', ' ')), ' '), lambda x: x <> '') AS w1, list_filter(string_split(upper(replace(coalesce(a2, ''), '-', ' ')), ' '), lambda x: x <> '') AS w2,
    upper(trim(coalesce(hwy, ''))) AS h, upper(trim(coalesce(rt, ''))) AS r FROM i),
    k AS (SELECT *, CASE WHEN len(w1) >= 2 AND regexp_full_match(w1[2], '[0-9]+') THEN CASE w1[1] WHEN 'I' THEN 'I-' WHEN 'US' THEN 'US ' WHEN 'SR' THEN 'SR ' WHEN 'UT' THEN 'SR ' WHEN 'HWY' THEN CASE WHEN code IN ('2', '3') THEN 'US ' ELSE 'SR ' END END || cast(try_cast(w1[2] AS INT) AS VARCHAR) END AS k1,
    CASE WHEN len(w2) >= 2 AND regexp_full_match(w2[2], '[0-9]+') THEN CASE w2[1] WHEN 'I' THEN 'I-' WHEN 'US' THEN 'US ' WHEN 'SR' THEN 'SR ' WHEN 'UT' THEN 'SR ' WHEN 'HWY' THEN CASE WHEN code IN ('2', '3') THEN 'US ' ELSE 'SR ' END END || cast(try_cast(w2[2] AS INT) AS VARCHAR) END AS k2 FROM w),
    f AS (SELECT id, CASE WHEN h <> '' THEN h WHEN regexp_full_match(r, '[0-9]{4}[PN]') AND try_cast(r[1:4] AS INT) BETWEEN 1 AND 999
    THEN CASE code WHEN '1' THEN 'I-' WHEN '2' THEN 'US ' WHEN '3' THEN 'US ' ELSE 'SR ' END || cast(try_cast(r[1:4] AS INT) AS VARCHAR) ELSE coalesce(k1, k2, '') END AS route FROM k)
    SELECT id, route, CASE WHEN route LIKE 'I-%' THEN 'I' ELSE string_split(route, ' ')[1] END AS family, CASE WHEN route LIKE 'I-%' THEN 0 WHEN route LIKE 'US %' THEN 1 WHEN route LIKE 'SR %' THEN 2 ELSE 3 END AS rank,
    cast(coalesce(nullif(regexp_replace(route, '[^0-9]', '', 'g'), ''), '0') AS BIGINT) AS number FROM f""",
)
def route_key(df: DataFrame) -> DataFrame:
    keyed = df.select("id", names.route_key(c("code"), c("hwy"), c("rt"), c("a1"), c("a2")).alias("route"))
    order = names.route_sort_key(c("route"))
    return keyed.select("id", "route", names.route_family(c("route")).alias("family"), order["rank"].alias("rank"), order["number"].alias("number"))


@entry(
    "street_name",
    """SELECT p_partkey AS id, CASE p_size % 9 WHEN 0 THEN NULL WHEN 1 THEN 'NB ' || p_name WHEN 2 THEN 'I-15 NB' WHEN 3 THEN 'HWY 89' WHEN 4 THEN 'HWY 89 SB' WHEN 5 THEN '8TH  AVE eb' WHEN 6 THEN 'us 40 ' || p_name WHEN 7 THEN 'SB WB' ELSE p_name END AS full_name FROM part""",
    """, w AS (SELECT id, list_filter(string_split(coalesce(full_name, ''), ' '), lambda x: x <> '' AND upper(x) NOT IN ('NB', 'SB', 'EB', 'WB')) AS w FROM i)
    SELECT id, CASE WHEN len(w) = 0 OR upper(w[1]) LIKE 'I-%' OR (len(w) = 2 AND upper(w[1]) IN ('HWY', 'SR', 'US', 'I') AND regexp_full_match(w[2], '[0-9]+')) THEN ''
    ELSE array_to_string(list_transform(w, lambda x: upper(x[1]) || lower(x[2:])), ' ') END AS name FROM w""",
)
def street_name(df: DataFrame) -> DataFrame:
    return df.select("id", names.street_name(c("full_name")).alias("name"))


@entry(
    "street_name_expression",
    "SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'EB ' || p_name WHEN 1 THEN 'sr 71' ELSE p_name END AS full_name FROM part",
    """, w AS (SELECT id, list_filter(string_split(full_name, ' '), lambda x: x <> '' AND upper(x) NOT IN ('NB', 'SB', 'EB', 'WB')) AS w FROM i)
    SELECT id, CASE WHEN full_name_is_route THEN '' ELSE array_to_string(list_transform(w, lambda x: upper(x[1]) || lower(x[2:])), ' ') END AS name FROM (SELECT *, len(w) = 2 AND upper(w[1]) = 'SR' AND w[2] = '71' AS full_name_is_route FROM w)""",
)
def street_name_expression(df: DataFrame) -> DataFrame:
    return df.select("id", F.expr(names.name_expression().replace("$1", "full_name")).alias("name"))


@entry(
    "public_path",
    r"""SELECT o_orderkey AS id, replace(CASE o_orderkey % 8 WHEN 0 THEN '//server/share/folder/' || cast(o_custkey AS VARCHAR(9)) || '.las' WHEN 1 THEN '//server/share' WHEN 2 THEN '//?/UNC/server/share/a/b.las' WHEN 3 THEN 'D:/lidar/a.las'
    WHEN 4 THEN '//./UNC/server/share' WHEN 5 THEN '//server//share//deep//' WHEN 6 THEN 'relative/a.las' END, '/', CASE WHEN o_custkey % 2 = 0 THEN '/' ELSE chr(92) END) AS path FROM orders""",
    r""", p AS (SELECT id, path, list_filter(string_split(replace(path, chr(92), '/'), '/'), lambda x: x <> '') AS parts, replace(path, chr(92), '/') LIKE '//%' AS unc FROM i),
    q AS (SELECT id, path, unc, CASE WHEN len(parts) >= 2 AND parts[1] IN ('?', '.') AND parts[2] = 'UNC' THEN parts[3:] ELSE parts END AS parts FROM p)
    SELECT id, CASE WHEN NOT unc THEN path WHEN len(parts) > 2 THEN parts[-1] || ' (network path redacted)' WHEN unc THEN '(network path redacted)' END AS shown FROM q""",
)
def public_path(df: DataFrame) -> DataFrame:
    return df.select("id", names.public_path(c("path")).alias("shown"))


@entry(
    "rebased_path",
    "SELECT o_orderkey AS id, replace(CASE o_orderkey % 4 WHEN 0 THEN 'D:/lidar/runs/' || cast(o_custkey AS VARCHAR(9)) WHEN 1 THEN 'e:/LiDAR' WHEN 2 THEN 'C:/lidars/a' ELSE '/data/lidar/a' END, '/', CASE WHEN o_custkey % 2 = 0 THEN '/' ELSE chr(92) END) AS path FROM orders",
    r"""SELECT id, CASE WHEN lower(path[2:8]) IN (':/lidar', ':' || chr(92) || 'lidar') AND (len(path) = 8 OR path[9] IN ('/', chr(92))) THEN '/mnt/store' || replace(path[9:], chr(92), '/') ELSE path END AS path FROM i""",
)
def rebased_path(df: DataFrame) -> DataFrame:
    return df.select("id", names.rebased_path(c("path"), "/mnt/store").alias("path"))


@entry(
    "creation_date",
    "SELECT o_orderkey AS id, cast(CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1896 + o_custkey % 210 END AS INT) AS y, cast(o_orderkey % 369 AS INT) AS d FROM orders",
    """SELECT id, CASE WHEN y > 0 AND d BETWEEN 1 AND CASE WHEN (y % 4 = 0 AND y % 100 <> 0) OR y % 400 = 0 THEN 366 ELSE 365 END
    THEN strftime(make_date(greatest(y, 1), 1, 1) + to_days(cast(d - 1 AS INT)), '%Y-%m-%d') END AS created FROM i""",
)
def creation_date(df: DataFrame) -> DataFrame:
    return df.select("id", names.creation_date(c("y"), c("d")).alias("created"))


@entry(
    "tile_names",
    "SELECT o_orderkey AS id, 400000 + (o_orderkey * 37 % 99000) * 1e0 AS x, 4500000 + (o_custkey * 91 % 99000) * 1e0 AS y FROM orders",
    """, t AS (SELECT id, cast(floor((x - 400000) / 1000) AS INT) AS cx, cast(floor((y - 4500000) / 1000) AS INT) AS cy FROM i)
    SELECT id, '12TVL' || printf('%02d', cx) || printf('%02d', cy) AS tile, array_to_string(list_transform([[-1, -1], [-1, 0], [-1, 1], [0, -1], [0, 1], [1, -1], [1, 0], [1, 1]], lambda o: '12TVL' || lpad(cast(cx + o[1] AS VARCHAR), 2, '0') || lpad(cast(cy + o[2] AS VARCHAR), 2, '0')), ',') AS around FROM t""",
)
def tile_names(df: DataFrame) -> DataFrame:
    named = df.select("id", names.tile_name(c("x"), c("y")).alias("tile"))
    return named.withColumn("around", F.array_join(names.neighbour_tiles(c("tile")), ","))


@entry(
    "flight_summary",
    lambda d: """SELECT l_suppkey AS id, l_orderkey % 400 AS k, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '  ' ELSE ' 2024-0' || cast(l_partkey % 9 + 1 AS VARCHAR(9)) || '-1' || cast(l_partkey % 7 AS VARCHAR(9)) || ' ' END AS flown FROM lineitem""",
    """SELECT id, coalesce(string_agg(DISTINCT nullif(trim(flown), ''), ';' ORDER BY nullif(trim(flown), '')), '') AS dates, min(nullif(trim(flown), '')) AS first, max(nullif(trim(flown), '')) AS last, count(nullif(trim(flown), '')) AS swaths FROM i GROUP BY id""",
)
def flight_summary(df: DataFrame) -> DataFrame:
    # distinct dates per tile are few; swaths are counted before they are gathered
    per_date = df.withColumn("d", F.nullif(F.trim("flown"), F.lit(""))).groupBy("id", "d").agg(F.count("*").alias("n"))
    found = per_date.groupBy("id").agg(F.collect_list("d").alias("all"), F.sum(F.when(c("d").isNotNull(), c("n")).otherwise(0)).alias("swaths"))
    return found.select("id", names.flight_summary(c("all")).alias("s"), "swaths").select("id", "s.dates", "s.first", "s.last", "swaths")


@entry(
    "number_texts",
    "SELECT o_orderkey AS id, (o_custkey % 700) / 100e0 - CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 0.001e0 END AS v, o_orderkey * 1009 AS n, CASE WHEN o_orderkey % 3 > 0 THEN (o_custkey % 97) / 97e0 END AS e, CASE WHEN o_orderkey % 4 > 0 THEN (o_custkey % 90) / 100e0 END AS low, CASE WHEN o_orderkey % 5 > 1 THEN 'SUPPRESSED' END AS status FROM orders WHERE o_custkey % 700 <> 125",
    """SELECT id, CASE WHEN v > 0 AND v < 0.005 THEN '<0.01%' ELSE printf('%.2f%%', v) END AS pct, format('{:,}', n) AS thousands,
    CASE WHEN e IS NULL THEN 'n/a' WHEN low IS NULL THEN printf('%.1f%%', e * 100) || CASE WHEN status IS NOT NULL THEN ' [interval unavailable]' ELSE '' END
    ELSE printf('%.1f%% [%.1f%%, %.1f%%]', e * 100, low * 100, (low + 0.0613) * 100) END AS estimate, CASE WHEN status IS NULL THEN '—' ELSE status END AS shown FROM i""",
)
def number_texts(df: DataFrame) -> DataFrame:
    high = c("low") + 0.0613
    return df.select(
        "id", names.percent(c("v")).alias("pct"), names.thousands(c("n")).alias("thousands"), names.estimate_text(c("e"), c("low"), high, c("status"), True).alias("estimate"), names.text_or_dash(c("status")).alias("shown")
    )


@entry(
    "hex_colours",
    "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN ' #A1f' WHEN 1 THEN '#00FF7f' WHEN 2 THEN 'none' WHEN 3 THEN 'red' ELSE '#12345' END AS v FROM orders",
    "SELECT id, CASE trim(v) WHEN '#A1f' THEN '#aa11ff' WHEN '#00FF7f' THEN '#00ff7f' END AS colour FROM i",
)
def hex_colours(df: DataFrame) -> DataFrame:
    return df.select("id", names.hex_colour(c("v")).alias("colour"))


@entry(
    "symbol_routes",
    "SELECT o_orderkey AS id, cast(o_orderkey % 32 AS INT) AS symbol FROM orders",
    """SELECT id, CASE WHEN symbol BETWEEN 1 AND 5 THEN (['I-15', 'I-70', 'I-80', 'I-84', 'I-215'])[symbol] WHEN symbol BETWEEN 6 AND 8 THEN (['US 6', 'US 30', 'US 40'])[symbol - 5]
    WHEN symbol BETWEEN 27 AND 30 THEN 'SR ' || cast(symbol - 19 AS VARCHAR) END AS route FROM i""",
)
def symbol_routes(df: DataFrame) -> DataFrame:
    groups = [(1, ["I-15", "I-70", "I-80", "I-84", "I-215"]), (6, ["US 6", "US 30", "US 40"]), (27, [f"SR {n}" for n in range(8, 12)])]
    return df.select("id", names.symbol_route(c("symbol"), groups).alias("route"))


@entry(
    "digests",
    "SELECT c_custkey AS id, c_name, c_nationkey, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS seg FROM customer",
    """SELECT id, sha256('{"id":' || cast(id AS VARCHAR) || ',"c_name":"' || c_name || '","seg":' || coalesce('"' || seg || '"', 'null') || '}') AS digest,
    sha256(array_to_string(list_sort([c_name, cast(id AS VARCHAR), 'x']), chr(10))) AS ids FROM i""",
)
def digests(df: DataFrame) -> DataFrame:
    return df.select("id", names.struct_digest(c("id"), c("c_name"), c("seg")).alias("digest"), names.ids_digest(F.array(F.lit("x"), c("c_name"), c("id").cast("string"))).alias("ids"))


@entry(
    "affine_points",
    "SELECT o_orderkey AS id, (o_custkey % 100) * 1e0 AS x, (o_orderkey % 100) * 1e0 AS y FROM orders",
    "SELECT id, 2 * (3 * x) + 10 AS x, 2 * (5 * y + 1) - 4 AS y FROM i",
)
def affine_points(df: DataFrame) -> DataFrame:
    m = names.affine("translate(10,-4) scale(2) matrix(3 0 0 5 0 1)")
    return df.select("id", names.apply_affine(m, c("x"), c("y")).alias("p")).select("id", "p.*")


# -------------------------------------------------------------- strata and cues


@entry(
    "sampling_strata",
    """SELECT o_orderkey AS id, o_orderkey % 23 = 0 AS seam, (o_orderkey % 25) / 10e0 AS dist, (o_custkey % 150) / 10e0 AS h, CASE WHEN o_orderkey % 6 > 0 THEN (o_custkey % 130) / 10e0 END AS roof,
    (o_custkey % 700) / 10e0 AS area, (o_orderkey % 30) / 15e0 AS overlap, o_custkey % 60 AS cells FROM orders""",
    """, k AS (SELECT *, CASE WHEN dist > 1 THEN 'AWAY' WHEN roof IS NULL THEN 'UNKNOWN' WHEN h - roof <= 0.5 THEN 'ROOF_LEVEL' WHEN h - roof >= 2 THEN 'ABOVE_ROOF' ELSE 'ROOF_MID' END AS ctx FROM i)
    SELECT id, ctx AS context, CASE WHEN seam THEN 'SEAM' WHEN ctx = 'UNKNOWN' THEN 'ROOF_MID' WHEN ctx <> 'AWAY' THEN ctx WHEN area < 3 THEN 'SMALL_CROWN' ELSE 'NORMAL' END AS top,
    CASE WHEN overlap >= 1 THEN 'CR_BLDG' WHEN area < 10 THEN 'CR_SMALL' WHEN area < 50 THEN 'CR_MEDIUM' ELSE 'CR_LARGE' END AS crown, cells * 0.25 AS area,
    2 * sqrt(cells * 0.25 / pi()) AS diameter, CASE WHEN cells >= 12 THEN 'ESTIMATED' ELSE 'CROWN_TOO_SMALL' END AS status FROM k""",
)
def sampling_strata(df: DataFrame) -> DataFrame:
    context = rules.roof_context(c("dist"), c("h"), c("roof"))["category"]
    known = F.when(context == "UNKNOWN", "ROOF_MID").otherwise(context)
    size = rules.crown_size(c("cells"), 0.5)
    return df.select(
        "id", context.alias("context"), rules.treetop_stratum(c("seam"), known, c("area")).alias("top"), rules.crown_stratum(c("area"), c("overlap")).alias("crown"),
        size["area"].alias("area"), size["diameter"].alias("diameter"), size["status"].alias("status"),
    )


_CUES = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 31 > 0 THEN (o_orderkey % 50) / 10e0 END AS hag, (o_custkey % 8) / 20e0 AS thickness, CASE o_orderkey % 4 WHEN 0 THEN 0.97e0 WHEN 1 THEN 0.88e0 WHEN 2 THEN 0.3e0 ELSE 0.6e0 END AS normal_z,
  (o_custkey % 9) / 20e0 AS nonlast, CASE WHEN o_custkey % 10 > 0 THEN (o_custkey % 10) / 20e0 - 0.1e0 END AS ndvi, CASE WHEN o_orderkey % 7 > 0 THEN o_orderkey % 3 = 0 END AS inside, (o_orderkey % 12) / 2e0 AS edge,
  (o_custkey % 40) * 5e0 AS area, (o_orderkey % 9) / 2e0 AS top_hag, (o_custkey % 6) / 5e0 AS lin, (o_orderkey % 11) / 10e0 AS axis, (o_custkey % 12) / 3e0 AS extent, o_orderkey % 100 AS n FROM orders"""


@entry(
    "triage_propose",
    _CUES,
    """, k AS (SELECT id, n, list_sort(list_filter([CASE WHEN inside AND hag >= 3 AND thickness <= 0.1 AND normal_z >= 0.85 AND nonlast <= 0.15 AND area >= 60 AND ndvi < 0.2 THEN 'BUILDING_ROOF' END,
    CASE WHEN NOT inside AND ndvi >= 0.25 AND nonlast >= 0.3 AND thickness >= 0.25 AND hag >= 2.5 THEN 'TREE' END, CASE WHEN NOT inside AND ndvi >= 0.25 AND nonlast >= 0.2 AND top_hag <= 2 THEN 'SHRUB_LOW_VEG' END,
    CASE WHEN NOT inside AND hag <= 0.35 AND thickness <= 0.1 AND normal_z >= 0.95 AND nonlast <= 0.1 THEN 'GROUND' END, CASE WHEN edge <= 2.5 AND normal_z <= 0.35 AND thickness <= 0.1 AND hag >= 1.5 THEN 'WALL' END,
    CASE WHEN NOT inside AND edge >= 2 AND lin >= 0.85 AND axis <= 0.5 AND hag >= 4 AND ndvi < 0.15 AND n <= 60 THEN 'WIRE' END, CASE WHEN NOT inside AND lin >= 0.85 AND axis >= 0.9 AND extent >= 2.5 AND ndvi < 0.15 THEN 'POLE' END],
    lambda x: x IS NOT NULL)) AS f FROM i)
    SELECT id, array_to_string(f, ',') AS fits, CASE WHEN n >= 12 AND len(f) = 1 AND f[1] NOT IN ('GROUND', 'WIRE', 'POLE') THEN f[1] END AS label,
    CASE WHEN n >= 12 AND len(f) = 1 AND f[1] NOT IN ('GROUND', 'WIRE', 'POLE') THEN 'AUTO_CANDIDATE' ELSE 'REVIEW' END AS tier, CASE WHEN n >= 12 AND len(f) = 1 AND f[1] IN ('GROUND', 'WIRE', 'POLE') THEN f[1] END AS hint FROM k""",
)
def triage_propose(df: DataFrame) -> DataFrame:
    args = [c(x) for x in ("hag", "thickness", "normal_z", "nonlast", "ndvi", "inside", "edge", "area", "top_hag", "lin", "axis", "extent", "n")]
    return df.select("id", rules.triage(*args).alias("t")).select("id", F.array_join("t.fits", ",").alias("fits"), "t.label", "t.tier", "t.hint")


@entry(
    "combine_footprints",
    "SELECT o_orderkey AS id, o_orderkey % 3 = 0 AS c_in, (o_custkey % 90) / 10e0 AS c_edge, (o_custkey % 300) * 1e0 AS c_area, o_custkey % 2 = 0 AS o_in, (o_orderkey % 80) / 10e0 AS o_edge FROM orders",
    """SELECT id, CASE WHEN c_in THEN true WHEN NOT o_in THEN false END AS inside, CASE WHEN c_in OR NOT o_in THEN least(c_edge, o_edge) END AS edge, CASE WHEN c_in THEN c_area END AS area FROM i""",
)
def combine_footprints(df: DataFrame) -> DataFrame:
    both = rules.combine_footprints(c("c_in"), c("c_edge"), c("c_area"), c("o_in"), c("o_edge"))
    return df.select("id", both.alias("f")).select("id", "f.inside", "f.edge", "f.area")


_EVIDENCE = """SELECT o_orderkey AS id, o_orderkey % 4 AS n_building_1m, CASE WHEN o_orderkey % 5 > 0 THEN (o_custkey % 60) / 10e0 END AS building_dist_m, CASE WHEN o_custkey % 3 > 0 THEN (o_custkey % 40) / 10e0 - 1 END AS above_roof_m,
  o_custkey % 90 AS n_top, CASE WHEN o_orderkey % 9 > 0 THEN (o_orderkey % 70) / 10e0 END AS top_hag_m, (o_custkey % 10) / 20e0 AS top_nonlast, (o_orderkey % 6) / 20e0 AS top_thickness,
  CASE o_custkey % 4 WHEN 0 THEN 0.9e0 WHEN 1 THEN 0.3e0 WHEN 2 THEN 0.85e0 END AS top_normal_z, (o_orderkey % 5) / 4e0 AS ctx_linearity, (o_custkey % 11) / 10e0 AS ctx_axis_z, (o_orderkey % 8) / 2e0 AS ctx_extent_z FROM orders"""
_FLAGS = ("NEAR_BUILDING", "ROOF_HEIGHT", "OVERHANG", "FLAT_TOP", "WIRE_HINT", "POLE_HINT", "WALL_HINT", "CANOPY_RETURNS", "SUSPECT")
_FLAGGED = """, f AS (SELECT id, above_roof_m, n_building_1m > 0 AS near_building, coalesce(n_building_1m > 0 AND above_roof_m <= 0.5, false) AS roof_height, coalesce(n_building_1m > 0 AND above_roof_m > 2, false) AS overhang,
    coalesce(n_top >= 12 AND top_thickness <= 0.1 AND top_normal_z >= 0.85 AND top_nonlast <= 0.15, false) AS flat_top,
    coalesce(ctx_linearity >= 0.85 AND ctx_axis_z <= 0.5 AND top_hag_m >= 4 AND n_top <= 60 AND coalesce(building_dist_m, 99) > 2, false) AS wire_hint,
    coalesce(ctx_linearity >= 0.85 AND ctx_axis_z >= 0.9 AND ctx_extent_z >= 2.5, false) AS pole_hint,
    coalesce(n_top >= 12 AND top_normal_z <= 0.35 AND top_thickness <= 0.1 AND top_hag_m >= 1.5 AND building_dist_m <= 2.5, false) AS wall_hint,
    coalesce(n_top >= 12 AND top_nonlast >= 0.3 AND top_thickness > 0.1, false) AS canopy_returns FROM i),
    s AS (SELECT *, roof_height OR flat_top OR wire_hint OR wall_hint AS suspect FROM f)"""


def _with_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({name.lower(): value for name, value in rules.treetop_flags({x: c(x) for x in df.columns}).items()})


@entry("treetop_flags", _EVIDENCE, _FLAGGED + " SELECT * EXCLUDE above_roof_m FROM s")
def treetop_flags(df: DataFrame) -> DataFrame:
    return _with_flags(df).select("id", *[f.lower() for f in _FLAGS])


@entry(
    "evidence_summary",
    _EVIDENCE,
    _FLAGGED
    + """ SELECT roof_height::INT + flat_top::INT + wire_hint::INT + wall_hint::INT AS suspect_flags, CASE WHEN NOT near_building THEN 'away' WHEN above_roof_m IS NULL THEN 'no ground' WHEN above_roof_m <= 0.5 THEN '0.5'
    WHEN above_roof_m <= 2 THEN '2' ELSE 'over' END AS band, count(*) AS tops, sum(canopy_returns::INT) AS with_canopy, sum((suspect AND NOT canopy_returns)::INT) AS suspect_bare FROM s GROUP BY ALL""",
)
def evidence_summary(df: DataFrame) -> DataFrame:
    i = lambda name: c(name).cast("int")
    band = rules.cases(
        (~c("near_building"), "away"), (c("above_roof_m").isNull(), "no ground"), (c("above_roof_m") <= 0.5, "0.5"), (c("above_roof_m") <= 2, "2"), otherwise="over"
    )
    return _with_flags(df).groupBy((i("roof_height") + i("flat_top") + i("wire_hint") + i("wall_hint")).alias("suspect_flags"), band.alias("band")).agg(
        F.count("*").alias("tops"), F.sum(i("canopy_returns")).alias("with_canopy"), F.sum((c("suspect") & ~c("canopy_returns")).cast("int")).alias("suspect_bare")
    )


@entry(
    "plausibility_check",
    """SELECT o_orderkey AS id, CASE o_custkey % 12 WHEN 0 THEN 'VEHICLE' WHEN 1 THEN 'POLE' WHEN 2 THEN 'WALL' WHEN 3 THEN 'WIRE' WHEN 4 THEN 'BUILDING_ROOF' WHEN 5 THEN 'OTHER_STRUCTURE' WHEN 6 THEN 'TREE' WHEN 7 THEN 'SHRUB_LOW_VEG'
    WHEN 8 THEN 'GROUND' WHEN 9 THEN 'MIXED' WHEN 10 THEN 'UNSURE' END AS label, o_orderkey % 40 AS n, (o_orderkey % 41) / 10e0 AS mean, (o_orderkey % 41) / 10e0 + 0.25e0 AS top FROM orders""",
    """, t(label, stat, sign, lim) AS (VALUES ('VEHICLE', 'max', 1, 0.8), ('POLE', 'max', 1, 1.5), ('WALL', 'max', 1, 1.0), ('WIRE', 'mean', 1, 2.5), ('BUILDING_ROOF', 'mean', 1, 2.0), ('OTHER_STRUCTURE', 'max', 1, 0.8),
    ('TREE', 'max', 1, 1.5), ('SHRUB_LOW_VEG', 'mean', -1, 3.0), ('GROUND', 'max', -1, 1.0))
    SELECT id, concat_ws(';', CASE WHEN i.label NOT IN ('MIXED', 'UNSURE') AND n < 12 THEN 'TOO_FEW_POINTS' END, CASE WHEN n > 0 AND sign * (CASE stat WHEN 'max' THEN top ELSE mean END) < sign * lim THEN 'HEIGHT_LIMIT' END) AS reasons
    FROM i LEFT JOIN t ON i.label = t.label""",
)
def plausibility_check(df: DataFrame) -> DataFrame:
    return df.select("id", rules.implausible(c("label"), c("n"), c("mean"), c("top")).alias("reasons"))


@entry(
    "shape_groups",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 > 0 THEN (o_orderkey % 21) / 20e0 END AS lin, (o_custkey % 21) / 20e0 AS plan, (o_custkey % 17) / 16e0 AS scat, (o_orderkey % 13) / 12e0 AS nz, (o_custkey % 15) / 14e0 AS az,
    CASE WHEN o_custkey % 6 > 0 THEN (o_orderkey % 20) / 10e0 END AS hag, o_orderkey % 2 = 0 AS single, (o_custkey % 10) / 9e0 AS ss, (o_orderkey % 10) / 9e0 AS ir FROM orders""",
    """, g AS (SELECT *, CASE WHEN lin IS NULL THEN 'sparse' WHEN plan >= 0.6 AND 1 - nz >= 0.7 THEN 'wall_like' WHEN plan >= 0.6 THEN 'roof_like' WHEN lin >= 0.6 AND sqrt(greatest(1 - az * az, 0)) <= 1 - 0.7e0 THEN 'pole'
    WHEN lin >= 0.6 AND az <= 1 - 0.7e0 THEN 'wire' WHEN lin >= 0.6 THEN 'linear' WHEN scat >= 0.6 THEN 'scattered' ELSE 'mixed' END AS raw FROM i),
    w AS (SELECT *, CASE WHEN raw = 'wall_like' AND (hag IS NULL OR hag < 0.7) THEN 'low_wall' ELSE raw END AS shape FROM g)
    SELECT id, shape, shape IN ('wall_like', 'wire', 'pole') AND single AND ss >= 0.6 AND ir <= 0.4 AS applies FROM w""",
)
def shape_groups(df: DataFrame) -> DataFrame:
    shape = rules.split_low_walls(rules.shape_group(c("lin"), c("plan"), c("scat"), c("nz"), c("az")), c("hag"))
    return df.select("id", shape.alias("shape"), "single", "ss", "ir").select("id", "shape", rules.gate_applies(c("shape"), c("single"), c("ss"), c("ir")).alias("applies"))


# --------------------------------------------------------------- review drivers


@entry(
    "alignment_class",
    """SELECT o_orderkey AS id, (o_orderkey % 41) / 40e0 AS r0, (o_orderkey % 41 + o_custkey % 12) / 40e0 AS best, (o_orderkey % 41 + o_custkey % 9) / 40e0 AS loc, (o_custkey % 10) / 16e0 AS loc_m, (o_custkey % 25) / 16e0 AS shift,
    CASE WHEN o_custkey % 4 > 0 THEN (o_custkey % 23) / 16e0 END AS resid, (o_custkey % 7) / 8e0 AS canopy, (o_orderkey % 5) / 64e0 AS sharp, (o_custkey % 6) / 64e0 AS margin, o_orderkey % 3 % 2 AS edge FROM orders""",
    """, k AS (SELECT *, r0 >= 0.85 AND best - r0 < 0.05 AS al, loc >= 0.85 AND loc - r0 >= 0.05 AND loc_m >= 0.25 AS sy FROM i)
    SELECT id, CASE WHEN al THEN 'ALIGNED' WHEN sy THEN 'SYSTEMATIC' WHEN sharp >= 0.02 AND margin >= 0.02 AND edge = 0 AND best >= 0.85 AND best - r0 >= 0.05 AND shift >= 0.5 AND coalesce(resid, shift) >= 0.5 THEN 'REAL_OFFSET'
    WHEN best < 0.5 AND canopy < 0.3 THEN 'REBUILT_OR_GONE' ELSE 'UNCERTAIN' END AS class FROM k""",
)
def alignment_class(df: DataFrame) -> DataFrame:
    args = [c(x) for x in ("r0", "best", "loc", "loc_m", "shift", "resid", "canopy", "sharp", "margin", "edge")]
    return df.select("id", rules.alignment_class(*args).alias("class"))


@entry(
    "vehicle_like",
    "SELECT o_orderkey AS id, (o_custkey % 60) * 1e0 AS area, (o_orderkey % 130) / 10e0 AS len, (o_custkey % 45) / 10e0 AS wid, (o_orderkey % 50) / 10e0 AS h, (o_custkey % 30) / 100e0 AS gap, o_orderkey % 6 = 0 AS street FROM orders",
    """SELECT id, area >= 12 AND area <= 45 AND wid <= 3.3 AND len / 2.5 >= wid AND h >= 2.3 AND h <= 4.5 AS vehicle,
    CASE WHEN gap < 0.1 THEN 'touching' WHEN street THEN 'vehicle' WHEN len >= 5.2 AND wid <= 3.3 AND h <= 3 THEN 'vehicle' ELSE 'shed' END AS cue FROM i""",
)
def vehicle_like(df: DataFrame) -> DataFrame:
    return df.select("id", rules.vehicle_like(c("area"), c("len"), c("wid"), c("h")).alias("vehicle"), rules.small_cue(c("gap"), c("len"), c("wid"), c("h"), c("street")).alias("cue"))


@entry(
    "answer_decisions",
    """SELECT o_orderkey AS id, CASE o_custkey % 4 WHEN 0 THEN 'COUNTY_RIGHT' WHEN 1 THEN 'UNDER_TREES' WHEN 2 THEN 'LIDAR_RIGHT' ELSE 'UNSURE' END AS answer,
    CASE o_orderkey % 5 WHEN 0 THEN 'Two SEParate roofs' WHEN 1 THEN 'should split' WHEN 2 THEN 'Gone' WHEN 3 THEN '' END AS note FROM orders""",
    """SELECT id, CASE WHEN answer IN ('COUNTY_RIGHT', 'UNDER_TREES') THEN 'KEEP_COUNTY' WHEN answer <> 'UNSURE' THEN answer WHEN regexp_matches(note, '(?i)sep|split') THEN 'SPLIT_BUILDINGS'
    WHEN note ILIKE '%gone%' THEN 'NEEDS_EDIT' ELSE answer END AS decision FROM i""",
)
def answer_decisions(df: DataFrame) -> DataFrame:
    return df.select("id", rules.answer_decision(c("answer"), c("note")).alias("decision"))


@entry(
    "priority_groups",
    "SELECT o_orderkey AS id, o_orderkey % 7 AS n, (o_custkey % 9) / 8e0 AS s11, (o_orderkey % 10) / 9e0 AS chg, (o_custkey % 7) / 6e0 AS uns, (o_orderkey % 21) / 40e0 - 0.1e0 AS ndvi FROM orders",
    """SELECT id, CASE WHEN n = 0 THEN NULL WHEN s11 >= 0.5 THEN 'rule11_' || CASE WHEN ndvi > 0.1 THEN 'green' ELSE 'bare' END WHEN chg >= 1 / 3 THEN 'changed' WHEN uns >= 1 / 3 THEN 'unsure_model' END AS grp FROM i""",
)
def priority_groups(df: DataFrame) -> DataFrame:
    return df.select("id", rules.priority_group(c("n"), c("s11"), c("chg"), c("uns"), c("ndvi")).alias("grp"))


@entry(
    "lod_verdicts",
    """SELECT o_orderkey AS id, o_orderkey % 60 AS n, CASE WHEN o_custkey % 5 > 0 THEN (o_custkey % 24) / 16e0 END AS top, CASE WHEN o_custkey % 7 > 0 THEN (o_orderkey % 22) / 2e0 END AS ab, (o_custkey % 23) / 2e0 AS dr, (o_orderkey % 11) / 2e0 AS mi,
    CASE WHEN o_orderkey % 8 > 0 THEN (o_orderkey % 41) * 1e0 END AS w12, (o_custkey % 41) * 1e0 AS w20, (o_orderkey % 24) / 16e0 AS p12, (o_custkey % 25) / 16e0 AS p20 FROM orders""",
    """, k AS (SELECT *, concat_ws(';', CASE WHEN top > 1 THEN 'TOP_ABOVE_LIDAR' END, CASE WHEN ab >= 10 THEN 'ABOVE_1M' END, CASE WHEN dr >= 10 THEN 'DROPPED' END, CASE WHEN mi >= 5 THEN 'MISSING' END) AS why,
    (w20 - w12 >= 10 OR p12 - p20 >= 0.5) AS up, (w12 - w20 >= 10 OR p20 - p12 >= 0.5) AS down FROM i)
    SELECT id, CASE WHEN n < 20 THEN 'too-few' WHEN why <> '' THEN 'broken' WHEN w12 IS NULL THEN 'better' WHEN up = down THEN 'same' WHEN up THEN 'better' ELSE 'worse' END AS verdict,
    CASE WHEN n < 20 THEN '' WHEN why <> '' THEN why WHEN w12 IS NULL THEN 'NO_LOD12' WHEN up AND down THEN 'MIXED' ELSE '' END AS reasons FROM k""",
)
def lod_verdicts(df: DataFrame) -> DataFrame:
    args = [c(x) for x in ("n", "top", "ab", "dr", "mi", "w12", "w20", "p12", "p20")]
    return df.select("id", rules.lod_verdict(*args).alias("v")).select("id", "v.*")


@entry(
    "roof_queue",
    """SELECT o_orderkey AS id, CASE o_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Esri LOD1.2' WHEN 2 THEN 'Esri LOD2.0' WHEN 3 THEN '' ELSE 'Hybrid' END AS level,
    CASE o_orderkey % 7 WHEN 0 THEN 'PARTIAL_AOI;NEGATIVE_HEIGHT' WHEN 1 THEN 'NO_ROOF_SUPPORT' WHEN 2 THEN NULL WHEN 3 THEN 'LOW_ROOF_SUPPORT' WHEN 4 THEN 'GEOMETRY_REPAIRED;NO_CELL_CENTERS' ELSE 'OK' END AS status FROM orders""",
    """, k AS (SELECT *, list_filter([CASE WHEN coalesce(level, '') = '' THEN 'NO_HYBRID_MODEL' WHEN level LIKE '%LOD1.2' THEN 'BLOCK_FALLBACK' WHEN level LIKE '%LOD2.0' THEN 'LOD20_FALLBACK' END] ||
    list_filter(['NO_ROOF_SUPPORT', 'NO_CELL_CENTERS', 'LOW_ROOF_SUPPORT', 'NEGATIVE_HEIGHT', 'PARTIAL_AOI', 'GEOMETRY_REPAIRED'], lambda f: contains(coalesce(status, ''), f)), lambda f: f IS NOT NULL) AS fl FROM i)
    SELECT id, CASE WHEN len(fl) = 0 THEN 4 WHEN list_has_any(fl, ['NO_HYBRID_MODEL', 'NO_ROOF_SUPPORT', 'NO_CELL_CENTERS']) THEN 1 ELSE 2 END AS priority, CASE WHEN len(fl) = 0 THEN 'ROUTINE_REVIEW' ELSE array_to_string(fl, ';') END AS flags FROM k""",
)
def roof_queue(df: DataFrame) -> DataFrame:
    return df.select("id", rules.roof_queue(c("level"), c("status")).alias("q")).select("id", "q.*")


@entry(
    "likely_types",
    """SELECT o_orderkey AS id, (o_custkey % 400) * 1e0 AS area, (o_orderkey % 80) / 10e0 AS p95, CASE WHEN o_custkey % 3 = 0 THEN 'flat or nearly flat' ELSE 'pitched' END AS form,
    CASE o_orderkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'C' WHEN 2 THEN 'I' END AS lot_use, o_custkey % 2 AS county, o_orderkey % 3 AS units FROM orders""",
    """, k AS (SELECT *, coalesce(form LIKE 'flat%' AND p95 < 3.2, false) AS fl, p95 < 4.5 AS lo, coalesce(lot_use = 'R' AND units = 1 AND area >= 80 AND p95 >= 4.5, false) AS home FROM i),
    t AS (SELECT *, CASE WHEN coalesce(lot_use, '') IN ('C', 'I') AND area >= 40 THEN (CASE WHEN lo THEN 'Covered parking, canopy or low commercial structure' ELSE 'Commercial/industrial building' END)
    WHEN area < 15 THEN 'Small shed, playhouse or shade structure' WHEN area < 40 AND fl THEN 'Carport, shade or patio cover' WHEN area < 40 AND lo THEN 'Shed or single garage' WHEN area < 40 THEN 'Small tall structure (shed, tower, tree?)'
    WHEN area < 80 AND fl THEN 'Carport or covered parking' WHEN area < 80 AND lo THEN 'Garage or large shed' WHEN area < 80 THEN 'Two-storey garage or small ADU'
    WHEN area < 150 AND lo THEN 'Large garage, workshop or covered parking' WHEN area < 150 THEN 'House-sized: ADU or unmapped house' WHEN area < 300 AND lo THEN 'Large garage, barn or carport row' WHEN area < 300 THEN 'House or small multi-unit building'
    WHEN lo THEN 'Large low structure: covered parking, warehouse or canopy' ELSE 'Large building: apartments, commercial or institutional' END AS kind FROM k)
    SELECT id, CASE WHEN home AND county = 0 THEN 'House: the parcel''s main building, with no county footprint' WHEN home THEN 'House-sized: ADU, second house or large garage with living space'
    WHEN county = 0 AND area >= 80 AND NOT lo THEN kind || '; no county building on this parcel' ELSE kind END AS kind FROM t""",
)
def likely_types(df: DataFrame) -> DataFrame:
    args = [c(x) for x in ("area", "p95", "form", "lot_use", "county", "units")]
    return df.select("id", rules.likely_type(*args).alias("kind"))
