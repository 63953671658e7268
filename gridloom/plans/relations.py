"""Point, cell, detection and review relations over the driver's tables.

Coordinates come from integer arithmetic, so both engines agree bit for bit.
Each entry is a common table expression; ``needs`` pulls in those it reads.
"""

from __future__ import annotations


def relations(d) -> dict[str, str]:
    off = d.offsets
    return {
        # decoded returns: a 100 m square, heights up to 50 m
        "pts": """SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS pid,
  ((l_orderkey * 31 + l_linenumber * 7) % 400) * 0.25e0 AS x, ((l_partkey * 17 + l_suppkey * 13) % 400) * 0.25e0 AS y,
  l_quantity AS z, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 6 ELSE 5 END AS cls, l_linenumber % 3 + 1 AS rn, 3 AS rc,
  CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END AS flags, l_suppkey, l_partkey FROM lineitem""",
        # half-metre cells with the canopy height model
        "chm": """SELECT cx, cy, veg, bld, dtm, CASE WHEN dtm IS NULL OR (veg IS NULL AND non IS NULL) THEN NULL
  WHEN veg IS NULL OR (bld IS NOT NULL AND bld > veg + 0.35e0) THEN 0e0 WHEN veg - dtm < 0 THEN 0e0 ELSE veg - dtm END AS chm
  FROM (SELECT cast(floor(x / 0.5e0) AS BIGINT) AS cx, cast(floor(y / 0.5e0) AS BIGINT) AS cy,
    max(CASE WHEN cls = 5 AND rn = 1 THEN z END) AS veg, max(CASE WHEN cls = 6 AND rn = 1 THEN z END) AS bld,
    min(CASE WHEN cls = 2 THEN z END) AS dtm, max(CASE WHEN rn = 1 AND cls IN (2, 6) THEN 1 END) AS non
    FROM pts WHERE flags = 0 GROUP BY 1, 2) raw""",
        # two-metre cells of highest return
        "cells": """SELECT cast(floor(x / 2e0) AS BIGINT) AS cx, cast(floor(y / 2e0) AS BIGINT) AS cy, max(z) AS z,
  count(*) AS n, sum(CASE WHEN cls = 6 THEN 1 ELSE 0 END) AS n6, sum(CASE WHEN cls = 5 THEN 1 ELSE 0 END) AS nveg FROM pts WHERE flags = 0 GROUP BY 1, 2""",
        "tops": """SELECT event_id AS id, ((event_id * 37 + user_id * 11) % 2000) * 0.5e0 AS x, ((event_id * 53 + user_id * 29) % 2000) * 0.5e0 AS y,
  abs(value) AS h, event_type, user_id FROM events""",
        # rectangular parcels of 50 m by 40 m, with owners; each tenth overlaps its neighbour
        "parcels": """SELECT s_suppkey AS pid, s_name AS owner, s_nationkey, (s_suppkey % 20) * 50e0 AS x0, ((s_suppkey * 7) % 25) * 40e0 AS y0,
  (s_suppkey % 20) * 50e0 + 50e0 + CASE WHEN s_suppkey % 10 = 0 THEN 10e0 ELSE 0e0 END AS x1, ((s_suppkey * 7) % 25) * 40e0 + 40e0 AS y1 FROM supplier""",
        "units": """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
  CASE WHEN d.n_chars < 800 THEN 'SHORT' WHEN d.n_chars < 3000 THEN 'MEDIUM' ELSE 'LONG' END AS stratum FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
        "near": f"SELECT dx, dy FROM {off([-1, 0, 1], 'dx')} a CROSS JOIN {off([-1, 0, 1], 'dy')} b",
        # repeated interpretations of the same order: three to five votes
        "votes": """SELECT l_orderkey AS unit, l_linenumber AS turn, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 6 ELSE 5 END AS code FROM lineitem WHERE l_linenumber <= 5""",
    }


NEEDS = {"chm": ["pts"], "cells": ["pts"]}


def with_relations(sql: str, names: list[str], d) -> str:
    every, order = relations(d), []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return sql
    head = ",\n".join(f"{n} AS ({every[n]})" for n in order)
    body = sql.strip()
    return f"WITH {head}" + (",\n" + body[5:] if body[:5].upper() == "WITH " else f"\n{body}")
