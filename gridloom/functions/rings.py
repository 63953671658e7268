"""Polygons as arrays of rings, in column expressions.

A polygon is ``array<array<struct<x, y>>>``: outer rings and holes together, told
apart by the even-odd rule.  A ring may or may not repeat its first place.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RINGS = "array<array<struct<x: double, y: double>>>"


def _fold(items: Column, value, zero: Column) -> Column:
    return F.aggregate(items, zero, lambda acc, item: acc + value(item))


def edges(rings: Column) -> Column:
    """All edges of all rings: array of (x0, y0, x1, y1)."""
    def of(ring: Column) -> Column:
        closed = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, closed, lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), of))


def ring_area(ring: Column) -> Column:
    """Signed area; positive where the ring runs counter-clockwise."""
    return _fold(edges(F.array(ring)), lambda e: (e["x0"] * e["y1"] - e["x1"] * e["y0"]) / 2, F.lit(0.0))


def area(rings: Column) -> Column:
    """Net area of rings whose holes run against their outer ring."""
    return F.abs(_fold(edges(rings), lambda e: (e["x0"] * e["y1"] - e["x1"] * e["y0"]) / 2, F.lit(0.0)))


def perimeter(rings: Column) -> Column:
    return _fold(edges(rings), lambda e: F.hypot(e["x1"] - e["x0"], e["y1"] - e["y0"]), F.lit(0.0))


def bounds(rings: Column) -> Column:
    """(xmin, ymin, xmax, ymax)."""
    every = F.flatten(rings)
    pick = lambda how, name: how(F.transform(every, lambda p: p[name]))
    return F.struct(
        pick(F.array_min, "x").alias("xmin"), pick(F.array_min, "y").alias("ymin"), pick(F.array_max, "x").alias("xmax"), pick(F.array_max, "y").alias("ymax")
    )


def is_upright(rings: Column) -> Column:
    """Whether a polygon is one ring of four corners (the first may be repeated)
    around an upright rectangle."""
    ring = F.get(rings, F.lit(0))
    at = [F.get(ring, F.lit(i)) for i in range(5)]
    turns = lambda u, v: (at[0][u] == at[1][u]) & (at[1][v] == at[2][v]) & (at[2][u] == at[3][u]) & (at[3][v] == at[0][v])
    closed = (F.size(ring) == 5) & (at[0]["x"] == at[4]["x"]) & (at[0]["y"] == at[4]["y"])
    return (F.size(rings) == 1) & ((F.size(ring) == 4) | closed) & (turns("x", "y") | turns("y", "x"))


def crossings(x: Column, y: Column, edge_list: Column) -> Column:
    """Edges crossed by the ray from a place to the right."""
    crossed = lambda e: ((e["y0"] > y) != (e["y1"] > y)) & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"])
    return F.size(F.filter(edge_list, crossed))


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd test over all rings, holes included."""
    return crossings(x, y, edges(rings)) % 2 == 1


def edge_distance(x: Column, y: Column, rings: Column) -> Column:
    """Distance to the nearest edge, from within and without."""
    return nearest_edge(x, y, edges(rings))


def nearest_edge(x: Column, y: Column, edge_list: Column) -> Column:
    def to(e: Column) -> Column:
        dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
        length = dx * dx + dy * dy
        t = F.least(F.greatest(((x - e["x0"]) * dx + (y - e["y0"]) * dy) / F.when(length == 0, F.lit(1.0)).otherwise(length), F.lit(0.0)), F.lit(1.0))
        return F.hypot(x - (e["x0"] + t * dx), y - (e["y0"] + t * dy))

    return F.array_min(F.transform(edge_list, to))


def box_distance(x: Column, y: Column, box: Column) -> Column:
    dx = F.greatest(box["xmin"] - x, F.lit(0.0), x - box["xmax"])
    dy = F.greatest(box["ymin"] - y, F.lit(0.0), y - box["ymax"])
    return F.hypot(dx, dy)


def boxes_overlap(a: Column, b: Column, closed: bool = True) -> Column:
    """Whether two boxes meet; open boxes do not meet in a shared edge."""
    below = (lambda u, v: u <= v) if closed else (lambda u, v: u < v)
    return below(a["xmin"], b["xmax"]) & below(b["xmin"], a["xmax"]) & below(a["ymin"], b["ymax"]) & below(b["ymin"], a["ymax"])


def in_box(x: Column, y: Column, box: Column, closed: bool = True) -> Column:
    """Closed, or half-open on the upper sides, so that neighbours never both claim a place."""
    upper = (lambda u, v: u <= v) if closed else (lambda u, v: u < v)
    return (x >= box["xmin"]) & upper(x, box["xmax"]) & (y >= box["ymin"]) & upper(y, box["ymax"])


def row_spans(edge_list: Column, yc: Column) -> Column:
    """Pairs (left, right) between which a horizontal line lies inside."""
    hit = F.filter(edge_list, lambda e: (e["y0"] <= yc) != (e["y1"] <= yc))
    xs = F.array_sort(F.transform(hit, lambda e: e["x0"] + (yc - e["y0"]) / (e["y1"] - e["y0"]) * (e["x1"] - e["x0"])))
    return F.when(
        F.size(xs) > 1,
        F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1), lambda i: F.struct(F.get(xs, 2 * i).alias("a"), F.get(xs, 2 * i + 1).alias("b"))),
    )


def _vector(ring: Column, u: str, v: str) -> Column:
    """One component of a closed 3-D ring's vector area."""
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, nxt, lambda a, b: (a[u] * b[v] - a[v] * b[u]) / 2), F.lit(0.0), lambda s, t: s + t)


def plane_face(ring: Column, flat: float = 0.5) -> Column:
    """(plan, area, slope, azimuth) of a planar 3-D ring (x, y, z): areas in plan
    and in space, slope in degrees, bearing of the downhill direction (null when flat)."""
    nx, ny, nz = _vector(ring, "y", "z"), _vector(ring, "z", "x"), _vector(ring, "x", "y")
    size = F.sqrt(nx * nx + ny * ny + nz * nz)
    sign = F.when(nz < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    slope = F.when(size > 0, F.degrees(F.acos(F.least(F.lit(1.0), F.abs(nz) / size)))).otherwise(F.lit(0.0))
    bearing = F.degrees(F.atan2(sign * nx, sign * ny))
    return F.struct(
        F.abs(nz).alias("plan"), size.alias("area"), slope.alias("slope"), F.when(slope >= flat, F.when(bearing < 0, bearing + 360).otherwise(bearing)).alias("azimuth")
    )


def flatten_curve(p0: Column, c1: Column, c2: Column, p1: Column, steps: int = 8) -> Column:
    """Places on a cubic curve, the last at its end."""
    def at(t: float) -> Column:
        s = 1 - t
        w = (s**3, 3 * s * s * t, 3 * s * t * t, t**3)
        mix = lambda name: sum(p[name] * k for p, k in zip((p0, c1, c2, p1), w))
        return F.struct(mix("x").alias("x"), mix("y").alias("y"))

    return F.array(*[at(i / steps) for i in range(1, steps + 1)])


def oriented(rings: Column) -> Column:
    """Rings turned by nesting depth: outer ones clockwise, holes counter-clockwise."""
    def turned(ring: Column, i: Column) -> Column:
        first = F.get(ring, F.lit(0))
        depth = F.aggregate(
            F.transform(rings, lambda other, j: F.when(i != j, (crossings(first["x"], first["y"], edges(F.array(other))) % 2)).otherwise(F.lit(0))), F.lit(0), lambda s, t: s + t
        )
        clockwise = ring_area(ring) < 0
        return F.when(clockwise == (depth % 2 == 0), ring).otherwise(F.reverse(ring))

    return F.transform(rings, turned)
