"""One-to-one matching of two point sets within a radius."""

from __future__ import annotations

import math
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gridloom.plans.components import TOGETHER, connected_components
from gridloom.plans.staging import materialize

#: Places whose components are solved together, about.
PLACES = 20_000
#: Above so many places, rows inside of blocks are assigned ahead, in parallel.
AHEAD = 100_000


def radius_pairs(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """(lid, rid, d2) of all points (id, x, y) within ``radius``, inclusive.

    An equi-join on square bins of that size; only the left side is repeated
    over the nine bins around it."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    near = left.select(F.col("id").alias("lid"), F.col("x").alias("lx"), F.col("y").alias("ly"), F.explode(step).alias("dx"), F.lit(0).alias("z"))
    near = near.withColumn("dy", F.explode(step))
    near = near.withColumns({"bx": F.floor(F.col("lx") / radius).cast("long") + F.col("dx"), "byy": F.floor(F.col("ly") / radius).cast("long") + F.col("dy")})
    far = right.select(F.col("id").alias("rid"), F.col("x").alias("rx"), F.col("y").alias("ry"), cell("x").alias("bx"), cell("y").alias("byy"))
    d2 = (F.col("lx") - F.col("rx")) * (F.col("lx") - F.col("rx")) + (F.col("ly") - F.col("ry")) * (F.col("ly") - F.col("ry"))
    return near.join(far, ["bx", "byy"]).select("lid", "rid", d2.alias("d2")).where(F.col("d2") <= radius * radius)


def assignment(cost: np.ndarray) -> np.ndarray:
    """Column of each row in a cheapest assignment (rows <= columns), by
    shortest augmenting paths on reduced costs."""
    n, m = cost.shape
    u, v, owner, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            row = cost[owner[j0] - 1] - u[owner[j0]] - v[1:]
            better = ~used[1:] & (row < least[1:])
            least[1:][better] = row[better]
            way[1:][better] = j0
            free = np.where(used, np.inf, least)
            free[0] = np.inf
            j1 = int(free.argmin())
            delta = free[j1]
            u[owner[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if owner[j0] == 0:
                break
        while j0:
            owner[j0] = owner[way[j0]]
            j0 = way[j0]
    out = np.full(n, -1)
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out


def sparse_assignment(n: int, m: int, start: np.ndarray, column: np.ndarray, cost: np.ndarray, absent: float) -> np.ndarray:
    """Column of each of n rows, or -1 where it stays alone at cost ``absent``,
    in a cheapest assignment over the pairs given.  Row i has the columns
    ``column[start[i]:start[i + 1]]``.

    Shortest augmenting paths on reduced costs, over a heap; a path ends at a
    free column or at a row that is given up.  Memory is that of the pairs."""
    start, column, cost = start.tolist(), column.tolist(), cost.tolist()
    v, owner, held = [0.0] * m, [-1] * m, [-1] * n
    u = [0.0] * n
    for i in range(n):
        dist, way, done, heap, closed = {}, {}, [], [], set()
        row, far = i, 0.0
        seen = [(i, 0.0)]
        alone, alone_row = absent - u[i], i
        while True:
            for e in range(start[row], start[row + 1]):
                j = column[e]
                if j in closed:  # rounding must not change a path that is settled
                    continue
                d = far + cost[e] - u[row] - v[j]
                if d < dist.get(j, np.inf):
                    dist[j], way[j] = d, row
                    heappush(heap, (d, j))
            while heap and heap[0][0] > dist[heap[0][1]]:
                heappop(heap)
            if not heap or heap[0][0] >= alone:
                end, far = -1, alone
                break
            far, j = heappop(heap)
            if owner[j] < 0:
                end = j
                break
            done.append((j, far))
            closed.add(j)
            row = owner[j]
            seen.append((row, far))
            if far + absent - u[row] < alone:
                alone, alone_row = far + absent - u[row], row
        for r, d in seen:
            u[r] += far - d
        for j, d in done:
            v[j] -= far - d
        if end < 0:  # alone_row gives its column up, and the path goes from there
            end, held[alone_row] = held[alone_row], -1
            if alone_row == i:
                continue
        while True:
            r = way[end]
            owner[end], held[r], end = r, end, held[r]
            if r == i:
                break
    return np.array(held)


def _best(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.drop_duplicates(["lid", "rid"])
    lefts, rights = np.unique(pdf["lid"]), np.unique(pdf["rid"])
    turn = len(lefts) > len(rights)
    rows, columns = np.searchsorted(lefts, pdf["lid"]), np.searchsorted(rights, pdf["rid"])
    if turn:
        rows, columns = columns, rows
    n, m = min(len(lefts), len(rights)), max(len(lefts), len(rights))
    dist = np.sqrt(pdf["d2"].to_numpy())
    absent = (dist.max() + 1) * (n + 1)  # one more pair outweighs any distance
    order = np.lexsort((columns, rows))
    rows, columns, dist = rows[order], columns[order], dist[order]
    start = np.searchsorted(rows, np.arange(n + 1))
    picked = sparse_assignment(n, m, start, columns, dist, absent)
    i = np.flatnonzero(picked >= 0)
    at = np.searchsorted(rows * m + columns, i * m + picked[i])
    r, c = (picked[i], i) if turn else (i, picked[i])
    return pd.DataFrame({"lid": lefts[r], "rid": rights[c], "distance": dist[at]})


class _Near:
    """For a row's place the columns' places within the radius, nearest first, and
    their distances; found when they are asked for, some rows at a time."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, radius: float) -> None:
        self.rows, self.columns, self.radius = rows, columns, radius
        low = np.floor(np.minimum(rows.min(axis=0), columns.min(axis=0)) / radius).astype(np.int64) - 1
        mine, theirs = (np.floor(p / radius).astype(np.int64) - low for p in (rows, columns))
        wide = int(max(mine[:, 1].max(), theirs[:, 1].max())) + 3
        key = theirs[:, 0] * wide + theirs[:, 1]
        self.order = np.argsort(key, kind="stable")
        key = key[self.order]
        base = (mine[:, 0, None] + np.array([-1, 0, 1])) * wide + mine[:, 1, None]
        self.first = np.searchsorted(key, base - 1, "left")
        self.length = np.searchsorted(key, base + 1, "right") - self.first
        self.known: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(rows)

    def find(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        a = row // 64 * 64
        b = min(a + 64, len(self.rows))
        while b - a > 1 and self.length[a:b].sum() > TOGETHER:  # crowded
            half = (a + b) // 2
            a, b = (a, half) if row < half else (half, b)
        f, n = self.first[a:b].ravel(), self.length[a:b].ravel()
        at = self.order[np.arange(n.sum()) + np.repeat(f - np.cumsum(n) + n, n)]
        of = np.repeat(np.arange(a, b), self.length[a:b].sum(axis=1))
        dx, dy = self.rows[of, 0] - self.columns[at, 0], self.rows[of, 1] - self.columns[at, 1]
        d2 = dx * dx + dy * dy
        near = np.flatnonzero(d2 <= self.radius * self.radius)
        near = near[np.lexsort((d2[near], of[near]))]
        ends = np.cumsum(np.bincount(of[near] - a, minlength=b - a))[:-1]
        self.known[a:b] = zip(np.split(at[near].astype(np.int32), ends), np.split(np.sqrt(d2[near]), ends))
        return self.known[row]


def transport(supply: np.ndarray, room: np.ndarray, near: _Near, absent: float, todo: np.ndarray | None = None, state: tuple | None = None) -> tuple[np.ndarray, ...]:
    """(row, column, units, duals of rows, duals of columns) of a cheapest assignment
    of each row's ``supply`` to columns that have ``room`` for so many, where a unit
    that stays alone costs ``absent``.  ``near`` has a row's columns, cheapest first.

    ``state`` is what an earlier call gave for some of the rows, and ``todo`` are the
    rows that are added to these; the order of rows does not matter.

    As ``sparse_assignment``, with as many units a path as fit.  Duals of columns
    are never above 0, so a row's columns are looked at only up to the cost at which
    a path with an end is already known."""
    n, m = len(supply), len(room)
    rest, room = supply.tolist(), room.tolist()
    u, v = [0.0] * n, [0.0] * m
    held: list[dict[int, int] | None] = [None] * m  # units of each row
    order = np.random.default_rng(n).permutation(n)
    order = (order if todo is None else order[todo[order]]).tolist()
    if state is not None:
        u, v = state[3].tolist(), state[4].tolist()
        for row, j, k in zip(*(x.tolist() for x in state[:3])):
            room[j] -= k
            if held[j] is None:
                held[j] = {}
            held[j][row] = k
    inf = float("inf")
    for i in order:
        while rest[i]:
            dist, way, heap, closed, done = {}, {}, [], set(), []
            seen, via, turns = [(i, 0.0)], {i: -1}, 0
            far, best, end, end_row = 0.0, absent - u[i], -1, i
            while True:
                while turns < len(seen):
                    row, far_row = seen[turns]
                    turns += 1
                    base = far_row - u[row]
                    if base + absent < best:
                        best, end, end_row = base + absent, -1, row
                    column, cost = near.known[row] or near.find(row)
                    a, z, width = 0, len(column), 12
                    while a < z:
                        b = min(a + width, z)
                        for j, w in zip(column[a:b].tolist(), cost[a:b].tolist()):
                            d = base + w
                            if d >= best:
                                b = z
                                break
                            d -= v[j]
                            if d < best and d < dist.get(j, inf) and j not in closed:
                                dist[j], way[j] = d, row
                                if room[j]:
                                    best, end = d, j
                                else:
                                    heappush(heap, (d, j))
                        a, width = b, width * 4
                while heap and (heap[0][0] > dist[heap[0][1]] or heap[0][1] in closed):
                    heappop(heap)
                if not heap or heap[0][0] >= best:
                    break
                far, j = heappop(heap)
                closed.add(j)
                done.append((j, far))
                for row in held[j]:
                    if row not in via:
                        via[row] = j
                        seen.append((row, far))
            far = best
            for r, d in seen:
                u[r] += far - d
            for j, d in done:
                v[j] -= far - d
            # the path backwards: how many units fit, then they move
            units, row, j = rest[i], end_row, end
            if end >= 0:
                units, row = min(units, room[end]), way[end]
            while row != i:
                units = min(units, held[via[row]][row])
                row = way[via[row]]
            row = end_row
            if end >= 0:
                room[end] -= units
                row = way[end]
                if held[end] is None:
                    held[end] = {}
                held[end][row] = held[end].get(row, 0) + units
            while row != i:
                of = held[via[row]]
                of[row] -= units
                if not of[row]:
                    del of[row]
                row = way[via[row]]
                of[row] = of.get(row, 0) + units
            rest[i] -= units
    found = [(r, j, k) for j, of in enumerate(held) if of for r, k in of.items()]
    return *np.array(found, np.int64).reshape(-1, 3).T, np.array(u), np.array(v)


def _inside(xy: np.ndarray, size: float, levels: int, radius: float) -> np.ndarray:
    """Whether all within the radius is in the same block, of any of the levels;
    blocks of a level are three by three of the one below."""
    far = radius * (1 + 1e-9) + 1e-12 * np.abs(xy)
    low, high = np.floor((xy - far) / size), np.floor((xy + far) / size)
    out = np.zeros(len(xy), bool)
    for k in range(levels):
        out |= (np.floor(low / 3**k) == np.floor(high / 3**k)).all(axis=1)
    return out


def _at(places: np.ndarray, x: pd.Series, y: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Where points are among places in order, and which are there."""
    mine, theirs = places[:, 0] + 1j * places[:, 1], x.to_numpy(float) + 1j * y.to_numpy(float)
    at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
    return at, mine[at] == theirs


def _resumed(rows: np.ndarray, columns: np.ndarray, state: pd.DataFrame) -> tuple:
    """State of ``transport`` from (x, y, cx, cy, units, dual): units of a row's place
    in a column's, or, without units, the dual of a column (of a row where cx is null)."""
    u, v = np.zeros(len(rows)), np.zeros(len(columns))
    of_row = state["cx"].isna()
    for out, places, some in ((u, rows, state[of_row]), (v, columns, state[~of_row & (state["units"] == 0)])):
        at, there = _at(places, some["x"], some["y"])
        out[at[there]] = some["dual"].to_numpy()[there]
    flows = state[state["units"] > 0]
    i, found = _at(rows, flows["x"], flows["y"])
    j, _ = _at(columns, flows["cx"], flows["cy"])
    return i[found], j[found], flows["units"].to_numpy(np.int64)[found], u, v


def _block(radius: float, turn: bool, absent: float, size: float, level: int):
    """Places (x, y, right, units) of a block of a level and its state so far: the
    state with the rows that lie inside of it."""

    def run(places: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        names = ["x", "y", "cx", "cy", "units", "dual"]
        places = places.sort_values(["x", "y"])
        of_row = places["right"].to_numpy(bool) == turn
        rows, columns = (places.loc[side, ["x", "y"]].to_numpy(float) for side in (of_row, ~of_row))
        if not len(rows) or not len(columns):
            return state[names]
        supply, room = (places.loc[side, "units"].to_numpy(np.int64) for side in (of_row, ~of_row))
        todo = _inside(rows, size, level + 1, radius) & ~_inside(rows, size, level, radius)
        i, j, units, u, v = transport(supply, room, _Near(rows, columns, radius), absent, todo, _resumed(rows, columns, state))
        held, low, none = np.unique(i), np.flatnonzero(v < 0), lambda x: np.full(len(x), np.nan)
        parts = (
            (rows[i, 0], rows[i, 1], columns[j, 0], columns[j, 1], units, none(i)),
            (rows[held, 0], rows[held, 1], none(held), none(held), np.zeros(len(held), np.int64), u[held]),
            (columns[low, 0], columns[low, 1], columns[low, 0], columns[low, 1], np.zeros(len(low), np.int64), v[low]),
        )
        return pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*parts)))))

    return run


def _ahead(points: DataFrame, radius: float, turn: bool, absent: float) -> tuple[DataFrame | None, float, int]:
    """State of the rows that lie inside of blocks, the blocks' size, and the levels.

    A row all of whose columns are in its block meets no column of another, so blocks
    are assigned apart, and together are a cheapest assignment of their rows; larger
    blocks, and in the end the whole, add the rows that were too near to a border."""
    places = materialize(points.groupBy("x", "y", "right").agg(F.count("*").alias("units")), "match-ahead")
    n, *ends = places.agg(F.count("*"), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if n <= AHEAD or not all(map(math.isfinite, ends)) or radius <= 0:
        return None, 0.0, 0
    wide, high = ends[1] - ends[0], ends[3] - ends[2]
    size = max(20 * radius, math.sqrt(max(wide, radius) * max(high, radius) * PLACES / n))
    state, level = places.limit(0).select("x", "y", F.col("x").alias("cx"), F.col("y").alias("cy"), "units", F.col("x").alias("dual")), 0
    while size * 3**level < max(wide, high):
        key = [F.floor(F.floor(F.col(c) / size) / 3**level).cast("long").alias("b" + c) for c in "xy"]
        blocks = min(2_000, 4 * (1 + int(wide / size / 3**level)) * (1 + int(high / size / 3**level)))
        dealt = lambda df: df.select("*", *key).repartition(blocks, "bx", "by").groupBy("bx", "by")  # noqa: B023, E731
        found = dealt(places).cogroup(dealt(state)).applyInPandas(_block(radius, turn, absent, size, level), "x double, y double, cx double, cy double, units long, dual double")
        state, level = materialize(found, "match-ahead"), level + 1
    return (state, size, level) if level else (None, 0.0, 0)


def _matched(radius: float, turn: bool | None = None, absent: float = 0.0, size: float = 0.0, levels: int = 0):
    """Points (id, x, y, right) of whole components: their matching; with ``turn``,
    from the state of the rows that lie inside of blocks."""

    def run(pdf: pd.DataFrame, state: pd.DataFrame | None = None) -> pd.DataFrame:
        right = pdf["right"].to_numpy(bool)
        ids, xy = pdf["id"].to_numpy(np.int64), pdf[["x", "y"]].to_numpy(float)
        del pdf
        turned = bool((~right).sum() > right.sum()) if turn is None else turn
        sides = []
        for one in (right if turned else ~right, ~right if turned else right):
            own = xy[one]
            by = np.lexsort((ids[one], own[:, 1], own[:, 0]))
            own = own[by]
            new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]).any(axis=1)))[: len(own)])
            sides.append((ids[one][by], new, np.diff(np.append(new, len(own))), own[new]))
        del right, ids, xy, one, own, by, new
        (row_ids, row_at, supply, rows), (column_ids, column_at, room, columns) = sides
        out = pd.DataFrame({"lid": np.zeros(0, np.int64), "rid": np.zeros(0, np.int64), "distance": np.zeros(0)})
        if not len(rows) or not len(columns):
            return out
        near = _Near(rows, columns, radius)
        if state is None:
            i, j, units, *_ = transport(supply, room, near, (radius + 1) * (int(supply.sum()) + 1))
        else:
            state = _resumed(rows, columns, state)
            i, j, units, *_ = transport(supply, room, near, absent, ~_inside(rows, size, levels, radius), state)
        if not len(i):
            return out
        taken = lambda place, at: at[place] + _running(place, units)  # noqa: E731  units of a place go in turn
        a, b = taken(i, row_at), taken(j, column_at)
        each = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
        a, b = row_ids[np.repeat(a, units) + each], column_ids[np.repeat(b, units) + each]
        away = rows[i] - columns[j]
        out = {"lid": b, "rid": a} if turned else {"lid": a, "rid": b}
        return pd.DataFrame(out | {"distance": np.repeat(np.sqrt(away[:, 0] ** 2 + away[:, 1] ** 2), units)})

    def alone(pdf: pd.DataFrame) -> pd.DataFrame:  # Spark counts the arguments
        return run(pdf)

    return alone if turn is None else run


def _running(place: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Units of the same place that stand before."""
    by = np.argsort(place, kind="stable")
    before = np.cumsum(units[by]) - units[by]
    new = np.concatenate(([True], np.diff(place[by]) != 0))
    out = np.empty(len(place), np.int64)
    out[by] = before - before[new][np.cumsum(new) - 1]
    return out


def _components(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """(x, y, part) of the places that have a partner's place within the radius: a
    component lies in one part, small ones share parts.

    What stands in one bin is within the radius, so a bin with both sides is one
    node, any other place is its own; only different pairs of nodes are written."""
    at = lambda c: F.floor(F.col(c) / (radius / 1.5)).alias("b" + c)
    sides = left.select("x", "y", F.lit(0).alias("side")).unionByName(right.select("x", "y", F.lit(1).alias("side"))).groupBy("x", "y").agg(F.min("side").alias("low"), F.max("side").alias("high"))
    places = materialize(sides.withColumn("p", F.monotonically_increasing_id()), "match-places")
    binned = places.select("*", at("x"), at("y"))
    bins = binned.groupBy("bx", "by").agg(F.min("p").alias("first"), (F.min("low") < F.max("high")).alias("both"))
    nodes = materialize(binned.join(bins, ["bx", "by"]).select("x", "y", "low", "high", F.when(F.col("both"), F.col("first")).otherwise(F.col("p")).alias("id"), "both"), "match-nodes")
    edges = radius_pairs(nodes.where("low = 0"), nodes.where("high = 1"), radius).where("lid <> rid").select(F.col("lid").alias("a"), F.col("rid").alias("b")).distinct()
    found = connected_components(edges)
    return nodes.join(found.withColumnRenamed("node", "id"), "id", "left").where("both or component is not null").select("x", "y", F.pmod(F.xxhash64(F.coalesce("component", "id")), F.lit(1 + places.count() // PLACES)).alias("part"))


def match_one_to_one(left: DataFrame, right: DataFrame, radius: float, identity: bool = False) -> DataFrame:
    """(lid, rid, distance): most pairs, then least total distance.  Points form
    components; each is solved on its own, exactly.  With ``identity``, points of
    equal id within the radius are matched first and take no further part.

    A component's points meet, not its pairs: these are found where it is solved,
    once for all points of equal places.  A repeated id counts as one point that is
    at several places; where there are such ids, pairs are written."""
    whole = lambda df: df.select("id", "x", "y").where("id is not null and x is not null and y is not null and not isnan(x) and not isnan(y)")
    repeated = lambda df: not df.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    kinds = {dict(df.dtypes)["id"] for df in (left, right)}
    if not kinds <= {"bigint", "int", "smallint", "tinyint"} or repeated(whole(left)) or repeated(whole(right)):
        return _matched_pairs(left, right, radius, identity)
    left, right = (whole(df).select(F.col("id").cast("long").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")) for df in (left, right))
    same = None
    if identity:
        dx, dy = F.col("x") - F.col("rx"), F.col("y") - F.col("ry")
        same = left.join(right.select("id", F.col("x").alias("rx"), F.col("y").alias("ry")), "id").select("id", (dx * dx + dy * dy).alias("d2")).where(F.col("d2") <= radius * radius)
        same = materialize(same, "match-same")
        left, right = (df.join(same.select("id"), "id", "left_anti") for df in (left, right))
    points = left.withColumn("right", F.lit(False)).unionByName(right.withColumn("right", F.lit(True)))
    of_left, of_right = points.agg(F.count_if(~F.col("right")), F.count_if("right")).first()
    turn = of_left > of_right
    absent = (radius + 1) * (min(of_left, of_right) + 1)
    state, size, levels = _ahead(points, radius, turn, absent)
    schema = "lid long, rid long, distance double"
    parts = _components(left, right, radius)
    if state is None:
        found = points.join(parts, ["x", "y"]).select("part", "id", "x", "y", "right").groupBy("part").applyInPandas(_matched(radius), schema)
    else:
        parts = materialize(parts, "match-parts")
        tagged = points.join(parts, ["x", "y"]).select("part", "id", "x", "y", "right")
        ahead = state.join(parts, ["x", "y"]).select(F.col("part").alias("of"), "x", "y", "cx", "cy", "units", "dual")
        found = tagged.groupBy("part").cogroup(ahead.groupBy("of")).applyInPandas(_matched(radius, turn, absent, size, levels), schema)
    return found if same is None else found.unionByName(same.select(F.col("id").alias("lid"), F.col("id").alias("rid"), F.sqrt("d2").alias("distance")))


def _matched_pairs(left: DataFrame, right: DataFrame, radius: float, identity: bool) -> DataFrame:
    pairs = materialize(radius_pairs(left, right, radius), "match-pairs")
    same = None
    if identity:
        same = pairs.where("lid = rid")
        pairs = pairs.join(same.select("lid"), "lid", "left_anti").join(same.select("rid"), "rid", "left_anti").select("lid", "rid", "d2")
    edges = pairs.select((F.col("lid") * 2).alias("a"), (F.col("rid") * 2 + 1).alias("b"))
    comp = connected_components(edges)
    tagged = pairs.withColumn("node", F.col("lid") * 2).join(comp, "node")
    found = tagged.select("component", "lid", "rid", "d2").groupBy("component").applyInPandas(_best, "lid long, rid long, distance double")
    return found if same is None else found.unionByName(same.select("lid", "rid", F.sqrt("d2").alias("distance")))
