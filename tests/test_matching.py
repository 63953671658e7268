"""One-to-one matching where points are many: places with their numbers, no pairs of points."""

import math

import numpy as np
import pandas as pd

from gridloom.operators import matching as M


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_places_with_numbers_equal_the_pairs():
    rng = np.random.default_rng(3)
    for t in range(60):
        n, m, g = (int(k) for k in (*rng.integers(1, 40, 2), rng.integers(2, 25)))
        left, right = ((rng.integers(0, g, (k, 2)) * 0.5 if t % 3 else rng.random((k, 2)) * g / 2) - 3 for k in (n, m))
        xy = np.concatenate((left, right))
        got = M._matched(1.5)(pd.DataFrame({"id": np.concatenate((np.arange(n), np.arange(m) + 3)), "x": xy[:, 0], "y": xy[:, 1], "right": np.arange(n + m) >= n}))
        d2 = ((left[:, None] - right[None]) ** 2).sum(axis=2)
        i, j = np.nonzero(d2 <= 2.25)
        assert got["lid"].is_unique and got["rid"].is_unique and np.allclose(np.sqrt(d2[got["lid"], got["rid"] - 3]), got["distance"]) and (got["distance"] <= 1.5).all()
        want = M._best(pd.DataFrame({"lid": i, "rid": j + 3, "d2": d2[i, j]})) if len(i) else got
        assert len(got) == len(want) and abs(got["distance"].sum() - want["distance"].sum()) < 1e-9


def test_matching_writes_no_pairs_of_points(spark, monkeypatch):
    written, pairs = [], M.radius_pairs
    monkeypatch.setattr(M, "radius_pairs", lambda *a: written.append(pairs(*a)) or written[-1])
    left = frame(spark, [(i, i % 5 * 0.5, 0.0) for i in range(2_000)] + [(5_000, 400.0, 400.0), (5_001, None, 1.0)])
    right = frame(spark, [(i + 7, i % 4 * 0.5, 0.5) for i in range(1_500)] + [(9_000, 900.0, 0.0)])
    got = M.match_one_to_one(left, right, 1.0).collect()
    assert [w.count() < 100 for w in written] == [True]  # 2,000 by 1,500 points have over a million
    assert len(got) == 1_500 == len({r.lid for r in got}) == len({r.rid for r in got})
    assert all(abs(r.distance - math.dist((r.lid % 5 * 0.5, 0.0), ((r.rid - 7) % 4 * 0.5, 0.5))) < 1e-12 and r.distance <= 1 for r in got)


def test_equal_ids_first_and_repeated_ids(spark):
    rng = np.random.default_rng(8)
    left, right = ([(i, *map(float, rng.integers(0, 12, 2))) for i in range(40)] for _ in "ab")
    got = M.match_one_to_one(frame(spark, left), frame(spark, right), 4.0, identity=True).collect()
    old = M._matched_pairs(frame(spark, left), frame(spark, right), 4.0, True).collect()
    same = {a[0] for a, b in zip(left, right) if math.dist(a[1:], b[1:]) <= 4}
    assert same and {r.lid for r in got if r.lid == r.rid} >= same and len(got) == len(old) and abs(sum(r.distance for r in got) - sum(r.distance for r in old)) < 1e-9
    again = M.match_one_to_one(frame(spark, [(1, 0.0, 0.0), (1, 9.0, 0.0)]), frame(spark, [(1, 0.0, 1.0), (2, 9.0, 1.0)]), 2.0).collect()
    assert len(again) == 1  # one point, at two places


def test_rows_inside_of_blocks_are_assigned_ahead(spark, monkeypatch):
    """One component in many blocks: most of it is assigned in the blocks, and the whole stays the cheapest."""
    rng = np.random.default_rng(12)
    ahead, left_over = M._ahead, []
    monkeypatch.setattr(M, "AHEAD", 100)
    monkeypatch.setattr(M, "PLACES", 150)
    monkeypatch.setattr(M, "_ahead", lambda *a: left_over.append(ahead(*a)) or left_over[-1])
    for n, m in ((1_500, 1_400), (900, 1_300)):
        left, right = ([(i + 7 * k, *(float(x) for x in rng.integers(-70, 70, 2) * 0.5)) for i in range(k)] for k in (n, m))
        got = M.match_one_to_one(frame(spark, left), frame(spark, right), 1.5).collect()
        state, size, levels = left_over.pop()
        units = sum(r.units for r in state.collect())
        assert levels == 1 and size == 30.0 and units >= 0.6 * len(got)
        old = M._matched_pairs(frame(spark, left), frame(spark, right), 1.5, False).collect()
        assert len(got) == len(old) == len({r.lid for r in got}) == len({r.rid for r in got})
        assert abs(sum(r.distance for r in got) - sum(r.distance for r in old)) < 1e-6
        place = [{i: (x, y) for i, x, y in side} for side in (left, right)]
        assert all(math.dist(place[0][r.lid], place[1][r.rid]) == r.distance <= 1.5 for r in got)


def test_blocks_of_blocks_keep_what_is_assigned():
    rng = np.random.default_rng(2)
    xy = rng.integers(0, 90, (2_400, 2)) * 0.5
    right = np.arange(2_400) < 1_150
    places = pd.DataFrame({"x": xy[:, 0], "y": xy[:, 1], "right": right}).groupby(["x", "y", "right"]).size().reset_index(name="units")
    state, absent = pd.DataFrame({k: np.zeros(0) for k in ("x", "y", "cx", "cy", "units", "dual")}), 2.5 * 1_151
    for level in (0, 1):
        of = lambda df: [tuple(k) for k in (df[["x", "y"]] // 6 // 3**level).to_numpy()]  # noqa: B023, E731
        blocks = dict(list(places.groupby(pd.Series(of(places), index=places.index))))
        parts = dict(list(state.groupby(pd.Series(of(state), index=state.index)))) if len(state) else {}
        state = pd.concat([M._block(1.5, True, absent, 6.0, level)(p, parts.get(k, state.iloc[:0])) for k, p in blocks.items()], ignore_index=True)
    points = pd.DataFrame({"id": np.arange(2_400), "x": xy[:, 0], "y": xy[:, 1], "right": right})
    got, want = M._matched(1.5, True, absent, 6.0, 2)(points, state), M._matched(1.5)(points)
    assert state["units"].sum() > 0.5 * len(want) and len(got) == len(want) and abs(got["distance"].sum() - want["distance"].sum()) < 1e-6
    assert got["lid"].is_unique and got["rid"].is_unique
