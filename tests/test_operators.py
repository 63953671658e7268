"""Operators without SQL, against brute force or their invariants."""

import itertools
import random

import numpy as np
import pandas as pd
from conftest import SF

from gridloom.operators import grids, matching, registry
from gridloom.plans.components import connected_components


def test_components_of_chains_stars_and_loops(spark):
    random.seed(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 100} | {x: 100 for x in range(101, 130)} | {200: 200, 201: 200, 202: 200}
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_assignment_is_cheapest():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (2, 4), (4, 4), (5, 6)):
        cost = rng.random((n, m))
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        got = matching.assignment(cost)
        assert len(set(got)) == n
        assert abs(cost[np.arange(n), got].sum() - best) < 1e-9


def test_match_one_to_one(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 50.0, 50.0)], "id long, x double, y double")
    right = spark.createDataFrame([(1, 0.4, 0.0), (2, -1.0, 0.0), (3, 90.0, 90.0)], "id long, x double, y double")
    got = {(r.lid, r.rid) for r in matching.match_one_to_one(left, right, 1.5).collect()}
    assert got == {(1, 2), (2, 1)}  # two pairs, though (1, 1) alone is nearer


def test_sparse_components_equal_the_dense_assignment():
    rng = np.random.default_rng(5)
    for n, m, share in ((1, 1, 1.0), (6, 9, 0.3), (30, 30, 0.08), (40, 25, 0.1), (60, 60, 0.05)):
        at = rng.random((n, m)) < share
        at[0, 0] = True
        d2 = rng.random((n, m)) * 9
        i, j = np.nonzero(at)
        got = matching._best(pd.DataFrame({"lid": i + 7, "rid": j + 3, "d2": d2[i, j]}))
        assert got["lid"].is_unique and got["rid"].is_unique and all(at[a - 7, b - 3] for a, b in zip(got["lid"], got["rid"]))
        assert np.allclose(got["distance"], np.sqrt(d2[got["lid"] - 7, got["rid"] - 3]))
        absent = 4.0 * (min(n, m) + 1)
        cost = np.where(at, np.sqrt(d2), absent)
        cost = cost if n <= m else cost.T
        want = cost[np.arange(len(cost)), matching.assignment(cost)]
        assert len(got) == (want < absent).sum() and abs(got["distance"].sum() - want[want < absent].sum()) < 1e-9


def test_large_component_is_matched():
    i = np.arange(2_500)  # a chain of 2,500 by 2,500 points
    pairs = pd.DataFrame({"lid": np.r_[i, i[1:]], "rid": np.r_[i, i[:-1]], "d2": np.r_[i * 0 + 4.0, i[1:] * 0 + 1.0]})
    got = matching._best(pairs)
    assert len(got) == 2_500 and set(got["distance"]) == {2.0}


def test_crowns_cover_cells_once(spark):
    rows = registry.watershed_crowns(spark, SF).collect()
    assert len(rows) == len({(r.cx, r.cy) for r in rows})


def test_colours_are_those_of_going_in_turn(spark):
    rng = random.Random(11)
    edges = [(0, 1), (1, 2), (2, 0), (3, 4), (2, 3), (5, 5)] + [(rng.randrange(40), rng.randrange(40)) for _ in range(90)]
    around = {}
    for a, b in edges:
        if a != b:
            around.setdefault(a, set()).add(b)
            around.setdefault(b, set()).add(a)
    want = {}
    for v in sorted(around, key=lambda v: (-len(around[v]), v)):
        taken = {want[u] for u in around[v] if u in want}
        want[v] = next(c for c in range(1, 99) if c not in taken)
    got = {r.node: r.colour for r in grids.greedy_coloring(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_eigen_features_sum(spark):
    for r in registry.eigen_features(spark, SF).collect():
        if r.linearity is not None:
            assert abs(r.linearity + r.planarity + r.scattering - 1) < 1e-9
