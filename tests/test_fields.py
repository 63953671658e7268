"""Medians around places: no pairs are written, equal footprints are counted."""

import math
import random
from statistics import median

from gridloom.operators import summaries as U


def test_local_field_counts_equal_footprints(spark):
    rng = random.Random(6)
    some = [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(25)]
    rows = [(i, *rng.choice(some), rng.randrange(-4, 5) / 4, rng.choice([None, 0.5, -0.25, 1.0]), rng.random() < 0.7) for i in range(200)]
    rows += [(7, 0.0, 0.0, 1.0, 1.0, True), (500, None, 1.0, 0.5, 0.5, True), (501, 1.0, 1.0, None, None, None), (502, 900.0, 900.0, 0.0, 0.0, True)]
    fits = spark.createDataFrame(rows, "id long, x double, y double, dx double, dy double, reliable boolean")
    got = {(r.id, r.resid_m): (r.n, r.local_dx, r.local_dy, r.spread) for r in U.local_field(fits, 40.0).collect()}
    middle = lambda v: median(v) if v else None
    for i in {r[0] for r in rows}:
        near = [(o[3], o[4]) for r in rows if r[0] == i and r[1] is not None for o in rows if o[5] and o[0] != i and o[1] is not None and math.hypot(r[1] - o[1], r[2] - o[2]) <= 40]
        mx, my = middle([u for u, _ in near if u is not None]), middle([v for _, v in near if v is not None])
        want = (len(near), mx, my, middle([math.hypot(u - mx, v - my) for u, v in near if u is not None and v is not None])) if len(near) >= 5 else (len(near), None, None, None)
        mine = [v for (k, _), v in got.items() if k == i]
        assert mine and all(a[0] == want[0] and all((p is None) == (q is None) and (p is None or math.isclose(p, q, abs_tol=1e-12)) for p, q in zip(a[1:], want[1:])) for a in mine)


def test_fields_write_no_pairs(spark):
    rows = [(i, 0.0, 0.0, (i % 5) / 4) for i in range(3_000)]  # 9 million pairs
    points = spark.createDataFrame(rows, "id long, x double, y double, sx double")
    asked = []
    run, U._medians_around = U._medians_around, lambda *a: asked.append(a) or run_of(*a)
    run_of = run
    try:
        found = U.shift_field(points, 60.0)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert asked and "cx" not in plan and "Generate" not in plan
        assert {(r.n, r.shift) for r in found.collect()} == {(2_999, 0.5)}
    finally:
        U._medians_around = run
