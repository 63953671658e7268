"""Estimators against published values and the reference's own fixtures."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import intervals, rules
from gridloom.operators import estimation as E


@pytest.fixture(scope="module")
def sample(spark):
    rows = [("A", "TREE", True)] * 2 + [("A", "ROOF_OR_BUILDING", True)] * 8 + [("A", None, True)] * 3 + [("A", "UNSURE", True)] + [("B", "TREE", True)] * 9 + [("B", "OTHER_STRUCTURE", True)]
    return spark.createDataFrame(rows, "stratum string, label string, retained boolean"), spark.createDataFrame([("A", 1000), ("B", 100)], "stratum string, population long")


def test_precision_of_the_fixture(spark, sample):
    got = {r.key: r for r in E.score_treetops(*sample, new_candidates=100, replicates=400).collect()}
    assert got["precision"].estimate == pytest.approx(290 / 1100)
    assert got["precision_if_new_false"].estimate == pytest.approx(290 / 1200) and got["precision_if_new_true"].estimate == pytest.approx(390 / 1200)
    assert got["true_removed"].estimate == 0 and got["share_of_true_removed"].estimate == 0
    p = got["precision"]
    variance = (1000**2 * (1 - 10 / 1000) * (0.16 * 10 / 9) / 10 + 100**2 * (1 - 10 / 100) * (0.09 * 10 / 9) / 10) / 1100**2
    assert p.variance == pytest.approx(variance) and p.status == "ANALYTIC_TAYLOR_T" and p.low < p.estimate < p.high
    assert p.boot_status == "BOOTSTRAP" and p.boot_low < p.estimate < p.boot_high
    again = {r.key: r for r in E.score_treetops(*sample, new_candidates=100, replicates=400).collect()}
    assert again["precision"].boot_low == p.boot_low


def test_suppressed_intervals(spark):
    sizes = spark.createDataFrame([("A", 10), ("B", 4)], "stratum string, population long")
    rows = lambda *labels: spark.createDataFrame([(s, l, True) for s, l in labels], "stratum string, label string, retained boolean")
    status = lambda units: {r.key: r.status for r in E.score_treetops(units, sizes, replicates=20).collect()}["precision"]
    assert status(rows(*[("A", "TREE")] * 5, *[("B", "ROOF_OR_BUILDING"), ("B", "TREE")] * 2)) == "HOMOGENEOUS_OR_DEGENERATE_SAMPLE"
    assert status(rows(*[("A", "TREE"), ("A", "GROUND_OR_OPEN")] * 5, *[("B", "TREE"), ("B", "ROOF_OR_BUILDING")] * 2)) == "CENSUS"
    with pytest.raises(ValueError):
        E.score_treetops(rows(*[("A", "TREE")] * 11), sizes, replicates=20)
    with pytest.raises(ValueError):
        E.score_treetops(rows(("C", "TREE")), sizes, replicates=20)
    one = E.treetop_sample(rows(*[("A", "TREE"), ("A", "GROUND_OR_OPEN")] * 2), sizes)
    assert one.missing() == ["B"] and one.coverage() == pytest.approx(10 / 14) and E.status([one], 4) == "PARTIAL"


def test_quantiles_against_tables():
    for p, df, want in ((0.975, 1, 12.7062), (0.975, 5, 2.570582), (0.975, 10, 2.228139), (0.95, 30, 1.697261), (0.995, 120, 2.617421)):
        assert intervals.t_quantile(p, df) == pytest.approx(want, rel=1e-5)
    assert float(intervals.incomplete_beta(2, 3, 0.4)) == pytest.approx(0.5248)
    low, high = intervals.exact_limits(np.array([0, 5, 10, 0]), np.array([10, 10, 10, 0]))
    assert np.allclose(low, [0, 0.187086, 0.691503, 0], atol=1e-6) and np.allclose(high, [0.308497, 0.812914, 1, 1], atol=1e-6)


def test_columns_of_intervals(spark):
    df = spark.createDataFrame([(26, 40), (37, 40), (0, 0)], "k long, n long")
    rows = df.select(intervals.exact_lower(F.col("k"), F.col("n")).alias("low"), intervals.sign_test(F.col("k"), F.col("n")).alias("p")).collect()
    assert [round(r.low, 4) for r in rows] == [0.5081, 0.8174, 0.0]  # published lower bounds of the two audits
    want = 2 * sum(math.comb(66, i) for i in range(27)) / 2**66
    assert rows[0].p == pytest.approx(min(1, want)) and rows[2].p == 1


def test_projection_and_objects(spark):
    scores = spark.createDataFrame([(500, 10, 40), (200, 30, 30)], "population long, k long, n long")
    r = E.projection(scores).first()
    assert r.estimate == pytest.approx(500 * 0.25 + 200) and r.low < r.estimate < r.high and r.measured
    r = E.projection(scores, measured=35).first()
    assert r.estimate is None and not r.measured


def test_parameters_are_checked():
    assert rules.parameters(matched_share=0.6, missed_share=None)["matched_share"] == 0.6
    for bad in ({"nothing": 1}, {"matched_share": 1.2}, {"cell_size_m": 0}, {"overhang_m": 0.1}, {"roof_percentile": 101}, {"near_roof_m": math.inf}):
        with pytest.raises(ValueError):
            rules.parameters(**bad)


def test_sign_test_of_many_pairs(spark):
    """Where p is below the smallest double, its logarithm is still there."""
    exact = lambda b, c: Fraction(2 * sum(math.comb(b + c, i) for i in range(min(b, c) + 1)), 2 ** (b + c))
    log10 = lambda p: (math.log2(p.numerator) - math.log2(p.denominator)) * math.log10(2)
    for b, c in ((0, 0), (1, 0), (3, 3), (3, 4), (0, 40), (9, 31), (500, 480), (2_952, 5_796), (2_500, 2_400), (40, 3_000), (2_700, 2_700)):
        want = min(0.0, log10(exact(b, c)))
        assert abs(intervals.log10_tail(b, c) - want) <= 1e-9 * max(1, abs(want)) and (min(b, c) < 100 or abs(intervals.log10_tail(b, c, 50) - want) <= 1e-9 * max(1, abs(want)))
    pairs = spark.createDataFrame([(29_520, 57_960), (0, 0)], "b long, c long")
    got = [r.log_p for r in pairs.select(intervals.log10_sign_test(F.col("b"), F.col("c")).alias("log_p")).collect()]
    assert abs(got[0] + 2_046.614465738082) < 1e-6 and got[1] == 0
