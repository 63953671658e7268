"""Exact and analytic intervals: beta and t quantiles in numpy, and columns of them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gridloom.functions.scalars import wilson

def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in np.ravel(x)]).reshape(np.shape(x))


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    turned = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    inner = np.clip(y, 1e-300, 1 - 1e-16)
    front = np.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(inner) + q * np.log1p(-inner)) / p
    # Lentz's evaluation of the fraction
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 400):
        for step in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            value = value * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    out = np.where(y <= 0, 0.0, np.where(y >= 1, 1.0, front * value))
    return np.where(turned, 1 - out, out)


def beta_quantile(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inverse of the incomplete beta function, by bisection."""
    p, a, b = np.broadcast_arrays(np.asarray(p, float), np.asarray(a, float), np.asarray(b, float))
    low, high = np.zeros(p.shape), np.ones(p.shape)
    for _ in range(80):
        middle = (low + high) / 2
        below = incomplete_beta(a, b, middle) < p
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t for p over one half."""
    x = float(beta_quantile(2 * (1 - p), df / 2, 0.5))
    return math.sqrt(df * (1 - x) / x)


def exact_limits(k: np.ndarray, n: np.ndarray, alpha: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Clopper-Pearson limits; (0, 1) without trials."""
    k, n = np.asarray(k, float), np.asarray(n, float)
    low = np.where(k <= 0, 0.0, beta_quantile(alpha / 2, np.maximum(k, 1), n - k + 1))
    high = np.where(k >= n, 1.0, beta_quantile(1 - alpha / 2, k + 1, np.maximum(n - k, 1)))
    return np.where(n > 0, low, 0.0), np.where(n > 0, high, 1.0)


def clopper_pearson(k: Column, n: Column, alpha: float = 0.05) -> Column:
    """(low, high): exact two-sided interval of a share."""
    pair = StructType([StructField("low", DoubleType()), StructField("high", DoubleType())])

    @F.pandas_udf(pair)
    def limits(k: pd.Series, n: pd.Series) -> pd.DataFrame:
        low, high = exact_limits(k.to_numpy(), n.to_numpy(), alpha)
        return pd.DataFrame({"low": low, "high": high})

    return limits(k.cast("double"), n.cast("double"))


def exact_lower(k: Column, n: Column, alpha: float = 0.05) -> Column:
    """One-sided exact lower limit of a share."""
    return clopper_pearson(k, n, 2 * alpha)["low"]


def sign_test(b: Column, c: Column) -> Column:
    """Exact two-sided test of b against c discordant pairs."""

    @F.pandas_udf("double")
    def test(b: pd.Series, c: pd.Series) -> pd.Series:
        def one(b: int, c: int) -> float:
            n = b + c
            return min(1.0, 2 * sum(math.comb(n, i) for i in range(min(b, c) + 1)) / 2**n) if n else 1.0

        return pd.Series([one(int(x), int(y)) for x, y in zip(b, c)])

    return test(b, c)


def log10_tail(b: int, c: int, whole: int = 2_000) -> float:
    """log10 of the p of ``sign_test``, also where p is too small for a double.

    The largest term of the sum is taken in whole numbers, above ``whole`` by
    Stirling's series (whose error is below rounding there); the others by their
    ratios to it, down to where they no longer count."""
    n, k = b + c, min(b, c)
    total, term, i = 0.0, 1.0, k
    while i >= 0 and term > 1e-20 * total:
        total, term, i = total + term, term * i / (n - i + 1), i - 1
    if k <= whole:
        top = math.comb(n, k)
        bits = top.bit_length()
        found = math.log10(top / (1 << bits) * total) + (bits + 1 - n) * math.log10(2)
    else:
        rest = lambda x: 1 / (12 * x) - 1 / (360 * x**3)
        away = k * math.log1p((k - (n - k)) / n) + (n - k) * math.log1p(((n - k) - k) / n)
        found = (rest(n) - rest(k) - rest(n - k) - away + math.log(n / (2 * math.pi * k * (n - k))) / 2) / math.log(10) + math.log10(2 * total)
    return min(0.0, found)


def log10_sign_test(b: Column, c: Column) -> Column:
    """log10 of ``sign_test``."""

    @F.pandas_udf("double")
    def test(b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([log10_tail(int(x), int(y)) for x, y in zip(b, c)])

    return test(b, c)


def decision(k: Column, n: Column, needed: int, limit: float) -> Column:
    """Verdict on a stratum by a plan fixed beforehand: waiting until enough are
    answered, then pass if the upper Wilson limit of the error share is low enough."""
    return F.when(n < needed, "WAITING").when(wilson(k, n)["high"] <= limit, "PASS").otherwise("FAIL")
