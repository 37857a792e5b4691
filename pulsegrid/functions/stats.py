"""Two-sided p-value of Student's t; used on one row per correlation."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _half_step(a: float) -> float:
    """log gamma(a + 1/2) - log gamma(a), without the cancellation of large terms."""
    if a < 1000:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3)


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method; needs about sqrt(max(a, b)) terms."""
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    value = d
    for m in range(1, 200_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + term * d) or tiny)
            c = (1 + term / c) or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return value


def student_p(t: float, dof: float) -> float:
    """P(|T| >= |t|), the regularised incomplete beta function at dof / (dof + t^2) with parameters dof / 2 and 1 / 2."""
    if t is None or dof is None or math.isnan(t) or dof <= 0:
        return float("nan")
    if t == 0:
        return 1.0
    if math.isinf(t):
        return 0.0
    a, b = dof / 2, 0.5
    ratio = t * t / dof
    x, rest = 1 / (1 + ratio), ratio / (1 + ratio)
    front = math.exp(_half_step(a) - 0.5 * math.log(math.pi) - a * math.log1p(ratio) + b * math.log(rest))
    if x < (a + 1) / (a + b + 2):
        return min(1.0, front * _fraction(a, b, x) / a)
    return max(0.0, 1 - front * _fraction(b, a, rest) / b)


@F.pandas_udf(T.DoubleType())
def student_p_column(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([student_p(a, b) for a, b in zip(t, dof)], dtype="float64")
