"""Tail probabilities of test statistics; applied to one row per tested column."""

import math

import pandas as pd
from pyspark.sql import functions as F


def _fraction(step, limit: int = 500) -> float:
    """Value of a continued fraction by Lentz's method; ``step(i)`` gives (a_i, b_i)."""
    tiny = 1e-300
    f = c = step(0)[1] or tiny
    d = 0.0
    for i in range(1, limit):
        a, b = step(i)
        d = 1.0 / ((b + a * d) or tiny)
        c = (b + a / c) or tiny
        f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return f


def beta_regularized(x: float, a: float, b: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_regularized(1.0 - x, b, a)

    def step(i):
        if i == 0:
            return 0.0, 1.0
        m, odd = divmod(i, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    return math.exp(log_front) / a / _fraction(step)


def gamma_upper(a: float, x: float) -> float:
    """Regularized upper incomplete gamma."""
    if x <= 0.0:
        return 1.0
    if math.isinf(x):
        return 0.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return 1.0 - total * math.exp(log_front)
    return math.exp(log_front) / _fraction(lambda i: (-i * (i - a), x + 2 * i + 1 - a))


def t_tail(t: float, df: float) -> float:
    return beta_regularized(df / (df + t * t), df / 2, 0.5)


def chi2_tail(x: float, df: float) -> float:
    return gamma_upper(df / 2, x / 2)


def normal_two_sided_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def kolmogorov_tail(x: float) -> float:
    """Limit distribution of the two-sample statistic scaled by the root sample size."""
    if x < 0.2:
        return 1.0
    return min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101)))


def _column(fn, *columns):
    @F.pandas_udf("double")
    def tail(*parts: pd.Series) -> pd.Series:
        rows = zip(*parts)
        return pd.Series([
            None if any(v is None or pd.isna(v) for v in row) else fn(*map(float, row))
            for row in rows
        ], dtype="float64")

    return tail(*columns)


def t_two_sided(t, df):
    return _column(t_tail, t, df)


def chi2_upper(x, df):
    return _column(chi2_tail, x, df)


def normal_two_sided(z):
    return _column(normal_two_sided_tail, z)


def kolmogorov_upper(x):
    return _column(kolmogorov_tail, x)
