"""Tail probabilities of test statistics and the wording of a test result.

Applied to result rows of tests only, one row per test.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these functions with the task, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 3e-16
_LARGE_DF = 20_000.0


def _continued_fraction(terms, limit: int) -> float:
    """Modified Lentz evaluation of b0 + a1/(b1 + a2/(b2 + ...)) from ``terms``; NaN if it
    has not converged after ``limit`` terms."""
    first = next(terms)[1]
    f = first if first != 0 else _TINY
    c, d = f, 0.0
    for k, (num, den) in enumerate(terms):
        d = den + num * d
        d = 1.0 / (d if d != 0 else _TINY)
        c = den + num / c
        c = c if c != 0 else _TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < _EPS:
            return f
        if k > limit:
            return math.nan


def _beta_terms(a: float, b: float, x: float):
    yield 0.0, 1.0
    m = 0
    while True:
        yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        m += 1
        yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0


def _log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def _beta_lower(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta function, with ``y = 1 - x`` given separately."""
    if x <= 0:
        return 0.0
    if y <= 0:
        return 1.0
    front = a * math.log(x) + b * math.log(y) - _log_beta(a, b)
    if x < (a + 1) / (a + b + 2):
        return math.exp(front) / a / _continued_fraction(_beta_terms(a, b, x), 100_000)
    return 1.0 - math.exp(front) / b / _continued_fraction(_beta_terms(b, a, y), 100_000)


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) of Student's t."""
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    t2 = t * t
    if df > _LARGE_DF:
        # Normalising transformation of t for many degrees of freedom (G. W. Hill, 1970).
        a = df - 0.5
        b = 48.0 * a * a
        z2 = a * math.log1p(t2 / df)
        z = math.sqrt(z2)
        z += (z2 + 3.0) * z / b
        z -= (((4.0 * z2 + 33.0) * z2 + 240.0) * z2 + 855.0) * math.sqrt(z2) / (
            10.0 * b * (b + 0.8 * z2 * z2 + 100.0)
        )
        return math.erfc(z / math.sqrt(2.0))
    return _beta_lower(df / 2.0, 0.5, df / (df + t2), t2 / (df + t2))


def _gamma_terms(a: float, x: float):
    yield 0.0, x + 1.0 - a
    k = 0
    while True:
        k += 1
        yield -k * (k - a), x + 2 * k + 1.0 - a


def _gamma_upper_uniform(a: float, x: float) -> float:
    """Upper incomplete gamma ratio for large a: the leading terms of Temme's uniform
    asymptotic expansion, whose next term is below 1/a**2."""
    m = (x - a) / a
    # eta**2 / 2 = m - log(1 + m), summed as a series where that would cancel.
    half = m - math.log1p(m) if abs(m) > 0.01 else sum((-1) ** k * m**k / k for k in range(2, 14))
    eta = math.copysign(math.sqrt(2 * half), m)
    if abs(eta) < 1e-3:
        first = -1 / 3 + eta / 12 - 2 * eta * eta / 135
        second = -1 / 540 - eta / 288
    else:
        first = 1 / m - 1 / eta
        second = 1 / eta**3 - 1 / m**3 - 1 / m**2 - 1 / (12 * m)
    tail = math.exp(-a * half) / math.sqrt(2 * math.pi * a)
    return min(1.0, max(0.0, 0.5 * math.erfc(eta * math.sqrt(a / 2)) + tail * (first + second / a)))


def chi2_upper(x: float, dof: float) -> float:
    """P(X >= x) of the chi-square distribution."""
    if math.isnan(x) or math.isnan(dof):
        return math.nan
    if x <= 0 or dof <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    a, h = dof / 2.0, x / 2.0
    if dof > _LARGE_DF:
        return _gamma_upper_uniform(a, h)
    front = a * math.log(h) - h - math.lgamma(a)
    if h < a + 1:
        term = total = 1.0 / a
        k = a
        while term > total * _EPS:
            k += 1
            term *= h / k
            total += term
        return 1.0 - total * math.exp(front)
    return math.exp(front) / _continued_fraction(_gamma_terms(a, h), 1_000_000)


def format_p(p: float | None) -> str | None:
    """Four significant digits; a p that underflowed to zero shows its bound."""
    if p is None or math.isnan(p):
        return None
    return "< 1e-308" if p == 0.0 else f"{p:.4g}"


def _each(fn, *columns: pd.Series) -> pd.Series:
    rows = zip(*columns)
    return pd.Series([None if any(pd.isna(v) for v in r) else fn(*r) for r in rows])


@F.pandas_udf(T.DoubleType())
def t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _each(chi2_upper, x, dof)


@F.pandas_udf(T.StringType())
def p_text(p: pd.Series) -> pd.Series:
    return _each(format_p, p)


def verdict(p: Column, text: Column, alpha: float, claim: Column) -> Column:
    """Sentence for a test result."""
    limit = F.lit(f"{alpha:g}")
    return F.when(
        p < alpha, F.concat(F.lit("p="), text, F.lit(" < "), limit, F.lit(": H0 rejected, "), claim)
    ).when(
        p >= alpha,
        F.concat(F.lit("p="), text, F.lit(" >= "), limit, F.lit(": H0 kept, no evidence that "), claim),
    )
