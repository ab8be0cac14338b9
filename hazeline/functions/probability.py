"""Tail probabilities as column arithmetic; used on one row per tested column."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def erfc(x: Column) -> Column:
    """1 - erf(x) for x >= 0, by the all-positive series erf(x) = 2/sqrt(pi) e^-x^2 sum 2^n x^(2n+1)/(2n+1)!!"""
    capped = F.least(x, F.lit(6.0))  # erfc(6) is below 1e-16
    start = F.struct(capped.alias("term"), capped.alias("total"))

    def step(acc, n):
        term = acc["term"] * 2.0 * capped * capped / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(160)), start, step, lambda acc: acc["total"])
    return F.greatest(F.lit(0.0), 1.0 - (2.0 / math.sqrt(math.pi)) * F.exp(-capped * capped) * series)


def chi_square_tail(stat: Column, dof: Column) -> Column:
    """P(X > stat) for 1 to 4 degrees of freedom, where closed forms exist."""
    half = stat / 2.0
    odd = erfc(F.sqrt(half))
    return (
        F.when(dof == 1, odd)
        .when(dof == 2, F.exp(-half))
        .when(dof == 3, odd + F.sqrt(2.0 * stat / math.pi) * F.exp(-half))
        .when(dof == 4, F.exp(-half) * (1.0 + half))
    )


def kolmogorov_tail(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value: 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    scaled = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    # Below 0.2 the alternating series has not settled and the probability is 1 to 12 places.
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


EXACT_ROWS = 10_000  # of either sample, up to which the exact p-value is worth its time


def paths_outside(statistic: float, n: int, m: int) -> float:
    """P(D >= statistic) for two samples of one continuous distribution: the share of orders in which they can come.

    An order is a path of n steps right and m steps up; it is followed step by step while it stays inside.
    """
    reach = round(statistic * n * m)
    inside = np.zeros(n + 1)
    inside[0] = float(reach > 0)
    right = np.arange(n + 1)
    for step in range(n + m):
        up = step - right
        onward = np.where((up >= 0) & (up < m), inside * (m - up), 0.0)
        onward[1:] += (inside * (n - right))[:-1]
        inside = onward / (n + m - step)
        up = step + 1 - right
        inside[(np.abs(right * m - up * n) >= reach) | (up < 0) | (up > m)] = 0.0
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


@F.pandas_udf(T.DoubleType())
def exact_kolmogorov_tail(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Exact two-sample p-value; null where a size is null. One row per tested column."""
    known = zip(statistic, n, m)
    return pd.Series([paths_outside(d, int(a), int(b)) if a == a and b == b and a is not None and b is not None else None for d, a, b in known], dtype="float64")
