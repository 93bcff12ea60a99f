"""Student t critical values for confidence intervals."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NODES, WEIGHTS = np.polynomial.legendre.leggauss(200)


def _upper_tail(t: float, dof: int) -> float:
    """P(T > t) for t >= 0, by quadrature over the angle a with t = sqrt(dof) tan(a).

    The density becomes cos(a)**(dof-1), smooth on a finite interval; for many
    degrees of freedom it lives within a few 1/sqrt(dof), so the interval does too.
    """
    log_norm = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(math.pi)
    start = math.atan(t / math.sqrt(dof))
    end = min(math.pi / 2, start + 40 / math.sqrt(dof))
    half = (end - start) / 2
    angles = start + half * (NODES + 1)
    return float(half * np.sum(WEIGHTS * np.exp(log_norm + (dof - 1) * np.log(np.cos(angles)))))


@lru_cache(maxsize=4096)
def t_quantile(dof: int, confidence: float) -> float:
    """Two-sided critical value: P(|T| <= t) = confidence."""
    tail = (1 - confidence) / 2
    low, high = 0.0, 1.0
    while _upper_tail(high, dof) > tail:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        if _upper_tail(mid, dof) > tail:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def t_critical(dof: Column, confidence: float = 0.95) -> Column:
    """Critical value per row of an already aggregated table; null below one degree."""

    @F.pandas_udf("double")
    def lookup(values: pd.Series) -> pd.Series:
        known = {d: t_quantile(int(d), confidence) for d in values.dropna().unique() if d >= 1}
        return values.map(known).astype("float64")

    return lookup(dof)
