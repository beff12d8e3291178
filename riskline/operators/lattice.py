"""Exact p-value of the two-sample KS distance for small samples.

The two samples, put in one order, are a path on a lattice from (0, 0) to (n, m); under the null hypothesis all paths are
equally likely.  The p-value is the share of paths that touch a point (i, j) with |i m - j n| >= h, where h / (n m) is
the distance found (h is an integer, so nothing is rounded).  The share is carried along the diagonals i + j: a random
path comes to (i, j) by its last step from (i - 1, j) with probability i / (i + j).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest sample for which paths are counted; beyond it the asymptotic series is used.
EXACT_ROWS = 10_000


def outside_share(n: int, m: int, h: int) -> float:
    """Share of the lattice paths to (n, m) that touch |i m - j n| >= h; points outside that band have share 1."""
    if h <= 0:
        return 1.0
    share = np.ones(n + 2)
    share[0] = 0.0
    for s in range(1, n + m + 1):
        # i m - j n = i (n + m) - s n on the diagonal i + j = s
        low = max((s * n - h) // (n + m) + 1, s - m, 0)
        high = min(-((-s * n - h) // (n + m)) - 1, n, s)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        come = np.concatenate([[share[low - 1] if low else 0.0], share[low:high]])  # from (i - 1, j), the others stay at i
        share[low : high + 1] = (i * come + (s - i) * share[low : high + 1]) / s
        share[high + 1] = 1.0
        if low:
            share[low - 1] = 1.0
    return float(share[n])


def exact_p_value(n: Column, m: Column, h: Column) -> Column:
    """p-value for sample sizes and the integer distance ``h`` = max |count_a m - count_b n|; one row a test."""

    def shares(n: pd.Series, m: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([outside_share(int(a), int(b), int(c)) for a, b, c in zip(n, m, h, strict=True)])

    return F.pandas_udf(shares, "double")(n, m, h)
