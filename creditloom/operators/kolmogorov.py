"""The exact two-sample Kolmogorov-Smirnov distribution, ties included.

Under the null hypothesis every order of the pooled rows is as likely as any other: the order is a
lattice path from (0, 0) to (n, m) with a step for each row.  Within a tie the order does not show,
so a path counts as far off when it is so at the end of a tie.  The distance is held as the integer
|i m - j n|, so nothing is rounded before it is compared.

The p-value is the share of paths that reach the observed distance, given the sizes of the ties:
probability moves along the path step by step, and what arrives outside is taken off and added up,
which keeps small p-values exact.  That takes (n + m) steps over at most n + 1 numbers, so it is
meant for samples of up to ``EXACT_ROWS``; beyond that the series of the limit takes over.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: The larger sample's size up to which the exact distribution is taken.
EXACT_ROWS = 10_000


def reached(ties: np.ndarray, n: int, m: int, far: int) -> float:
    """The probability that |i m - j n| is ``far`` or more at the end of some tie; ``ties`` are sizes in order of value."""
    if far <= 0:
        return 1.0
    i = np.arange(n + 1)
    mass = np.zeros(n + 1)
    mass[0] = 1.0
    low, high, seen, outside = 0, 0, 0, 0.0  # mass lies between low and high
    for size in ties:
        for _ in range(int(size)):
            at = slice(low, high + 1)
            left = n + m - seen
            up = mass[at] * ((n - i[at]) / left)
            mass[at] *= (m - (seen - i[at])) / left
            high = min(high + 1, n)
            mass[low + 1 : high + 1] += up[: high - low]
            seen += 1
        at = slice(low, high + 1)
        gone = np.abs(i[at] * m - (seen - i[at]) * n) >= far
        if gone.any():
            outside += float(mass[at][gone].sum())
            mass[at][gone] = 0.0
            inside = np.flatnonzero(~gone)
            if not len(inside):
                break
            low, high = low + int(inside[0]), low + int(inside[-1])
    return min(1.0, outside)


@F.pandas_udf(DoubleType())
def _exact(ties: pd.Series, n: pd.Series, m: pd.Series, far: pd.Series) -> pd.Series:
    rows = zip(ties, n, m, far)
    return pd.Series([reached(t, int(a), int(b), int(d)) if t is not None and len(t) else None for t, a, b, d in rows], dtype="float64")


def exact_pvalue(ties: Column, n: Column, m: Column, far: Column) -> Column:
    """``reached`` for each row; null where ``ties`` is empty."""
    return _exact(ties, n.cast("long"), m.cast("long"), F.coalesce(far, F.lit(0)).cast("long"))


def ties_if_few(value: str, base: str = "base", current: str = "current", most: int = EXACT_ROWS) -> Column:
    """Aggregate over running totals: the sizes of the ties in order of value; empty if a sample has over ``most`` rows."""
    few = (F.col(f"{base}_total") <= most) & (F.col(f"{current}_total") <= most)
    pairs = F.collect_list(F.when(few, F.struct(F.col(value), (F.col(base) + F.col(current)).alias("size"))))
    return F.transform(F.array_sort(pairs), lambda x: x["size"])


def farthest(base: str = "base", current: str = "current", most: int = EXACT_ROWS) -> Column:
    """Aggregate over running totals: the largest |i m - j n|; null if a sample has over ``most`` rows."""
    few = (F.col(f"{base}_total") <= most) & (F.col(f"{current}_total") <= most)
    i, j = (F.col(f"{x}_below") + F.col(x) for x in (base, current))
    return F.max(F.when(few, F.abs(i * F.col(f"{current}_total") - j * F.col(f"{base}_total"))))
