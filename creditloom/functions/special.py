"""Tails of distributions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series (small arguments) and of the continued fraction (the others); both are then exact to about 1e-14.
SERIES, FRACTION = 80, 80


def _half_tail(x: Column) -> Column:
    """Q(1/2, x): the upper regularised incomplete gamma function, which is erfc of the root of x."""
    below = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES)), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
                        lambda acc, n: F.struct((acc["term"] * x / (n + 0.5)).alias("term"), (acc["sum"] + acc["term"] * x / (n + 0.5)).alias("sum")))["sum"]
    lower = below * F.sqrt(x) * F.exp(-x) / math.gamma(1.5)
    # x + 1 - a - 1 (1 - a) / (x + 3 - a - ..), from the innermost term outwards
    inner = F.aggregate(F.sequence(F.lit(FRACTION), F.lit(1), F.lit(-1)), x + (2 * FRACTION + 0.5), lambda f, i: x + 2 * i - 1.5 - i * (i - 0.5) / f)
    upper = F.exp(-x) * F.sqrt(x) / math.gamma(0.5) / inner
    return F.when(x < 2, 1 - lower).otherwise(upper)


def chi2_tail(value: Column, dof: int) -> Column:
    """P(chi-square with dof degrees of freedom >= value): a finite sum, on top of erfc if dof is odd."""
    if dof < 1:
        raise ValueError("dof must be positive")
    x = F.greatest(value.cast("double"), F.lit(0.0)) / 2
    odd = dof % 2
    total = F.lit(0.0)
    for i in range(dof // 2):
        total = total + F.pow(x, F.lit(i + 0.5 * odd)) / math.gamma(i + 1 + 0.5 * odd)
    return F.when(value.isNotNull(), F.exp(-x) * total + (_half_tail(x) if odd else F.lit(0.0)))
