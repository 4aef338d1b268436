"""Closed-form statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz and Stegun, formula 7.1.26.
ERF_P = 0.3275911
ERF_A = [0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429]


def erf(x: Column) -> Column:
    """Error function, to about 1.5e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.abs(x) * ERF_P)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = poly * t + a
    y = F.lit(1.0) - poly * t * F.exp(-x * x)
    return F.when(x >= 0, y).otherwise(-y)


def proportion_p_value(share: Column, n: Column, p0: float | Column) -> Column:
    """Two-sided normal test of an observed share against ``p0``."""
    p = F.lit(p0) if isinstance(p0, float) else p0
    z = (share - p) / F.sqrt(p * (F.lit(1.0) - p) / n)
    return F.lit(1.0) - erf(F.abs(z) / math.sqrt(2.0))


def round_even(x: Column, places: int) -> Column:
    """Scale, round half to even, scale back: the rounding of numeric array libraries."""
    scale = float(10**places)
    return F.rint(x * scale) / scale
