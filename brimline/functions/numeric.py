"""Numeric expressions: bounds, scaling, decay."""

import math

from pyspark.sql import Column, functions as F


def finite(c) -> Column:
    """NaN and infinities become NULL, the only missing marker used after ingest."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def clip(c, low=0.0, high=100.0) -> Column:
    """Bound a value; NULL stays NULL (least and greatest would skip it)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def scale(x, low, high) -> Column:
    """Min-max position of x inside (low, high); a constant feature maps to 0."""
    return (x - low) / F.coalesce(F.nullif(high - low, F.lit(0.0)), F.lit(1.0))


def unscale(x, low, high) -> Column:
    return x * F.coalesce(F.nullif(high - low, F.lit(0.0)), F.lit(1.0)) + low


def decay(age_days, halflife) -> Column:
    """Weight that halves every `halflife` days."""
    return F.exp(-age_days * F.lit(math.log(2.0)) / halflife)
