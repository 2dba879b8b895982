"""Number conventions of image data, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT16, UINT32 = 65_535, 4_294_967_295


def to_uint16(x: Column) -> Column:
    """Round half to even, then clip to the range of 16 unsigned bits."""
    return F.least(F.greatest(F.rint(x), F.lit(0.0)), F.lit(float(UINT16))).cast("int")


def to_uint32(x: Column) -> Column:
    return F.least(F.greatest(F.rint(x), F.lit(0.0)), F.lit(float(UINT32))).cast("long")


def clipped_to_uint16(x: Column, clip: float) -> Column:
    """Values up to ``clip`` spread over the whole range."""
    return to_uint16(F.least(x, F.lit(clip)) / F.lit(clip) * F.lit(float(UINT16)))


def sigmoid_scaled(x: Column, factor: Column, slope: Column, bias: Column) -> Column:
    """Divide by ``factor`` where the signal is bright, leave the background as it is.

    The weight of the scaled value is a logistic function of x with midpoint ``bias``.
    """
    weight = F.lit(1.0) / (F.lit(1.0) + F.exp(-slope * (x - bias)))
    return x * (F.lit(1.0) - weight) + x / factor * weight


def power_of_scaled(x: Column, power: float) -> Column:
    return F.pow(x / F.lit(float(UINT16)), F.lit(power))


def null_as_nan(x: Column) -> Column:
    return F.coalesce(x, F.lit(float("nan")))


def nan_as_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def least_size(diameter: float, dims: int, override: float | None = None) -> float:
    """Smallest area or volume of an object: a disk or ball with a radius of diameter / 6."""
    if override is not None:
        return override
    radius = diameter / 6
    return math.pi * radius**2 if dims == 2 else 4 / 3 * math.pi * radius**3


def fwhm_of_sigma(sigma: Column) -> Column:
    return sigma * F.lit(2 * math.sqrt(2 * math.log(2)))


#: Exponents (x, y) of the fifteen terms of a surface of degree four, in their fixed order.
SURFACE_TERMS = ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (0, 2), (3, 0), (2, 1), (1, 2), (0, 3), (4, 0), (3, 1), (2, 2), (1, 3), (0, 4))


def surface_term(x: Column, y: Column, term: tuple[int, int]) -> Column:
    out = F.lit(1.0)
    for c, n in ((x, term[0]), (y, term[1])):
        for _ in range(n):
            out = out * c
    return out


def correlation(a: Column, b: Column) -> Column:
    """Aggregate: Pearson's correlation of pairs without nulls, null where either side is constant."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
