"""Vectors of whole numbers whose squared distances are exact longs."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, functions as F


def largest(size: int) -> int:
    """The largest component at which the squared distance of two vectors of ``size`` still fits a long."""
    return min(isqrt((2**63 - 1) // max(size, 1)) // 2, 2**31 - 1)


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def whole(vector: Column, scale: int, size: int) -> Column:
    """``floor(scale * x)`` of every component; those beyond ``largest(size)`` are held at it."""
    most = float(largest(size))
    scaled = lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * scale))
    return F.transform(vector, lambda x: F.floor(scaled(x)).cast("int"))
