"""Numeric column expressions: scaling, row-wise means, cosine, sliding means."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Position of ``value`` between the bounds; null where the bounds coincide."""
    return F.try_divide(value - low, high - low)


def row_mean(*values: Column) -> Column:
    """Mean across columns of one row; null as soon as one of them is null."""
    return reduce(add, values) / len(values)


def cosine(dot: Column, square_a: Column, square_b: Column) -> Column:
    """Cosine from a dot product and two sums of squares; null for a zero vector."""
    return F.try_divide(dot, F.sqrt(square_a) * F.sqrt(square_b))


def rmse(predicted: Column, label: Column) -> Column:
    """Root of the mean squared error, as an aggregate; rows without one of both are left out."""
    return F.sqrt(F.avg((predicted - label) * (predicted - label)))


def sliding_means(values: Column, length: int, width: int, stride: int = 1, outputs: int | None = None) -> Column:
    """Means of ``width`` neighbours in an array of ``length`` numbers, as an array.

    Output i (from 0) covers positions i*stride .. i*stride+width-1. Only full frames
    are returned, at most ``outputs`` of them. A null inside a frame makes its mean null.
    Frames are sums of shifted slices: one pass per shift, nothing is exploded or shuffled.
    """
    frames = max((length - width) // stride + 1, 0)
    frames = frames if outputs is None else min(frames, outputs)
    if frames == 0:
        return F.array().cast("array<double>")
    span = (frames - 1) * stride + 1
    sums = F.transform(F.slice(values, 1, span), lambda v: v.cast("double"))
    for shift in range(1, width):
        sums = F.zip_with(sums, F.slice(values, shift + 1, span), lambda total, v: total + v)
    picked = sums if stride == 1 else F.filter(sums, lambda _, position: position % stride == 0)
    return F.transform(picked, lambda total: total / width)
