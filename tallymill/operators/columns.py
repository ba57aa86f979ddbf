"""Summaries and scaling of numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.functions.numbers import minmax


def _one_row_per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """Compute every measure of every column in one aggregate, then turn the single row upright."""
    wide = [F.struct(F.lit(c).alias("column"), *[build(c).alias(m) for m, build in measures.items()]) for c in columns]
    return df.agg(F.array(*wide).alias("rows")).select(F.inline("rows"))


def column_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, min, max, n) over the non-null values of each column."""
    return _one_row_per_column(
        df,
        columns,
        {"min": lambda c: F.min(_double(c)), "max": lambda c: F.max(_double(c)), "n": F.count},
    )


def column_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std) with the sample standard deviation."""
    return _one_row_per_column(
        df, columns, {"mean": lambda c: F.avg(_double(c)), "std": lambda c: F.stddev_samp(_double(c))}
    )


def minmax_normalize(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Each column scaled to [0, 1] as ``<column>_norm``, next to the ``keep`` columns.

    All bounds come from one aggregate used as a scalar subquery, so the large side
    stays a narrow scan. A column with a single value gives null.
    """
    ends = [end(F.col(c)).alias(f"{c}_{name}") for c in columns for name, end in (("low", F.min), ("high", F.max))]
    bounds = df.agg(F.struct(*ends).alias("bounds")).scalar()
    scaled = [
        minmax(F.col(c), bounds.getField(f"{c}_low"), bounds.getField(f"{c}_high")).alias(f"{c}_norm") for c in columns
    ]
    return df.select(*(keep or []), *scaled)


def _double(name: str) -> Column:
    return F.col(name).cast("double")
