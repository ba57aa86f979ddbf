"""Sliding averages over a fixed number of time slots per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.functions.numbers import sliding_means

# 20-minute ticks over two days, three to the hour, 24 hours to the day.
TICKS = 144
TICKS_PER_HOUR = 3
HOURS_PER_DAY = 24
HOURS = TICKS // TICKS_PER_HOUR
DAYS = HOURS // HOURS_PER_DAY
SLIDING_HOURS = TICKS - TICKS_PER_HOUR + 1


def ticks_from_columns(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys..., ticks array) from one column per tick; a null tick stays null."""
    return df.select(*keys, F.array(*[F.col(c).cast("double") for c in columns]).alias("ticks"))


def ticks_from_rows(df: DataFrame, keys: list[str], slot: str, value: str, length: int = TICKS) -> DataFrame:
    """(keys..., ticks array) from rows (keys..., slot from 1, value); missing slots are 0.

    Rows whose slot is not in 1..``length``, or null, lie outside the series and are left out.
    Values are summed per slot first, so an entity never gathers more than ``length`` rows.
    """
    inside = df.where(F.col(slot).between(1, length))
    slots = inside.groupBy(*keys, slot).agg(F.sum(F.col(value).cast("double")).alias("v"))
    packed = slots.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(slot, "v"))).alias("by_slot"))
    positions = F.sequence(F.lit(1), F.lit(length))
    dense = F.transform(positions, lambda i: F.coalesce(F.try_element_at("by_slot", i), F.lit(0.0)))
    return packed.select(*keys, dense.alias("ticks"))


def hourly_means(
    ticks: DataFrame, keys: list[str], stride: int = 1, length: int = TICKS, outputs: int | None = None
) -> DataFrame:
    """(keys..., hours array) of means over three ticks, for every full frame of the series.

    Stride 1 slides by one tick and stride 3 gives separate hours. ``outputs`` keeps only the
    first frames.
    """
    hours = sliding_means(F.col("ticks"), length, TICKS_PER_HOUR, stride, outputs=outputs)
    return ticks.select(*keys, hours.alias("hours"))


def daily_means(
    hours: DataFrame, keys: list[str], stride: int = 1, length: int = SLIDING_HOURS, outputs: int | None = None
) -> DataFrame:
    """(keys..., days array) of means over 24 of ``length`` hourly values; stride and outputs as in :func:`hourly_means`."""
    days = sliding_means(F.col("hours"), length, HOURS_PER_DAY, stride, outputs=outputs)
    return hours.select(*keys, days.alias("days"))


def as_rows(series: DataFrame, keys: list[str], values: str, name: str) -> DataFrame:
    """(keys..., slot from 1, name) with one row per array element."""
    return series.select(*keys, F.posexplode_outer(values).alias("slot", name)).withColumn("slot", F.col("slot") + 1)


def as_columns(series: DataFrame, keys: list[str], values: str, name: str, length: int) -> DataFrame:
    """(keys..., name1, name2, ...) with one column per array element."""
    return series.select(*keys, *[F.get(values, i).alias(f"{name}{i + 1}") for i in range(length)])
