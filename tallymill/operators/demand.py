"""Demand profiles of zones over days, weekdays and hours.

``points`` have one row per ride, ``hires`` have (zone, day, hour, hires) rows with the
rides of a zone in one hour. Every profile is built from partial sums, so neither a
busy zone nor a busy hour meets in one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.functions.calendar import iso_weekday
from tallymill.functions.numbers import rmse


def rides_per_day(points: DataFrame, day: str = "day") -> DataFrame:
    """(day, n) in day order."""
    return points.groupBy(day).agg(F.count("*").alias("n")).orderBy(day)


def daily_hires(hires: DataFrame, month: int | None = None) -> DataFrame:
    """(day, hires) in day order, optionally of one calendar month (of any year) only."""
    chosen = hires if month is None else hires.where(F.month("day") == month)
    return chosen.groupBy("day").agg(F.sum("hires").alias("hires")).orderBy("day")


def rides_per_month(hires: DataFrame) -> DataFrame:
    """(month, per_day): hires of a calendar month divided by its days present in the data."""
    days = hires.groupBy(F.month("day").alias("month"), "day").agg(F.sum("hires").alias("hires"))
    per_day = F.sum("hires") / F.count("*")
    return days.groupBy("month").agg(per_day.alias("per_day")).orderBy("month")


def weekday_profile(hires: DataFrame, by_zone: bool = False) -> DataFrame:
    """(weekday, mean_hires), or (zone, weekday, mean_hires): mean of the daily sums."""
    return _mean_of_daily_sums(hires.withColumn("weekday", iso_weekday(F.col("day"))), "weekday", by_zone)


def hour_profile(hires: DataFrame, by_zone: bool = False) -> DataFrame:
    """(hour, mean_hires), or (zone, hour, mean_hires): mean over days of the sum of that hour."""
    return _mean_of_daily_sums(hires, "hour", by_zone)


def _mean_of_daily_sums(hires: DataFrame, slot: str, by_zone: bool) -> DataFrame:
    keys = ["zone", slot] if by_zone else [slot]
    sums = hires.groupBy(*keys, "day").agg(F.sum("hires").alias("hires"))
    return sums.groupBy(*keys).agg(F.avg("hires").alias("mean_hires")).orderBy(*keys)


def rides_per_zone(points: DataFrame, zone: str = "zone") -> DataFrame:
    """(zone, n) in zone order."""
    return points.groupBy(zone).agg(F.count("*").alias("n")).orderBy(zone)


def zone_bounds(rectangles: DataFrame) -> DataFrame:
    """(zone, left, right, bottom, top) per zone and, with a null zone, of all zones together.

    ``rectangles`` has the same columns; several rectangles of a zone are merged. Those without a
    zone count for the overall box only. One rollup gives both levels, told apart by the grouping id.
    """
    edges = [F.min("left").alias("left"), F.max("right").alias("right"), F.min("bottom").alias("bottom"), F.max("top").alias("top")]
    levels = rectangles.rollup("zone").agg(*edges, F.grouping_id().alias("level"))
    return levels.where("level = 1 or zone is not null").drop("level")


def zone_points(points: DataFrame, zone: int) -> DataFrame:
    """(x, y) of the points of one zone."""
    return points.where(F.col("zone") == zone).select("x", "y")


def ride_totals(hires: DataFrame) -> DataFrame:
    """One row: total, mean per day, mean per hour, mean per zone and hour.

    The mean per hour is the mean of the hour profile. The mean per zone and hour
    divides by the hours of all days present in the data.
    """
    hour_mean = hour_profile(hires).agg(F.avg("mean_hires")).scalar()
    sums = hires.agg(
        F.sum("hires").alias("total"),
        F.count_distinct("day").alias("days"),
        F.count_distinct("zone").alias("zones"),
    )
    return sums.select(
        "total",
        (F.col("total") / F.col("days")).alias("per_day"),
        hour_mean.alias("per_hour"),
        (F.col("total") / F.col("zones") / (F.col("days") * 24)).alias("per_zone_hour"),
    )


def profile_forecast(train: DataFrame, test: DataFrame) -> DataFrame:
    """(test_id, zone, day, hour, hires): mean of the zone, weekday and hour, cut to an integer.

    Null where the training rows have no such combination. ``test`` needs test_id, zone,
    day and hour; all its rows are kept. A weekday has 24 hours of profile per zone, and
    the number of zones is open, so the join strategy is left to the measured sizes.
    """
    keys = ["zone", "weekday", "hour"]
    weekday = iso_weekday(F.col("day"))
    means = train.groupBy("zone", weekday.alias("weekday"), "hour").agg(F.avg("hires").cast("int").alias("hires"))
    rows = test.select("test_id", "zone", "day", "hour", weekday.alias("weekday"))
    return rows.join(means, keys, "left").select("test_id", "zone", "day", "hour", "hires").orderBy("test_id")


def profile_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """(n, seen, rmse): rows of ``test``, those whose zone, weekday and hour the training rows have, and the error of their means."""
    keys = ["zone", "weekday", "hour"]
    weekday = iso_weekday(F.col("day")).alias("weekday")
    means = train.groupBy("zone", weekday, "hour").agg(F.avg("hires").alias("mean"))
    rows = test.select("zone", weekday, "hour", "hires").join(means, keys, "left")
    return rows.agg(F.count("*").alias("n"), F.count("mean").alias("seen"), rmse(F.col("mean"), F.col("hires")).alias("rmse"))


def date_slice_profile(hires: DataFrame, day: str, zone: int, last_hour: int) -> DataFrame:
    """(zone, hour, hires): integer means of one date for a zone, up to and including an hour."""
    chosen = hires.where(
        (F.col("day") == F.to_date(F.lit(day))) & (F.col("zone") == zone) & (F.col("hour") <= last_hour)
    )
    return chosen.groupBy("zone", "hour").agg(F.avg("hires").cast("int").alias("hires")).orderBy("zone", "hour")
