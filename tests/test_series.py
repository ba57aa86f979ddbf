import pytest
from pyspark.sql import functions as F

from tallymill.functions.numbers import sliding_means
from tallymill.operators import popularity


def means(spark, values, *args, **options):
    df = spark.createDataFrame([(values,)], "v array<double>")
    return df.select(sliding_means(F.col("v"), len(values), *args, **options).alias("m")).first().m


def test_sliding_frames(spark):
    assert means(spark, [3.0, 6.0, 9.0, 12.0], 3) == [6.0, 9.0]


def test_null_tick_gives_null(spark):
    assert means(spark, [3.0, None, 9.0, 12.0], 3) == [None, None]


def test_separate_frames(spark):
    assert means(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 3, 3) == [2.0, 5.0]


def test_too_short_series_has_no_frame(spark):
    assert means(spark, [1.0, 2.0], 3) == []


@pytest.mark.parametrize("stride", [1, 2, 3, 5])
def test_against_brute_force(spark, stride):
    values = [float((i * i * 7) % 31) for i in range(30)]
    expected = [sum(values[i : i + 4]) / 4 for i in range(0, 27, stride)]
    assert means(spark, values, 4, stride) == expected


def test_wide_ticks_to_hours_and_days(spark):
    columns = [f"TS{i}" for i in range(1, 145)]
    df = spark.createDataFrame([(7, *[float(i) for i in range(1, 145)])], ", ".join(["id int", *(f"{c} double" for c in columns)]))
    ticks = popularity.ticks_from_columns(df, ["id"], columns)
    hours = popularity.hourly_means(ticks, ["id"])
    assert hours.first().hours == [float(i + 1) for i in range(1, 143)]
    assert popularity.hourly_means(ticks, ["id"], outputs=48).first().hours == [float(i + 1) for i in range(1, 49)]
    days = popularity.daily_means(hours, ["id"])
    assert days.first().days == [i + 12.5 for i in range(1, 120)]
    separate = popularity.daily_means(popularity.hourly_means(ticks, ["id"], stride=3), ["id"], stride=24, length=popularity.HOURS)
    assert separate.first().days == [36.5, 108.5]
    wide = popularity.as_columns(days, ["id"], "days", "avg_day", 2)
    assert wide.columns == ["id", "avg_day1", "avg_day2"]


def test_rows_are_summed_and_filled(spark, rows):
    df = spark.createDataFrame([("e", 1, 2.0), ("e", 1, 3.0), ("e", 3, 1.0), ("e", 9, 5.0)], "k string, slot int, v double")
    ticks = popularity.ticks_from_rows(df, ["k"], "slot", "v", length=4)
    assert ticks.first().ticks == [5.0, 0.0, 1.0, 0.0]
    assert rows(popularity.as_rows(ticks, ["k"], "ticks", "v")) == [("e", 1, 5.0), ("e", 2, 0.0), ("e", 3, 1.0), ("e", 4, 0.0)]
