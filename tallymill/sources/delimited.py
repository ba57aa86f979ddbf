"""Readers of delimited text. Each declares its schema, so no file is read to guess types.

Bad or missing values become null and the rest of the row survives. Column names
of the operators (zone, day, hour, hires, src, dst, x, y) are set here where they differ
from those in the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.functions.calendar import leading_day, leading_second
from tallymill.sources import quoted, schemas


def read_delimited(spark: SparkSession, path, schema: str, **options) -> DataFrame:
    return spark.read.schema(schema).options(**options).csv(path)


def read_power(spark: SparkSession, path) -> DataFrame:
    """Household power measurements: semicolons, header, ``?`` for a missing value."""
    return read_delimited(spark, path, schemas.POWER, sep=";", header=True, nullValue="?")


def read_news(spark: SparkSession, path) -> DataFrame:
    """News items: commas, header, quotes doubled inside quoted fields."""
    return read_delimited(spark, path, schemas.NEWS, sep=",", header=True, quote='"', escape='"')


def read_news_with_breaks(spark: SparkSession, path) -> DataFrame:
    """News items whose quoted fields may hold line breaks; files of any size are read from splits."""
    return quoted.read_quoted(spark, path, schemas.NEWS)


def read_feedback(spark: SparkSession, folder: str, ticks: int = 144) -> DataFrame:
    """All ``<platform>_*.csv`` files of a folder (or directories) of a folder in one read, with a ``platform`` column."""
    names = ",".join(schemas.PLATFORMS)
    df = read_delimited(spark, f"{folder.rstrip('/')}/{{{names}}}_*.csv", schemas.feedback(ticks), sep=",", header=True)
    platform = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/_]+)_[^/]*\.csv", 1)
    return df.select(platform.alias("platform"), *df.columns)


def read_movies(spark: SparkSession, path) -> DataFrame:
    df = read_delimited(spark, path, schemas.MOVIES, sep="::", quote="")
    return df.withColumn("Genre", F.split("Genre", r"\|"))


def read_ratings(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, schemas.RATINGS, sep="::")


def read_users(spark: SparkSession, path) -> DataFrame:
    return read_delimited(spark, path, schemas.USERS, sep="::")


def read_edges(spark: SparkSession, path) -> DataFrame:
    """(src, dst) of a tab-separated edge list. Lines from ``#`` are comments; there is no header row."""
    df = read_delimited(spark, path, schemas.EDGES, sep="\t", comment="#", header=False)
    return df.select(F.col("FromNodeId").alias("src"), F.col("ToNodeId").alias("dst"))


def read_hires(spark: SparkSession, path) -> DataFrame:
    """(zone, day, hour, hires) training rows."""
    return _hire_columns(read_delimited(spark, path, schemas.HIRE_TRAIN, header=True))


def read_hire_tests(spark: SparkSession, path) -> DataFrame:
    """(test_id, zone, day, hour, hires) rows to forecast."""
    df = read_delimited(spark, path, schemas.HIRE_TEST, header=True)
    return _hire_columns(df, F.col("Test_ID").alias("test_id"))


def _hire_columns(df: DataFrame, *first) -> DataFrame:
    return df.select(
        *first,
        F.col("Zone_ID").cast("int").alias("zone"),
        F.col("Date").alias("day"),
        F.col("Hour_slot").cast("int").alias("hour"),
        F.col("Hire_count").cast("int").alias("hires"),
    )


def read_gps(spark: SparkSession, path) -> DataFrame:
    """(moment, day, x, y, zone) of ride starts; the day is the text before the time of day."""
    df = read_delimited(spark, path, schemas.GPS, header=True)
    return df.select(
        leading_second(F.col("Datetime")).alias("moment"),
        leading_day(F.col("Datetime")).alias("day"),
        F.col("Longitude_X").alias("x"),
        F.col("Latitude_Y").alias("y"),
        F.col("Zone_ID").cast("int").alias("zone"),
    )


def read_zones(spark: SparkSession, path) -> DataFrame:
    """(zone, left, top, right, bottom) rectangles."""
    df = read_delimited(spark, path, schemas.ZONES, header=True)
    return df.withColumnRenamed("Zone_ID", "zone").withColumn("zone", F.col("zone").cast("int"))
