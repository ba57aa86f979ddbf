"""Score averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.functions.numbers import row_mean


def sentiment_by_topic(df: DataFrame, scores: list[str], topic: str = "topic") -> DataFrame:
    """(topic, sum, mean) of the row-wise mean of the scores."""
    total = row_mean(*[F.col(s) for s in scores])
    return df.groupBy(topic).agg(F.sum(total).alias("sum"), F.avg(total).alias("mean"))


def average_rating(ratings: DataFrame, titles: DataFrame, item: str, rating: str, title: str) -> DataFrame:
    """(item, title, average), best first. Items without a rating do not appear.

    Ratings are averaged before the join, so the join sees one row per item and a
    much-rated item cannot make it lopsided.
    """
    means = ratings.groupBy(item).agg(F.avg(rating).alias("average"))
    return means.join(titles.select(item, title), item).select(item, title, "average").orderBy(F.desc("average"), item)
