"""Cosine similarity of one entity to all entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.functions.numbers import cosine
from tallymill.session import written_table


def similarity_to(ratings: DataFrame, target, entity: str, dimension: str, value: str) -> DataFrame:
    """(entity, similarity) of every entity to ``target``, most similar first.

    Vectors have one component per ``dimension``, the summed values, and 0 where there
    is none, so an entity that shares nothing with the target appears with 0. The summed
    cells are written once, whatever the ratings were derived from. Only the target's vector is
    joined: the dot product and the norm of every entity come from one aggregate, and pairs of
    other entities are never formed. The join carries no hint, because the target's vector has
    no bound; its measured size decides.
    """
    known = ratings.where(F.col(entity).isNotNull() & F.col(dimension).isNotNull())
    total = F.sum(F.col(value).cast("double"))
    cells = written_table(known.groupBy(entity, dimension).agg(total.alias("v")), "similarity-cells")
    own = written_table(cells.where(F.col(entity) == F.lit(target)).select(dimension, F.col("v").alias("t")), "similarity-own")
    own_square = own.agg(F.sum(F.col("t") * F.col("t"))).scalar()
    sums = (
        cells.join(own, dimension, "left")
        .groupBy(entity)
        .agg(F.sum(F.col("v") * F.col("t")).alias("dot"), F.sum(F.col("v") * F.col("v")).alias("square"))
    )
    similarity = cosine(F.coalesce("dot", F.lit(0.0)), F.col("square"), own_square)
    return sums.select(entity, similarity.alias("similarity")).orderBy(F.desc("similarity"), entity)


def user_similarity(ratings: DataFrame, target, user: str, item: str, value: str) -> DataFrame:
    """Similarity of all users to one user by their ratings of the items."""
    return similarity_to(ratings, target, user, item, value)


def item_similarity(ratings: DataFrame, target, user: str, item: str, value: str) -> DataFrame:
    """Similarity of all items to one item by the ratings of the users."""
    return similarity_to(ratings, target, item, user, value)
