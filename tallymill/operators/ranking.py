"""Top rows of each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Splits of a group at each level of the merge; a split of one level joins those of the level before that
#: agree in their number modulo its own.
LEVELS = (256, 16)


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, tie_break: str, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank`` from 1.

    ``order`` has to be a total order; ``tie_break`` is a column that spreads the rows
    of one group. Each group is cut to k rows within hash splits, and these are merged level by
    level: a task sees a split of the group, then the k rows of a few splits, for every k. ``levels``
    are the numbers of splits, each a divisor of the one before.
    """
    rank = F.row_number()
    df = df.withColumn("split", F.xxhash64(tie_break))
    for splits in levels:
        df = df.withColumn("split", F.pmod("split", F.lit(splits)))
        local = Window.partitionBy(*keys, "split").orderBy(*order)
        df = df.withColumn("rank", rank.over(local)).where(F.col("rank") <= k).drop("rank")
    ranked = df.drop("split").withColumn("rank", rank.over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)
