"""Leaderboards and group maxima."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of a total order (each task sends on at most ``k`` rows)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group.

    Spark limits each group to ``k`` rows before the shuffle, so a hot group
    reaches its final task as at most ``k`` rows per map task.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return numbered.filter(F.col(rank) <= k)


def keep_group_max(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every row that holds its group's maximum; ties stay.

    The maximum is reduced before the shuffle. The rows are then matched on keys *and*
    value: only tied rows of one group can meet in a task.
    """
    best = df.groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(best, [*keys, value], "left_semi")
