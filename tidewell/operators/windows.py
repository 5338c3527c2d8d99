"""Picking rows per key, flags by first occurrence, group extremes.

``row_number`` and ``rank`` filters with a fixed bound are cut down to that bound before the
shuffle (window group limit), so a key that holds most of the rows sends only a few of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key under ``order``.

    Give an order that ends in a unique column, or equal rows are picked arbitrarily.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``."""
    return top_n_by(df, keys, order, 1)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of every key; ``order`` lists descending columns, newest first."""
    return top_n_by(df, keys, order, 1)


def first_ties_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows of every key that share its first place under ``order``."""
    place = F.rank().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") <= 1).drop("__place")


def with_group_extremes(
    df: DataFrame, keys: Sequence[str], column: str, low: str, high: str
) -> DataFrame:
    """Add the least and greatest value of a column within the row's group.

    The extremes are aggregated first and joined back, so no group is gathered in one task.
    Null keys form a group.
    """
    extremes = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.min(column).alias(low), F.max(column).alias(high)
    )
    condition = reduce(lambda a, b: a & b, [df[k].eqNullSafe(extremes[f"__{k}"]) for k in keys])
    return df.join(extremes, condition, "left").drop(*[f"__{k}" for k in keys])


def with_first_flag(
    df: DataFrame,
    key: str,
    order: Sequence[Column],
    item: str,
    first: str = "if_first",
    repeat: str = "repeat_sales",
) -> DataFrame:
    """Add 0/1 flags: the row's item is the first one of some key, and its complement."""
    firsts = first_by(df.where(F.col(key).isNotNull()), [key], order)
    marked = firsts.select(F.col(item).alias("__item")).distinct()
    hit = F.col("__item").isNotNull().cast("int")
    return (
        df.join(marked, df[item] == marked["__item"], "left")
        .withColumns({first: hit, repeat: 1 - hit})
        .drop("__item")
    )
