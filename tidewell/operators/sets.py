"""Unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def stack_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name, equal rows once."""
    return stack(frames).distinct()


def stack_tagged(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """All rows of all frames with the frame's name in a ``tag`` column."""
    return stack([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def net_of(entries: DataFrame, returns: DataFrame, amount: str) -> DataFrame:
    """Entries with their amounts and returns with the sign of theirs turned."""
    return entries.unionByName(returns.withColumn(amount, -F.col(amount)))


def unfold_distinct(df: DataFrame, columns: Sequence[Column], out: str) -> DataFrame:
    """One row per distinct non-null value of several columns of a row, in one scan.

    Replaces a union of one query per column.
    """
    values = F.array_distinct(F.array_compact(F.array(*columns)))
    return df.withColumn(out, F.explode(values)).distinct()
