"""Exact distinct counts that roll up, from bitmaps kept for each combination of dimensions.

Distinct counts can't be added; bitmaps of the ids can be united. A state holds, for each
combination of dimensions and each range of 64 ids that has one, a bitmap of 8 bytes, so it has no more rows than
there are ids by combination, however few of them each combination has. It is built once, stored, brought up to
date by uniting it with the state of new rows, and counted for any subset of its dimensions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..checks import require


def distinct_state(df: DataFrame, dims: Sequence[str], item: str) -> DataFrame:
    """(dims.., bucket, bits) of the ids in ``item``, whole numbers; null ids don't count.

    The nearer the ids lie to each other, the fewer bitmaps there are. Text has no place in a
    bitmap, and a hash would not be exact, so other types are refused.
    """
    require(df, "rows", *dims, item)
    if not isinstance(df.schema[item].dataType, IntegralType):
        raise TypeError(f"{item} is {df.schema[item].dataType.simpleString()}; bitmaps count whole numbers")
    ids = F.col(item).cast("bigint")
    rows = df.where(F.col(item).isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), ids.bitwiseAND(63).cast("int"))
    return rows.groupBy(*dims, F.shiftright(ids, 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))


def roll_up(state: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The state for fewer dimensions."""
    return state.groupBy(*dims, "bucket").agg(F.bit_or("bits").alias("bits"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several with the same dimensions, such as the stored one and that of new rows."""
    first, *others = states
    both = first
    for other in others:
        both = both.unionByName(other)
    return roll_up(both, [c for c in first.columns if c not in ("bucket", "bits")])


def distinct_count(state: DataFrame, dims: Sequence[str], out: str = "n") -> DataFrame:
    """Distinct ids by ``dims``, or of all rows (one row, 0 for an empty state) without any."""
    counted = roll_up(state, dims).withColumn("__n", F.bit_count("bits"))
    return counted.groupBy(*dims).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias(out))
