"""Conditions and the columns made from them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import ColumnLike, col


def yn(condition: Column) -> Column:
    """'Y' when the condition holds, 'N' when it fails or is unknown."""
    return F.when(condition, "Y").otherwise("N")


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def any_not_null(columns: Iterable[ColumnLike]) -> Column:
    return F.coalesce(*[col(c).cast("string") for c in columns]).isNotNull()


def is_or_null(c: ColumnLike, value) -> Column:
    return (col(c) == value) | col(c).isNull()


def null_when(
    df: DataFrame, condition: Column, columns: Sequence[str], zero_columns: Sequence[str] = ()
) -> DataFrame:
    """Blank ``columns`` and zero ``zero_columns`` in the rows where the condition holds."""
    return df.withColumns(
        {c: F.when(condition, F.lit(None)).otherwise(F.col(c)) for c in columns}
        | {c: F.when(condition, F.lit(0)).otherwise(F.col(c)) for c in zero_columns}
    )
