"""Joins beyond the plain ``DataFrame.join``.

No broadcast is forced on a table: Spark broadcasts a side when its size, known from the
files or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``, and shuffles
both sides otherwise. One-row results are attached as scalar subqueries, never by cross join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.dates import month_index, whole_months
from .windows import latest_by


def decode(
    df: DataFrame,
    codes: DataFrame,
    list_name: str,
    column: str,
    out: str,
    *,
    how: str = "inner",
    text: str = "fld_valu_desc",
) -> DataFrame:
    """Add the text of a code, looked up in one list of the shared code table.

    ``codes`` has (fld_nm, fld_valu, and the ``text`` column). With ``how="left"`` unknown
    codes stay, with null text; with ``inner`` their rows go.
    """
    require(codes, "codes", "fld_nm", "fld_valu", text)
    named = codes.where(F.col("fld_nm") == list_name).select(
        F.col("fld_valu").alias("__code"), F.col(text).alias(out)
    )
    return df.join(named, df[column] == named["__code"], how).drop("__code")


def lookup(
    df: DataFrame,
    ref: DataFrame,
    on: str,
    key: str,
    value: str,
    out: str,
    *,
    order: Sequence[Column] | None = None,
    default=None,
) -> DataFrame:
    """Add ``out``: the value ``ref`` holds for the row's ``on`` key, else ``default``.

    Each key gives one value, so rows never multiply. Of several, the greatest under
    ``order`` (default: the value itself) is taken.
    """
    if order is None:
        # An aggregate needs no sort and meets the keys before the shuffle.
        single = ref.groupBy(F.col(key).alias("__key")).agg(F.max(value).alias("__value"))
    else:
        single = latest_by(ref, [key], list(order)).select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    found = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    return (
        df.join(single, df[on] == single["__key"], "left")
        .withColumn(out, found)
        .drop("__key", "__value")
    )


def lookup_first(
    df: DataFrame, ref: DataFrame, keys: Sequence[str], ref_key: str, value: str, out: str
) -> DataFrame:
    """Add ``out`` from the first of several key columns that is found in ``ref``.

    Every key column is a left join of its own, as a found key may have several values.
    """
    result, found = df, []
    for i, key in enumerate(keys):
        side = ref.select(F.col(ref_key).alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        result = result.join(side, F.col(key) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        found.append(f"__v{i}")
    return result.withColumn(out, F.coalesce(*[F.col(c) for c in found])).drop(*found)


def semi_or(df: DataFrame, keys: DataFrame, on: str, condition: Column) -> DataFrame:
    """Rows whose key is listed in ``keys``, or that meet the condition.

    ``keys`` has a column named like ``on``; it is made distinct, so rows never multiply.
    """
    marked = keys.select(F.col(on).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    return (
        df.join(marked, df[on] == marked["__key"], "left")
        .where(F.col("__key").isNotNull() | F.coalesce(condition, F.lit(False)))
        .drop("__key")
    )


def month_range_join(
    df: DataFrame,
    rates: DataFrame,
    on: tuple[str, str],
    date: str,
    start: str,
    low: int = 0,
    high: int = 2,
    *,
    how: str = "left",
) -> DataFrame:
    """Join each row to the rates that started ``low`` to ``high`` whole months before it.

    ``on`` names the key in ``df`` and in ``rates``. A rate is spread over the calendar
    months its range can touch, so the join is an equi join on key and month; the exact test
    on whole months follows. Work is split by key and month.
    """
    left_key, right_key = on
    spread = rates.withColumn(
        "__month",
        F.explode(F.sequence(month_index(start) + low, month_index(start) + high + 1)),
    )
    lhs = df.withColumn("__row_month", month_index(date))
    condition = (
        (lhs[left_key] == spread[right_key])
        & (lhs["__row_month"] == spread["__month"])
        & whole_months(lhs[date], spread[start]).between(low, high)
    )
    joined = lhs.join(spread, condition, how).drop("__row_month", "__month")
    return joined.drop(spread[right_key])


def interval_join(
    a: DataFrame,
    b: DataFrame,
    on: Sequence[tuple[str, str]],
    date_a: str,
    date_b: str,
    low: int,
    high: int,
    *,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows with equal keys where ``date_b`` is ``low`` to ``high`` days after ``date_a``.

    The time axis is cut into slots as wide as the interval. A row of ``a`` lies in the one
    slot of its date; a row of ``b`` is put into the one or two slots it can be reached from.
    So only near pairs are formed, every pair meets once, and a key that holds a large part
    of the rows is spread over its slots. ``how`` is ``inner`` or ``left``; the two inputs
    must not share column names.
    """
    if high < low:
        raise ValueError("interval is empty")
    if how not in ("inner", "left"):
        raise ValueError("interval_join is inner or left")
    shared = set(a.columns) & set(b.columns)
    if shared:
        raise ValueError(f"interval_join inputs share columns {sorted(shared)}")
    width = high - low + 1
    epoch = F.lit("1970-01-01").cast("date")

    def slot(date: Column) -> Column:
        return F.floor(F.datediff(date, epoch) / width).cast("int")

    placed = a.withColumn("__slot", slot(F.col(date_a)))
    reached = F.array(slot(F.date_sub(F.col(date_b), high)), slot(F.date_sub(F.col(date_b), low)))
    spread = b.where(F.col(date_b).isNotNull()).withColumn(
        "__slot_b", F.explode(F.array_distinct(reached))
    )
    condition = reduce(
        lambda x, y: x & y,
        [F.col(ka) == F.col(kb) for ka, kb in on],
        (F.col("__slot") == F.col("__slot_b"))
        & F.datediff(F.col(date_b), F.col(date_a)).between(low, high),
    )
    return placed.join(spread, condition, how).drop("__slot", "__slot_b")


def snapshot_join(
    a: DataFrame, b: DataFrame, keys: Sequence[str], *, date: str = "image_date", how: str = "inner"
) -> DataFrame:
    """Join two month-end tables on their keys within the same snapshot date."""
    return a.join(b, [date, *keys], how)


def with_top_row(
    df: DataFrame, ref: DataFrame, order: Sequence[Column], columns: Sequence[str], condition=None
) -> DataFrame:
    """Add columns of the first row of ``ref`` under ``order`` to the rows meeting ``condition``.

    The first row is found by a top-1 over ``ref`` and attached as one scalar value, null when
    ``ref`` is empty. ``condition`` is a function of the top row's column.
    """
    top = (
        ref.orderBy(*order)
        .limit(1)
        .select(F.struct(*[F.col(c) for c in columns]).alias("__top"))
        .scalar()
    )
    wide = df.withColumn("__top", top)
    keep = F.lit(True) if condition is None else F.coalesce(condition(F.col("__top")), F.lit(False))
    return wide.withColumns({c: F.when(keep, F.col("__top")[c]) for c in columns}).drop("__top")


def side_by_side(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Outer join of several one-row-per-key results on their key."""
    return reduce(lambda x, y: x.join(y, key, "full_outer"), frames)
