"""As-of join: the newest reference row at or before each row's date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checks import require
from .windows import latest_by


def as_of_join(
    df: DataFrame,
    ref: DataFrame,
    on: Sequence[tuple[str, str]],
    date: str,
    start: str,
    columns: Sequence[str],
    *,
    order: Sequence[Column] = (),
    slot_days: int = 366,
    within_days: int | None = None,
) -> DataFrame:
    """``df`` with ``columns`` of the newest row of ``ref`` of the same key whose ``start`` is not after ``date``.

    ``on`` pairs key columns of ``df`` and ``ref``. Every row of ``df`` stays, once; the columns are null
    where there is no such row, where a key or the date is null, or where the newest one is more than
    ``within_days`` older. Of several reference rows of one key and start the first under ``order``
    (default: the least values of ``columns``) counts.

    Both sides are put on one time line for each key and the last reference row is carried forward, so
    no pairs form. The line is cut into slots of ``slot_days``: what a slot opens with is carried over
    the slots (one row each) first, and the rows are ordered within their slots alone, so a key that
    holds most of the rows is worked on by as many tasks as it has slots.
    """
    require(df, "rows", date, *[a for a, _ in on])
    require(ref, "reference", start, *columns, *[b for _, b in on])
    clash = set(columns) & set(df.columns)
    if clash:
        raise ValueError(f"as_of_join columns {sorted(clash)} are in both inputs")
    keys = [f"__k{i}" for i in range(len(on))]
    epoch = F.lit("1970-01-01").cast("date")

    def slot(day: str) -> Column:
        return F.floor(F.datediff(F.col(day), epoch) / slot_days).cast("int")

    rates = ref.where(F.col(start).isNotNull()).select(
        *[F.col(b).alias(k) for (_, b), k in zip(on, keys, strict=True)],
        F.col(start).alias("__day"),
        F.struct(F.col(start).alias("__start"), *[F.col(c) for c in columns]).alias("__ref"),
        *[expr.alias(f"__o{i}") for i, expr in enumerate(order or [F.col(c) for c in columns])],
    )
    places = [F.col(f"__o{i}").asc_nulls_last() for i in range(len(order or columns))]
    rates = latest_by(rates, [*keys, "__day"], places).select(*keys, "__day", "__ref", F.lit(None).cast(_struct(df)).alias("__row"))
    rows = df.select(
        *[F.col(a).alias(k) for (a, _), k in zip(on, keys, strict=True)],
        F.col(date).alias("__day"),
        F.lit(None).cast(rates.schema["__ref"].dataType).alias("__ref"),
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
    )
    line = rows.unionByName(rates).withColumn("__slot", slot("__day"))

    # a slot ends with its newest reference row; the next one with rows opens with it
    ends = line.groupBy(*keys, "__slot").agg(F.max_by("__ref", F.when(F.col("__ref").isNotNull(), F.col("__day"))).alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    opens = ends.select(
        *[F.col(k).alias(f"{k}o") for k in keys], F.col("__slot").alias("__so"), F.last("__end", ignorenulls=True).over(earlier).alias("__open")
    )
    inside = Window.partitionBy(*keys, "__slot").orderBy("__day", F.col("__row").isNotNull())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = line.withColumn("__own", F.last("__ref", ignorenulls=True).over(inside)).where(F.col("__row").isNotNull())
    same = F.col("__slot") == F.col("__so")
    for k in keys:
        same = same & (F.col(k) == F.col(f"{k}o"))
    met = carried.join(opens, same, "left").withColumn("__found", F.coalesce("__own", "__open"))
    keyed = F.col("__day").isNotNull()
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    if within_days is not None:
        keyed = keyed & (F.datediff("__day", "__found.__start") <= within_days)
    return met.select(
        *[F.col("__row")[c].alias(c) for c in df.columns], *[F.when(keyed, F.col("__found")[c]).alias(c) for c in columns]
    )


def _struct(df: DataFrame):
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r")).schema["r"].dataType
