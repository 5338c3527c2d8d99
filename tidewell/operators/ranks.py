"""Ranks over a whole table without gathering it in one task.

Equal values are counted together first, so a value that fills a third of the table is one
row. The distinct values are then range-partitioned, as finely as the session shuffles; ranks
are running sums within a range plus the size of the ranges above. The limits of the ranges only
steer balance: any limits give the same, exact ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import settle


def value_ranks(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with ``above`` (rows with a greater value) and ``ties`` (rows with it)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("ties"))
    # Settled, so that a value's range is the same wherever it is read.
    ranged = settle(
        counts.repartitionByRange(F.col(value).desc()).withColumn("__range", F.spark_partition_id())
    )
    inside = (
        Window.partitionBy("__range")
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per range
    ahead = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        ranged.groupBy("__range")
        .agg(F.sum("ties").alias("n"))
        .select("__range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    )
    return (
        ranged.withColumn("inside", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
        .join(sizes, "__range")
        .select(value, (F.col("inside") + F.col("before")).alias("above"), "ties")
    )


def median_of(df: DataFrame, value: str) -> Column:
    """The exact median of a column as a scalar: the mean of the two middle values, null for none."""
    ranks = value_ranks(df, value)
    n = ranks.agg(F.sum("ties")).scalar()
    below = n - F.col("above") - F.col("ties")

    def at(place: Column) -> Column:
        return F.max(F.when((below <= place) & (place < below + F.col("ties")), F.col(value).cast("double")))

    return ranks.agg((at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).scalar()


def _join_ranks(df: DataFrame, ranks: DataFrame, value: str, **outputs: Column) -> DataFrame:
    """Add columns made from (above, ties) of the row's value; null values get null."""
    made = ranks.select(F.col(value).alias("__value"), *[c.alias(n) for n, c in outputs.items()])
    return df.join(made, df[value] == made["__value"], "left").drop("__value")


def _mean_rank() -> Column:
    return F.floor(F.col("above") + 1 + (F.col("ties") - 1) / 2).cast("bigint")


def with_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Add the descending rank; ties share the lowest number. Null values get null.

    The input is read several times and therefore settled first; aggregate before ranking.
    """
    rows = settle(df)
    return _join_ranks(rows, value_ranks(rows, value), value, **{out: F.col("above") + 1})


def with_mean_rank(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Add the descending rank; ties get the mean of their places, cut to an integer."""
    rows = settle(df)
    return _join_ranks(rows, value_ranks(rows, value), value, **{out: _mean_rank()})


def with_rank_share(
    df: DataFrame, value: str, total: Column, out: str = "rank_share", *, rank: str = "rank"
) -> DataFrame:
    """Add the descending rank and its share of ``total``."""
    return with_rank(df, value, rank).withColumn(
        out, F.try_divide(F.col(rank).cast("double"), total.cast("double"))
    )


def with_standing(df: DataFrame, value: str, out: str = "standing") -> DataFrame:
    """Add the share of rows below: ``(N - mean rank) / N``, at most 0.99, the lowest set to 0."""
    rows = settle(df)
    total = rows.agg(F.count(F.lit(1))).scalar()
    ranks = value_ranks(rows, value).withColumn("__n", total.cast("double"))
    raw = F.least(F.try_divide(F.col("__n") - _mean_rank(), F.col("__n")), F.lit(0.99))
    scored = ranks.withColumn("__raw", raw)
    lowest = scored.agg(F.min("__raw")).scalar()
    scored = scored.withColumn("__low", lowest)
    final = F.when(F.col("__raw") == F.col("__low"), 0.0).otherwise(F.col("__raw"))
    return _join_ranks(rows, scored, value, **{out: final})
