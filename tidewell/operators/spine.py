"""Filling gaps from a spine of the rows there should be, made by joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require


def month_calendar(spark, start: date, end: date) -> DataFrame:
    """(``year``, ``month``) of every month from ``start`` to ``end``, by its first day."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    if last < first:
        raise ValueError("the calendar is empty")
    number = F.col("id").cast("int")
    months = spark.range(first, last + 1, numPartitions=1)  # twelve rows a year
    year = F.floor(number / 12).cast("int")
    return months.select(year.alias("year"), F.make_date(year, number % 12 + 1, F.lit(1)).alias("month"))


def densify_months(df: DataFrame, entity: str, day: str, value: str, start: date, end: date, fill=0) -> DataFrame:
    """One row for every entity and every month from ``start`` to ``end``: the month's sum, or ``fill``.

    Entities are those with a row in that time. They meet the calendar by year, and the sums by entity
    and month; nothing gathers an entity's values or the list of months.
    """
    require(df, "rows", entity, day, value)
    month = F.trunc(day, "month")
    calendar = month_calendar(df.sparkSession, start, end)
    low, high = date(start.year, start.month, 1), date(end.year, end.month, 1)
    sums = (
        df.where(F.col(entity).isNotNull() & month.between(F.lit(low), F.lit(high)))
        .groupBy(F.col(entity).alias("__entity"), month.alias("__month"))
        .agg(F.sum(value).alias("__sum"))
    )
    years = F.explode(F.sequence(F.lit(start.year), F.lit(end.year))).alias("year")
    spine = sums.select("__entity").distinct().select(F.col("__entity").alias(entity), years).join(calendar, "year")
    met = spine.join(sums, (F.col(entity) == F.col("__entity")) & (F.col("month") == F.col("__month")), "left")
    return met.select(entity, "month", F.coalesce("__sum", F.lit(fill)).alias(value))


def densify_within(df: DataFrame, group: str, entity: str, dim: str, value: str, fill=0) -> DataFrame:
    """One row for every entity and every value of ``dim`` that occurs in the entity's group.

    Two distinct sets, (group, entity) and (group, value), are joined by the group. An entity
    of several groups has rows in each.
    """
    require(df, "rows", group, entity, dim, value)
    known = df.where(F.col(group).isNotNull() & F.col(entity).isNotNull() & F.col(dim).isNotNull())
    sums = known.groupBy(group, entity, dim).agg(F.sum(value).alias(value))
    spine = sums.select(group, entity).distinct().join(sums.select(group, dim).distinct(), group)
    return spine.join(sums, [group, entity, dim], "left").withColumn(value, F.coalesce(value, F.lit(fill)))
