"""Aggregate columns and aggregate pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.amounts import ratio, signed
from ..functions.dates import ColumnLike, col
from .windows import top_n_by


def any_value_of(c: ColumnLike) -> Column:
    """One non-null value of the group, the least, so that every run gives the same; else null."""
    return F.min(col(c))


def signed_sum(amount: ColumnLike, cr_or_dr: ColumnLike) -> Column:
    """Credits minus debits."""
    return F.sum(signed(amount, cr_or_dr))


def sum_if(condition: Column, value: ColumnLike) -> Column:
    """Sum over the rows meeting the condition; other rows count as 0, so it is never null."""
    return F.sum(F.when(condition, col(value)).otherwise(F.lit(0)))


def count_if(condition: Column, value: ColumnLike | None = None) -> Column:
    """Rows meeting the condition (with a non-null value, if one is named)."""
    return F.count(F.when(condition, F.lit(1) if value is None else col(value)))


def debit_credit_net(amount: ColumnLike, cr_or_dr: ColumnLike, scale: int = 1) -> list[Column]:
    """Debit, credit and net (debit minus credit) in one pass."""
    value = col(amount) * scale
    debit = sum_if(col(cr_or_dr) == "D", value)
    credit = sum_if(col(cr_or_dr) == "C", value)
    return [debit.alias("debit"), credit.alias("credit"), (debit - credit).alias("net")]


def weighted_sum(amount: ColumnLike, kind: ColumnLike, weights: Mapping[str, str]) -> Column:
    """Sum of amounts times the weight of their kind; kinds without a weight count nothing.

    Weights are decimal text, so that the sum is exact.
    """
    out = None
    for name, weight in weights.items():
        value = col(amount) * F.lit(weight).cast("decimal(5,4)")
        test = col(kind) == name
        out = F.when(test, value) if out is None else out.when(test, value)
    return F.sum(out.otherwise(F.lit(0)))


def text_list(c: ColumnLike, separator: str = ",") -> Column:
    """The group's distinct values in order, joined to one text; empty when there are none.

    A group's distinct values stand in one row: for codes and kinds, not for ids.
    """
    return F.concat_ws(separator, F.array_sort(F.collect_set(col(c))))


def value_set(c: ColumnLike) -> Column:
    """The group's distinct values as an ordered array, in one row; see :func:`text_list`."""
    return F.array_sort(F.collect_set(col(c)))


def top_list_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, n: int, out: str
) -> DataFrame:
    """Per key, the values of its first ``n`` rows as an array in that order.

    The rows are cut to ``n`` per key before they are gathered.
    """
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("__place", place)
        .where(F.col("__place") <= n)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("__place", F.col(value).alias("v")))).alias("__l"))
        .select(*keys, F.transform("__l", lambda x: x["v"]).alias(out))
    )


def densify(df: DataFrame, entity: str, dim: str, value: str, fill=0, *, most: int = 1000) -> DataFrame:
    """One row for every entity and every value of ``dim`` that occurs; gaps get ``fill``.

    ``dim`` is a short list by nature (months of a year, product types). It is attached to
    each entity as one array and unfolded, without a cross join. More than ``most`` values
    are an error, raised when the result is computed, not a longer array.
    """
    totals = df.where(F.col(entity).isNotNull() & F.col(dim).isNotNull()).groupBy(entity, dim).agg(
        F.sum(value).alias(value)
    )
    listed = totals.select(dim).distinct().limit(most + 1).agg(F.array_sort(F.collect_set(dim)).alias("__dims"))
    too_many = F.raise_error(F.lit(f"densify: more than {most} values of {dim}"))
    all_dims = listed.select(F.when(F.size("__dims") > most, too_many).otherwise(F.col("__dims"))).scalar()
    own = totals.groupBy(entity).agg(F.map_from_entries(F.collect_list(F.struct(dim, value))).alias("__own"))
    return (
        own.withColumn("__dims", all_dims)
        .withColumn(dim, F.explode("__dims"))
        .select(
            entity,
            dim,
            F.coalesce(F.element_at("__own", F.col(dim)), F.lit(fill)).alias(value),
        )
    )


def best_by_distinct_count(
    df: DataFrame, key: str, item: str, counted: str, out: str | None = None
) -> DataFrame:
    """Per key, the item seen with the most distinct ``counted`` values; least item on ties."""
    counts = df.where(F.col(key).isNotNull() & F.col(item).isNotNull()).groupBy(key, item).agg(
        F.countDistinct(counted).alias("__n")
    )
    best = top_n_by(counts, [key], [F.col("__n").desc(), F.col(item)], 1)
    return best.select(key, F.col(item).alias(out or item), F.col("__n").alias("times"))


@dataclass(frozen=True)
class Metric:
    """One measure of :func:`rolling_kpis`.

    ``sum`` metrics add ``value``; ``distinct`` metrics count its distinct values. ``where``
    limits the rows and ``month`` names the month-offset column, if it is not the common one.
    """

    name: str
    kind: str
    value: ColumnLike
    where: Column | None = None
    month: ColumnLike | None = None


WINDOWS = {"last_mth": 1, "last_yr": 12, "last_3m": 3, "last_6m": 6}


def rolling_kpis(
    df: DataFrame,
    key: str,
    month: ColumnLike,
    metrics: Sequence[Metric],
    windows: Mapping[str, int] = WINDOWS,
    amount_type: str = "decimal(28,6)",
) -> DataFrame:
    """All metrics over all windows that end in the report month, one row per key.

    ``month`` is the month offset, -1 for the report month, -2 for the month before, and so
    on. Columns are named ``<window>_<metric>``; a metric with no row in a window is null.

    Each row is unfolded into its (metric, item) entries once and summed per key, metric and
    item before anything else. As every window ends in the same month, an item lies in a
    window exactly when its newest month does, so distinct counts need no distinct pass.
    """
    if not metrics:
        raise ValueError("no metrics")
    longest = max(windows.values())
    entries = []
    for m in metrics:
        offset = col(month if m.month is None else m.month).cast("int")
        inside = offset.between(-longest, -1)
        if m.where is not None:
            inside = inside & m.where
        if m.kind == "sum":
            item = offset.cast("string")
            amount = F.coalesce(col(m.value), F.lit(0)).cast(amount_type)
        elif m.kind == "distinct":
            item = col(m.value).cast("string")
            amount = F.lit(None).cast(amount_type)
        else:
            raise ValueError(f"metric kind {m.kind}")
        entries.append(
            F.when(
                F.coalesce(inside, F.lit(False)),
                F.struct(
                    F.lit(m.name).alias("metric"),
                    item.alias("item"),
                    offset.alias("offset"),
                    amount.alias("amount"),
                ),
            )
        )
    partial = (
        df.select(F.col(key), F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy(key, "e.metric", "e.item")
        .agg(F.max("e.offset").alias("newest"), F.sum("e.amount").alias("amount"))
    )
    out = []
    for m in metrics:
        for label, size in windows.items():
            hit = (F.col("metric") == m.name) & (F.col("newest") >= -size)
            if m.kind == "sum":
                value = F.sum(F.when(hit, F.col("amount")))
            else:
                value = F.when(count_if(hit) > 0, F.count(F.when(hit, F.col("item"))))
            out.append(value.alias(f"{label}_{m.name}"))
    return partial.groupBy(key).agg(*out)


@dataclass(frozen=True)
class Kpi:
    """One line of a long KPI table.

    ``num`` is summed; with ``den`` the value is the ratio of the two sums. ``sub`` is the
    split within the KPI, ``where`` the rows it counts.
    """

    name: str
    num: Column
    sub: Column | None = None
    den: Column | None = None
    where: Column | None = None


KPI_AMOUNT = "decimal(28,6)"


def kpi_block(df: DataFrame, kpis: Sequence[Kpi], dims: Sequence[str]) -> DataFrame:
    """Long table (kpi, kpi_sub, dims.., kpi_val) of many KPIs from one pass over ``df``.

    Each row is unfolded into one entry per KPI it counts for, then everything is summed in
    one aggregate.
    """
    require(df, "kpi input", *dims)
    entries = []
    for k in kpis:
        entry = F.struct(
            F.lit(k.name).alias("kpi"),
            (F.lit(None) if k.sub is None else k.sub).cast("string").alias("kpi_sub"),
            k.num.cast(KPI_AMOUNT).alias("num"),
            (F.lit(None) if k.den is None else k.den).cast(KPI_AMOUNT).alias("den"),
            F.lit(k.den is not None).alias("is_ratio"),
        )
        entries.append(entry if k.where is None else F.when(k.where, entry))
    return (
        df.select(*dims, F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.kpi", "e.kpi_sub", "e.is_ratio", *dims)
        .agg(F.sum("e.num").alias("num"), F.sum("e.den").alias("den"))
        .select(
            "kpi",
            "kpi_sub",
            *dims,
            F.when(F.col("is_ratio"), ratio("num", "den"))
            .otherwise(F.col("num").cast("double"))
            .alias("kpi_val"),
        )
    )
