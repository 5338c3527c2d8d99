"""Rolling measures from stored monthly partial aggregates.

A partial holds, for each key, month and metric, either the month's sum or one row for each distinct
item. A month is summed up once, when it is over; partials of one month from several runs merge by
summing again, and every window is worked out from the months it covers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ColumnLike, col
from ..sources.sinks import write_partitions
from .aggregates import WINDOWS, Metric, count_if


def monthly_partials(
    df: DataFrame, key: str, month: ColumnLike, metrics: Sequence[Metric], amount_type: str = "decimal(28,6)"
) -> DataFrame:
    """Rows (key, month, metric, item, amount); ``month`` is a month number (year * 12 + month).

    Items are the distinct values of ``distinct`` metrics and null for sums. Each metric may name a month
    column of its own; rows without a month, or outside a metric's ``where``, don't count for it.
    """
    if not metrics:
        raise ValueError("no metrics")
    entries = []
    for m in metrics:
        when = col(month if m.month is None else m.month).cast("int")
        if m.kind == "sum":
            item, amount = F.lit(None).cast("string"), F.coalesce(col(m.value), F.lit(0)).cast(amount_type)
        elif m.kind == "distinct":
            item, amount = col(m.value).cast("string"), F.lit(None).cast(amount_type)
        else:
            raise ValueError(f"metric kind {m.kind}")
        counts = when.isNotNull() if m.where is None else when.isNotNull() & m.where
        entry = F.struct(F.lit(m.name).alias("metric"), when.alias("month"), item.alias("item"), amount.alias("amount"))
        entries.append(F.when(F.coalesce(counts, F.lit(False)), entry))
    rows = df.select(F.col(key), F.explode(F.array_compact(F.array(*entries))).alias("e"))
    return merge_partials(rows.select(key, "e.month", "e.metric", "e.item", "e.amount"), key)


def merge_partials(partials: DataFrame, key: str) -> DataFrame:
    """Partials of the same months as one."""
    return partials.groupBy(key, "month", "metric", "item").agg(F.sum("amount").cast("decimal(38,6)").alias("amount"))


def drop_months(spark: SparkSession, path: str, before: int) -> list[int]:
    """Delete the month folders of a partial store that lie before a month number; returns these months."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(place):
        name, _, value = status.getPath().getName().partition("=")
        if name == "month" and value.isdigit() and int(value) < before:
            files.delete(status.getPath(), True)
            gone.append(int(value))
    return sorted(gone)


def advance(partials: DataFrame, path: str, month: int, keep: int = 12) -> None:
    """Put one month's partials into the store and let go of those older than ``keep`` months.

    The month's folder is replaced, so a rerun changes nothing else.
    """
    write_partitions(partials.where(F.col("month") == month), path, "month")
    drop_months(partials.sparkSession, path, month - keep + 1)


def rolling_from_partials(
    partials: DataFrame, key: str, last: int, metrics: Sequence[Metric], windows: Mapping[str, int] = WINDOWS
) -> DataFrame:
    """What :func:`~.aggregates.rolling_kpis` gives, for windows that end in month number ``last``.

    As every window ends there, an item lies in a window exactly when its newest month does.
    """
    longest = max(windows.values())
    inside = partials.where(F.col("month").between(last - longest + 1, last))
    # sums keep their months apart until the windows are known, items only their newest one
    apart = F.when(F.col("item").isNull() & F.col("amount").isNotNull(), F.col("month"))
    found = inside.groupBy(key, "metric", "item", apart.alias("apart")).agg(
        F.max("month").alias("newest"), F.sum("amount").alias("amount")
    )
    out = []
    for m in metrics:
        for label, size in windows.items():
            hit = (F.col("metric") == m.name) & (F.col("newest") > last - size)
            total = F.sum(F.when(hit, F.col("amount")))
            items = F.when(count_if(hit) > 0, F.count(F.when(hit, F.col("item"))))
            out.append((total if m.kind == "sum" else items).alias(f"{label}_{m.name}"))
    return found.groupBy(key).agg(*out)
