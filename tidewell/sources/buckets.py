"""Tables kept in buckets of a key, so that joins and aggregates on it need no shuffle.

A bucket is one file, written by one task; rows of a key lie in one bucket, in order. Choose a key of
many values (a policy number, not a status), and so many buckets that one fits a task's memory.
Tables that are joined should have equal numbers of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..checks import require


def write_buckets(
    df: DataFrame, name: str, path: str, by: Sequence[str] | str, buckets: int, *, sort: Sequence[str] = (), fmt: str = "parquet"
) -> DataFrame:
    """Replace the catalog table ``name`` (its files under ``path``) and return it, in buckets of ``by``.

    Rows are shuffled by the key as the buckets are, so there is one file for each; within it they
    are ordered by ``sort`` (default: the key).
    """
    keys = [by] if isinstance(by, str) else list(by)
    require(df, name, *keys, *sort)
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format(fmt)
        .bucketBy(buckets, *keys)
        .sortBy(*(sort or keys))
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def drop_buckets(spark: SparkSession, name: str) -> None:
    """Forget the table; its files, which lie where the writer said, stay."""
    spark.sql(f"drop table if exists {name}")
