"""Reading tables: folders, partitions, catalog names, CSV, whole databases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..checks import require


def lower_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def clean_columns(
    df: DataFrame, *, strip: bool = True, drop: Sequence[str] = (), replace: str = ""
) -> DataFrame:
    """Column names without outer blanks and without the given parts (prefixes, suffixes)."""
    names = []
    for name in df.columns:
        name = name.strip() if strip else name
        for part in drop:
            name = name.replace(part, replace)
        names.append(name)
    if len({n.lower() for n in names}) != len(names):
        raise ValueError(f"cleaning makes column names collide: {names}")
    return df.toDF(*names)


def read_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    lower: bool = True,
) -> DataFrame:
    """A table folder. ``columns`` prunes the scan; ``fmt`` may name any installed source.

    The Delta source is one such ``fmt``; it needs its jar on the cluster.
    """
    df = spark.read.format(fmt).load(path)
    if lower:
        df = lower_columns(df)
    if columns is None:
        return df
    require(df, path, *columns)
    return df.select(*columns)


def read_partition(
    spark: SparkSession, path: str, column: str, value, *, fmt: str = "parquet"
) -> DataFrame:
    """One partition of a partitioned folder, with its partition column kept.

    The filter is on the partition column, so only that directory is listed and read.
    """
    df = spark.read.format(fmt).load(path)
    require(df, path, column)
    return lower_columns(df.where(F.col(column) == F.lit(value)))


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A table the catalog knows by name."""
    return lower_columns(spark.table(name))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV folder with header lines and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def load_tables(
    spark: SparkSession, roots: Iterable[str], names: Iterable[str], *, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Tables by lower-case name, each from the first root folder that holds it.

    A name may carry a trailing slash or a file suffix; the key has neither.
    """
    bases = [r.rstrip("/") for r in roots]
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    loaded = {}
    for name in names:
        leaf = name.strip("/")
        for base in bases:
            path = hadoop.Path(f"{base}/{leaf}")
            if path.getFileSystem(conf).exists(path):
                key = leaf.rsplit("/", 1)[-1].split(".", 1)[0].lower()
                loaded[key] = read_table(spark, f"{base}/{leaf}", fmt=fmt)
                break
        else:
            raise FileNotFoundError(f"table {name} is in none of {bases}")
    return loaded


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make every table of the map a session view under its key."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(
    spark: SparkSession,
    sql: str,
    params: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """SQL text with ``:name`` markers bound as typed values, never pasted.

    ``{name}`` marks in the text take DataFrames from ``tables``, without a session view.
    """
    return spark.sql(sql, args=dict(params or {}), **dict(tables or {}))
