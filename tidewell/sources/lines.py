"""CSV files with lines that can't be read: told apart, kept, counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: The column that holds the text of a line that doesn't fit the schema.
BAD = "_bad_line"


def _declared(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _casting(kind: str):
    return lambda x: x.try_cast(kind)


def read_lines(spark: SparkSession, path: str, schema: StructType | str, *, separator: str = ";") -> DataFrame:
    """All lines of a CSV folder with header lines, those that don't fit with their text in ``_bad_line``.

    A line fits when it has as many fields as ``schema`` and every one can be read as its type. Array
    columns are lists joined by ``separator``, as :func:`~tidewell.sources.write_csv` writes them; an
    empty field is a null list, and a list that holds an element that can't be read makes the line a bad one.
    All columns are parsed whatever is selected, so a line is judged alike in every query.
    """
    declared = _declared(schema)
    plain = [StructField(f.name, StringType() if isinstance(f.dataType, ArrayType) else f.dataType) for f in declared.fields]
    raw = (
        spark.read.schema(StructType([*plain, StructField(BAD, StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD)
        .option("columnPruning", False)
        .csv(path)
    )
    out, broken = [], F.lit(False)
    for f in declared.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType):
            kind = f.dataType.elementType.simpleString()
            parts = F.split(value, "[" + separator + "]")
            read = F.transform(parts, _casting(kind))
            broken = broken | F.coalesce(F.exists(read, lambda x: x.isNull()), F.lit(False))
            value = read
        out.append(value.alias(f.name))
    whole = F.concat_ws(",", *[F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")) for f in declared.fields])
    # Spark refuses to read the bad lines' column alone, so it stands with (nothing of) another one
    text = F.concat(F.col(BAD), F.substring(whole, 1, 0))
    bad = F.when(F.col(BAD).isNotNull(), text).when(broken, whole)
    return raw.select(*out, bad.alias(BAD))


def read_checked(
    spark: SparkSession, path: str, schema: StructType | str, *, separator: str = ";"
) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, lines that don't) of :func:`read_lines`; together they are all lines."""
    lines = read_lines(spark, path, schema, separator=separator)
    good = lines.where(F.col(BAD).isNull()).drop(BAD)
    bad = lines.where(F.col(BAD).isNotNull()).select(F.col(BAD).alias("line"))
    return good, bad


def quarantine(bad: DataFrame, path: str, *, source: str) -> None:
    """Add bad lines to the quarantine table, a folder for each ``source``; a rerun replaces its source's lines."""
    from .sinks import write_partitions

    write_partitions(bad.withColumn("source", F.lit(source)), path, "source")


def line_counts(spark: SparkSession, path: str, schema: StructType | str, *, separator: str = ";") -> DataFrame:
    """One row: ``n_good`` and ``n_bad``, which add up to ``n_lines``."""
    bad = F.count(BAD)
    return read_lines(spark, path, schema, separator=separator).agg(
        (F.count(F.lit(1)) - bad).alias("n_good"), bad.alias("n_bad"), F.count(F.lit(1)).alias("n_lines")
    )
