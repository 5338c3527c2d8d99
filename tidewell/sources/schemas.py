"""Reading folders whose columns changed over the months as one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType, ShortType, StructField,
    StructType, TimestampType,
)

from .tables import lower_columns

#: Whole number types by width, and their digits.
WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds the values of both, or None where there is none without loss of meaning.

    Whole numbers widen to whole numbers, decimals to decimals with room for both, any number to
    double once one of them is floating, dates to timestamps. Text holds only text.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.__getitem__)
    floating = (FloatType, DoubleType)
    numbers = [t in WHOLE or isinstance(t, (*floating, DecimalType)) for t in (a, b)]
    if all(numbers):
        if isinstance(a, floating) or isinstance(b, floating):
            return DoubleType()
        shapes = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (WHOLE[t], 0) for t in (a, b)]
        before, after = (max(s) for s in zip(*shapes, strict=True))
        return DecimalType(before + after, after) if before + after <= 38 else None
    if {type(a), type(b)} == {DateType, TimestampType}:
        return TimestampType()
    return None


def reconcile(schemas: Mapping[str, StructType]) -> StructType:
    """One schema for all: every column that occurs, in order of first occurrence, as wide as needed.

    Names are compared in lower case. Types without a common one, and names that one schema holds
    twice, raise an error that names the column and where its types come from.
    """
    found: dict[str, DataType] = {}
    origin: dict[str, str] = {}
    for place, schema in schemas.items():
        names = [f.name.lower() for f in schema.fields]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"{place} holds {twice} more than once, in different case")
        for name, field in zip(names, schema.fields, strict=True):
            kind = field.dataType
            common = kind if name not in found else wider(found[name], kind)
            if common is None:
                raise ValueError(
                    f"column {name} is {found[name].simpleString()} in {origin[name]} and {kind.simpleString()} in {place}"
                )
            if common != found.get(name):
                found[name], origin[name] = common, place
    return StructType([StructField(n, t) for n, t in found.items()])


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: missing ones null, others cast to its types."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name]}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_reconciled(
    spark: SparkSession, paths: Sequence[str], *, fmt: str = "parquet", columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows of all folders under one schema; only footers are read to find it.

    ``columns`` are selected in each folder's scan. A column that was added later is null in the
    folders before it.
    """
    frames = {p: lower_columns(spark.read.format(fmt).load(p)) for p in paths}
    if not frames:
        raise ValueError("no folder to read")
    schema = reconcile({p: df.schema for p, df in frames.items()})
    if columns is not None:
        kept = {f.name: f for f in schema.fields}
        missing = [c for c in columns if c not in kept]
        if missing:
            raise ValueError(f"no folder holds {missing}")
        schema = StructType([kept[c] for c in columns])
    return reduce(DataFrame.unionAll, [align(df, schema) for df in frames.values()])
