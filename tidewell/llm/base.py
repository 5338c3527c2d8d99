"""Helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: What stands between words: the ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one given table; other columns never enter a plan."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet").select(*columns)


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(column: str = "text") -> Column:
    """The whole text; null reads as empty."""
    return F.coalesce(col(column), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII blanks."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(items: Column) -> Column:
    """Sum of an array of longs; 0 for none."""
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own in the shared folder."""
    return f"{shared_dir(spark)}/tidewell-{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """The rows, worked out now and kept in the shared checkpoint folder; small rows only."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, longer by underscores until no column of ``df`` has that name."""
    have = {c.lower() for c in df.columns}
    while wish.lower() in have:
        wish += "_"
    return wish


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, as PYTHONPATH would.

    A cluster that installs the package, or is given it with ``--py-files``, doesn't need it.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
