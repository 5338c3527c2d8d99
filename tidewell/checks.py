"""Input checks shared by all layers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Return ``df`` if it holds every named column, else raise with the missing ones."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"input '{name}' lacks columns {missing}; it has {df.columns}")
    return df


def pick(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Only the named columns, after :func:`require`; keeps other columns out of the joins."""
    return require(df, name, *columns).select(*columns)
