"""Evaluating an intermediate result once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import shared_dir


def settle(df: DataFrame) -> DataFrame:
    """The same rows, computed now and kept in the cluster's shared checkpoint folder.

    For results that are small beside their inputs and are read several times by what
    follows. The folder is :func:`~tidewell.session.shared_dir`, which raises on a cluster
    that names none; executors can be lost afterwards without recomputing. Runs a job.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()
