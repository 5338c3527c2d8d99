"""Writing results: whole folders, single partitions, CSV exports."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require


def absolute(path: str, default: str = "file:///", home: str = "/") -> tuple[str, str, str]:
    """Scheme, authority and path (with one trailing slash) of a location.

    ``default`` is the file system that paths without a scheme, or without an authority in its
    scheme, belong to; relative paths start at ``home``.
    """
    base = urlsplit(default)
    head, colon, rest = path.partition(":")
    if colon and "/" not in head:
        scheme, tail = head.lower(), rest
    else:
        scheme, tail = base.scheme, path
    authority = ""
    if tail.startswith("//"):
        authority, _, tail = tail[2:].partition("/")
        tail = "/" + tail
    if not authority and scheme == base.scheme:
        authority = base.netloc
    if not tail.startswith("/"):
        tail = home.rstrip("/") + "/" + tail
    return scheme, authority, posixpath.normpath("/" + tail.strip("/")).rstrip("/") + "/"


def overlap(a: tuple[str, str, str], b: tuple[str, str, str]) -> bool:
    """Whether one location lies in the other; both as :func:`absolute` gives them."""
    return a[:2] == b[:2] and (a[2].startswith(b[2]) or b[2].startswith(a[2]))


def _roots(df: DataFrame) -> list[str]:
    """Roots of the plan's file scans, of either kind of file source; files are not listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    roots: list[str] = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            found = leaf.relation().location().rootPaths()
        elif kind == "DataSourceV2Relation" and leaf.table().getClass().getSuperclass().getSimpleName() == "FileTable":
            found = leaf.table().fileIndex().rootPaths()
        else:
            continue
        roots += found.mkString("\n").splitlines()
    return roots


def _reads_from(df: DataFrame, path: str) -> bool:
    """True when a file scan of the plan is rooted at, above or below ``path``."""
    spark = df.sparkSession
    files = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jsc.hadoopConfiguration())
    default, home = files.getUri().toString(), files.getWorkingDirectory().toUri().getPath()
    target = absolute(path, default, home)
    return any(overlap(absolute(root, default, home), target) for root in _roots(df))


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Replace the folder's contents.

    A plan that reads the same folder is refused: the old files would be gone before they
    are read.
    """
    if _reads_from(df, path):
        raise ValueError(f"{path} is read by this result; write elsewhere or by partition")
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt).save(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str] | str, *, fmt: str = "parquet") -> None:
    """Replace only the partitions that occur in the result; the others stay.

    Rows are rebalanced by the partition columns first, so each partition gets few large
    files, and a partition that holds most of the rows is still written by many tasks.
    """
    keys = [by] if isinstance(by, str) else list(by)
    require(df, "result", *keys)
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .format(fmt)
        .save(path)
    )


def write_csv(df: DataFrame, path: str, *, single: bool = False) -> None:
    """CSV with header lines. ``single`` makes one file and is meant for small reports.

    Array columns are joined with ``;`` because CSV has no list form.
    """
    flat = df.select(
        *[
            F.concat_ws(";", F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "array"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    # repartition, not coalesce: the work before it keeps its own parallelism.
    out = flat.repartition(1) if single else flat
    out.write.mode("overwrite").option("header", True).csv(path)


def for_all_agents(agents: DataFrame, report: DataFrame, key: str = "agt_cd") -> DataFrame:
    """One row at least for every listed agent, report columns null where there is none."""
    return agents.select(key).join(report, key, "left")


def export_reports(
    reports: Mapping[str, DataFrame],
    agents: DataFrame,
    path: str,
    *,
    key: str = "agt_cd",
    stamp: Mapping[str, str] | None = None,
    single: bool = False,
) -> dict[str, str]:
    """Write every report as CSV under ``path``, each joined to the agent list.

    ``stamp`` puts constant text columns, such as the report month, into every row.
    """
    require(agents, "agents", key)
    written = {}
    stamps = {c: F.lit(text) for c, text in (stamp or {}).items()}
    for name, report in reports.items():
        target = f"{path.rstrip('/')}/{name}"
        write_csv(for_all_agents(agents, report.drop(*stamps), key).withColumns(stamps), target, single=single)
        written[name] = target
    return written
