"""A partitioned history that survives failed runs and replaces rows by key.

Data are never overwritten. A run writes the partitions it touches to a folder of its own, checks
them, and only then publishes a manifest that says which folder holds each partition. Readers follow the
newest manifest, so a run that stops at any step leaves the history as it was. One run at a time may
write; a second one finds its manifest's number taken and stops.

    <path>/data/<run>/<by>=<value>/   rows
    <path>/manifest/<number>.json     schema, and the run that holds each partition
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..checks import require


@dataclass(frozen=True)
class Staged:
    """Partitions that are written but not yet part of the history."""

    number: int
    run: str
    schema: str
    partitions: list = field(default_factory=list)


class History:
    """The history under ``path``, partitioned by the column ``by``, with at most one row for each key in a partition."""

    def __init__(self, spark: SparkSession, path: str, by: str, keys: Sequence[str]):
        self.spark, self.path, self.by, self.keys = spark, path.rstrip("/"), by, list(keys)

    # -- manifests -------------------------------------------------------------------------------

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _numbers(self) -> list[int]:
        files, folder = self._fs(f"{self.path}/manifest")
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def _manifest(self, number: int) -> dict:
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{number:010d}.json").first()[0]
        return json.loads(text)

    def newest(self) -> tuple[int, dict]:
        """Number and content of the newest manifest; 0 and nothing at the start."""
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {"schema": None, "partitions": {}})

    # -- reading ---------------------------------------------------------------------------------

    def _rows(self, manifest: dict, only: list[str] | None = None) -> DataFrame | None:
        held: dict[str, list[str]] = {}
        for value, run in manifest["partitions"].items():
            if only is None or value in only:
                held.setdefault(run, []).append(value)
        out = None
        for run, values in held.items():
            rows = self.spark.read.schema(StructType.fromJson(json.loads(manifest["schema"]))).parquet(f"{self.path}/data/{run}")
            rows = rows.where(F.col(self.by).cast("string").isin(values))
            out = rows if out is None else out.unionByName(rows)
        return out

    def read(self) -> DataFrame:
        """The published rows."""
        _, manifest = self.newest()
        rows = self._rows(manifest)
        if rows is None:
            raise FileNotFoundError(f"{self.path} holds no published history")
        return rows

    # -- writing ---------------------------------------------------------------------------------

    def stage(self, new: DataFrame) -> Staged:
        """Write the partitions that ``new`` touches: its rows, and the others that it doesn't replace.

        Within a partition a new row replaces the one of the same key. Null partition values,
        null keys and keys that occur twice in a partition are refused, and the written rows
        are counted, before anything can be published.
        """
        require(new, "new rows", self.by, *self.keys)
        number, manifest = self.newest()
        run = uuid.uuid4().hex
        target = f"{self.path}/data/{run}"
        place = [self.by, *self.keys]
        doubtful = new.groupBy(*place).count().where(
            (F.col("count") > 1) | F.greatest(*[F.col(c).isNull() for c in place], F.lit(False))
        )
        if not doubtful.isEmpty():
            raise ValueError(f"rows without key, or alike in {place}: {doubtful.first()}")
        # as many values as the result has partitions, which is how it is written
        counts = {r[0]: r[1] for r in new.groupBy(F.col(self.by).cast("string")).count().collect()}
        touched = sorted(counts)
        before = self._rows(manifest, touched)
        staged, expected = new, sum(counts.values())
        if before is not None:
            kept = before.join(new.select(*place), place, "left_anti")
            if set(kept.columns) != set(new.columns):
                raise ValueError(f"columns {new.columns} against the history's {kept.columns}")
            staged = kept.unionByName(new).select(*new.columns)
            expected += kept.count()
        staged.hint("rebalance", F.col(self.by)).write.partitionBy(self.by).parquet(target)
        schema = StructType([f for f in new.schema.fields if f.name != self.by] + [new.schema[self.by]])
        written = self.spark.read.schema(schema).parquet(target).count() if touched else 0
        if written != expected:
            raise RuntimeError(f"{written} rows were written to {target}, {expected} expected")
        return Staged(number + 1, run, schema.json(), touched)

    def publish(self, staged: Staged) -> None:
        """Make staged partitions part of the history, by one rename."""
        number, manifest = self.newest()
        if number + 1 != staged.number:
            raise RuntimeError(f"manifest {staged.number} is taken; stage again from the history as it is now")
        partitions = manifest["partitions"] | dict.fromkeys(staged.partitions, staged.run)
        text = json.dumps({"schema": staged.schema, "partitions": partitions})
        files, part = self._fs(f"{self.path}/manifest/_{staged.run}")
        final = self._fs(f"{self.path}/manifest/{staged.number:010d}.json")[1]
        out = files.create(part, False)
        out.write(text.encode())
        out.close()
        if files.exists(final) or not files.rename(part, final):
            raise RuntimeError(f"manifest {staged.number} is taken")

    def replace(self, new: DataFrame) -> None:
        """Stage and publish."""
        self.publish(self.stage(new))
