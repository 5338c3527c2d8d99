"""Registered queries: a Spark function, its result columns, and the SQL it is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .entities import ENTITIES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Result types: l integer, d double, s text, D date shown as ISO text.
SPARK_CAST = {"l": "cast({0} as bigint)", "d": "cast({0} as double)", "s": "cast({0} as string)",
              "D": "cast(cast({0} as date) as string)"}
DUCK_CAST = {"l": "CAST({0} AS BIGINT)", "d": "CAST({0} AS DOUBLE)", "s": "CAST({0} AS VARCHAR)",
             "D": "CAST(CAST({0} AS DATE) AS VARCHAR)"}


def marks(text: str) -> list[str]:
    return [name for _, name, _, _ in Formatter().parse(text) if name]


class Tables:
    """Driver tables and entities of one scale, by attribute: ``t.orders``, ``t.e_policy``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self._seen = spark, str(sf_dir).rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in TABLES:
                df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
            elif name in ENTITIES:
                text = ENTITIES[name]
                df = self.spark.sql(text, **{m: getattr(self, m) for m in marks(text)})
            else:
                raise AttributeError(name)
            self._seen[name] = df
        return self._seen[name]


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Tables(spark, sf_dir))
        return df.select(
            *[F.expr(SPARK_CAST[kind].format(f"`{name}`")).alias(name) for name, kind in self.columns]
        )

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        wanted: list[str] = []

        def need(text: str) -> None:
            for name in re.findall(r"\be_[a-z0-9_]+\b", text):
                if name in ENTITIES and name not in wanted:
                    need(ENTITIES[name])
                    if name not in wanted:
                        wanted.append(name)

        need(body)
        ctes = ",\n".join(
            f"{name} AS ({ENTITIES[name].strip().format(**{m: m for m in marks(ENTITIES[name])})})"
            for name in wanted
        )
        cast = ", ".join(DUCK_CAST[kind].format(f'"{name}"') + f' AS "{name}"' for name, kind in self.columns)
        head = f"WITH {ctes}\n" if ctes else ""
        return f"{head}SELECT {cast} FROM (\n{body}\n) AS result"


REGISTRY: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register the decorated function of :class:`Tables` under ``name``.

    ``columns`` lists the result as ``name:type`` words.
    """

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        parsed = tuple(tuple(word.rsplit(":", 1)) for word in columns.split())
        REGISTRY[name] = Query(name, parsed, build, sql)
        return build

    return register
