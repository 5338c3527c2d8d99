"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Products of the centred rows A with a vector and of A' with the result alternate; each pair adds a
column to two orthonormal bases with U'AV upper bidiagonal. Right vectors have as many entries as
the vectors have dimensions and stay on the driver. A left vector has one entry for each row; it is a
combination A w of the rows' columns, so the driver keeps w and the tasks work its entries out from
their rows where they need them: nothing of the length of the table is ever kept or moved, and a
lost task is simply run again. Every new vector is reorthogonalised against all earlier ones of its
side, twice. The singular values of the small bidiagonal matrix, over the square root of the
number of rows, are the deviations, its right singular vectors give the components.

The iteration ends when the wanted components have converged and what is left of the rows' sum of
squares is too small to hide another one as great (equal eigenvalues give one direction at a time), at
the latest with as many steps as there are dimensions.

Each entry c becomes the whole number x = floor(64 c) + 1000000. Sums of x are exact, and rows are
centred as whole numbers first (x less the whole part of the mean), so that no digits are lost.

Defined results: vectors that are null or hold null or non-finite entries take no part; neither do
those with an entry of 2^40 or more in size, nor those whose number of dimensions isn't the most
frequent one (the greater, among equals). Null ids are kept, repeated rows are
rows of their own; dimensions without spread are no components, so there may be fewer than wanted,
and none (no rows) from an empty table or when all vectors are alike. A ``deviation`` beyond long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import col, settle

SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 40
#: Rows that are multiplied at once.
BLOCK = 4096
#: Shares below which a length counts as nothing, a component as converged, and squares as rounding.
NOTHING, CONVERGED, ROUNDING = 1e-12, 1e-14, 1e-14


def clean(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (doubles) of the vectors that take part, kept in the checkpoint folder."""
    v = col(vector).cast("array<double>")
    given = vectors.select(col(key).alias("id"), v.alias("v")).where("v is not null and size(v) > 0")
    # a null entry makes forall null, which where() drops; comparisons with NaN order it above all numbers
    whole = given.where(F.forall("v", lambda c: F.abs(c) < LARGEST))
    sizes = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    first = sizes.first()
    # single precision is kept as it came, at half the size
    kept = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    return settle(whole.where(F.size("v") == (first.d if first else 0)).select("id", F.col("v").cast(kept).alias("v")))


def _whole(column) -> np.ndarray:
    """The whole numbers x of a batch's vectors, one row each."""
    lists = column if isinstance(column, pa.Array) else column.combine_chunks()
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat).astype(np.int64) + SHIFT).reshape(n, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _whole(part.column("v"))


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums of x by dimension."""

    n: int
    sums: tuple[int, ...]

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], float) / self.n
        return (x - whole).astype(float) - rest


def centre(rows: DataFrame) -> Centre:
    """Exact sums: whole numbers are summed by task and then as decimals."""

    def sums(batches):
        total, n = [], 0
        for _, x in _blocks(batches):
            part = x.sum(0).tolist()  # a block's sums fit; further ones are Python's whole numbers
            total = [a + b for a, b in zip(total, part, strict=True)] if n else part
            n += len(x)
        if n:
            values = [Decimal(v) for v in (n, *total)]
            where = pa.array(np.arange(-1, len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([where, pa.array(values, pa.decimal128(38, 0))], ["dimension", "part"])

    parts = rows.select("v").mapInArrow(sums, "dimension int, part decimal(38,0)")
    found = {r.dimension: int(r.s) for r in parts.groupBy("dimension").agg(F.sum("part").alias("s")).collect()}
    n = found.pop(-1, 0)
    return Centre(n, tuple(found[i] for i in range(len(found))))


def _summed(rows: DataFrame, centred: Centre, work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all blocks of centred rows of ``work``, an array of ``size`` numbers; summed by task, then by Spark."""

    def sums(batches):
        total = np.zeros(size)
        for _, x in _blocks(batches):
            total += work(centred.rows(x)).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "part"])

    parts = rows.select("v").mapInArrow(sums, "at int, part double")
    out = np.zeros(size)
    for r in parts.groupBy("at").agg(F.sum("part").alias("s")).collect():  # ``size`` rows
        out[r["at"]] = r["s"]
    return out


@dataclass(frozen=True)
class Whitening:
    """Components (one a column), their variances, and the trace of the covariance."""

    centre: Centre
    components: np.ndarray  # d x k
    variances: np.ndarray
    trace: float
    steps: int


def bidiagonalise(rows: DataFrame, centred: Centre, wanted: int, seed: int = 1) -> Whitening:
    """The leading components of the centred rows."""
    d, n = len(centred.sums), centred.n
    empty = Whitening(centred, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    if not n:
        return empty
    squares = float(_summed(rows, centred, lambda a: np.array([(a * a).sum()]), 1)[0])
    if squares <= 0:
        return empty
    rng = np.random.default_rng(seed)
    scale = np.sqrt(squares)
    right, left, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # v, w with u = A w, and A'u
    alphas, betas = [], []

    def fresh() -> np.ndarray:
        v = rng.normal(size=d)
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v / np.linalg.norm(v)

    v, beta = fresh(), 0.0
    while True:
        right = np.column_stack([right, v])
        # u = A v - beta u_before, as A w; its products with the earlier left vectors are taken off
        w = v - (beta * left[:, -1] if left.shape[1] else 0)
        k = left.shape[1]
        found = _summed(rows, centred, _left_products(left, w), k + 1)
        w = w - left @ found[:k]
        found = _summed(rows, centred, _both_products(left, w), k + 1 + d)
        again, length, product = found[:k], found[k], found[k + 1 :]
        alpha = np.sqrt(max(length - again @ again, 0.0))
        if alpha <= NOTHING * scale:
            # A v is within what was found: no new left vector, and v is a direction without spread
            alphas.append(0.0)
            betas.append(0.0)
            left, back = np.column_stack([left, np.zeros(d)]), np.column_stack([back, np.zeros(d)])
            rest, beta = np.zeros(d), 0.0
        else:
            w = (w - left @ again) / alpha
            product = (product - back @ again) / alpha
            left, back = np.column_stack([left, w]), np.column_stack([back, product])
            alphas.append(alpha)
            rest = product - alpha * v
            for _ in range(2):
                rest = rest - right @ (right.T @ rest)
            beta = float(np.linalg.norm(rest))
            betas.append(beta)
        steps = len(alphas)
        small = np.diag(alphas) + np.diag(betas[:-1], 1)
        p, sigma, qt = np.linalg.svd(small)
        most = min(wanted, steps)
        open_ends = np.abs(beta * p[-1, :most])
        left_over = squares - float((small**2).sum())
        hidden = 0.0 if steps < wanted else sigma[most - 1] ** 2  # what is left can hold no greater component than that
        done = (open_ends <= CONVERGED * sigma[0]).all() and left_over < max(hidden, ROUNDING * squares)
        if steps == d or done:
            break
        if beta <= NOTHING * scale:  # nothing leads on from here; what is left lies across all found
            v, beta = fresh(), 0.0
            betas[-1] = 0.0
        else:
            v = rest / beta
    keep = [i for i in range(most) if sigma[i] > NOTHING * scale]
    components = right @ qt.T[:, keep]
    components /= np.linalg.norm(components, axis=0)
    return Whitening(centred, components, sigma[keep] ** 2 / n, squares / n, steps)


def _left_products(left: np.ndarray, w: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """U'(A w) for the earlier left vectors, and the squared length of A w."""

    def work(a):
        u = a @ w
        return np.concatenate([(a @ left).T @ u, [u @ u]])

    return work


def _both_products(left: np.ndarray, w: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """The same, and A'(A w)."""

    def work(a):
        u = a @ w
        return np.concatenate([(a @ left).T @ u, [u @ u], a.T @ u])

    return work


def fit(rows: DataFrame, wanted: int) -> Whitening:
    """The whitening of :func:`clean` rows."""
    return bidiagonalise(rows, centre(rows), wanted)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity, from one more pass."""
    k = model.components.shape[1]
    if not k:
        return 0.0
    turn, centred = model.components / np.sqrt(model.variances), model.centre

    def work(a):
        z = a @ turn
        return np.concatenate([(z.T @ z).reshape(-1), z.sum(0)])

    found = _summed(rows, centred, work, k * k + k)
    mean = found[k * k :] / centred.n
    return float(np.abs(found[: k * k].reshape(k, k) / centred.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, centred: Centre) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S)^2; null beyond long."""
    n, whole = centred.n, np.array([s // centred.n for s in centred.sums], np.int64)
    rest = np.array([s % centred.n for s in centred.sums], object)
    away = x - whole  # n x - S is n * away - rest
    most = int(np.abs(away).max(initial=0)) + 1
    if (most * n) ** 2 * x.shape[1] < 1 << 62:
        flat = n * away - rest.astype(np.int64)
        return (flat * flat).sum(1).tolist()
    exact = [int(sum(y * y for y in row)) for row in n * away.astype(object) - rest]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", wanted: int = 32) -> DataFrame:
    """One row for each vector that takes part: ``key``, ``n``, ``deviation`` and the arrays ``whitened`` (one
    entry for each component), ``variance``, ``explained``, and ``identity_error``."""
    rows = clean(vectors, key, vector)
    model = fit(rows, wanted)
    error = identity_error(rows, model)
    kind = rows.schema["id"].dataType.simpleString()
    variances = model.variances.tolist()
    explained = (model.variances / model.trace).tolist() if len(model.variances) else []
    centred = model.centre
    turn = model.components / np.sqrt(model.variances) if len(model.variances) else model.components

    def work(batches):
        for part, x in _blocks(batches):
            if not len(variances):
                return
            z = centred.rows(x) @ turn
            size = len(x)

            def same(values):
                return pa.array([values] * size, pa.list_(pa.float64()))

            lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * z.shape[1]), pa.array(z.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([centred.n] * size, pa.int64()), pa.array(_deviations(x, centred), pa.int64()),
                 lists, same(variances), same(explained), pa.array([error] * size, pa.float64())],
                ["id", "n", "deviation", "whitened", "variance", "explained", "identity_error"],
            )

    out = rows.mapInArrow(
        work,
        f"id {kind}, n long, deviation long, whitened array<double>, variance array<double>, "
        "explained array<double>, identity_error double",
    )
    return out.withColumnRenamed("id", key)


def by_component(whitened: DataFrame, key: str = "vec_id") -> DataFrame:
    """:func:`whiten`'s rows with one row for each component, numbered from 1."""
    return whitened.select(
        col(key), "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "z")
    ).select(
        col(key), (F.col("at") + 1).alias("component"), "n", "deviation", F.col("z.whitened").alias("whitened"),
        F.col("z.explained").alias("explained"), "identity_error",
    )
