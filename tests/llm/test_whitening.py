import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL
from tidewell.llm import queries, whitening


def frame(spark, x, kind="float"):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def plain(x, wanted=32):
    """(n, deviations, components with their variances by falling variance, trace) from the whole covariance."""
    whole = np.floor(64 * np.asarray(x, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(whole), whole.sum(0)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in whole]
    away = whole - sums / n
    variances, vectors = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-variances)[:wanted]
    return exact, away @ vectors[:, order] / np.sqrt(variances[order]), variances[order] / variances.sum()


def compare(rows, x, wanted=32, near=1e-8):
    exact, white, share = plain(x, wanted)
    by = {}
    for r in rows:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, len(by) + 1))
    for k, mine in by.items():
        got = np.array([mine[i].whitened for i in range(len(exact))])
        want = white[:, k - 1]
        assert np.abs(got * np.sign(got @ want) - want).max() < near
        assert abs(mine[0].explained / share[k - 1] - 1) < 1e-10
        assert [mine[i].deviation for i in range(len(exact))] == exact
        assert all(r.n == len(exact) and r.identity_error < 1e-9 for r in mine.values())
    return len(by)


def test_query_matches_covariance(spark):
    rows = queries.QUERIES["op13_embedding_whitening"](spark, SMALL).collect()
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    ids = {r.vec_id: i for i, r in enumerate(given)}
    renamed = [type("Row", (), {**r.asDict(), "vec_id": ids[r.vec_id]}) for r in rows]
    assert compare(renamed, [r.embedding for r in given]) == 32


@pytest.mark.parametrize("kind", ["spread", "steep", "copies", "narrow"])
def test_components_match_covariance(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 10)) * 5
    if kind == "steep":
        x = x * 10.0 ** -np.arange(0, 3, 0.3) * 40
    if kind == "copies":
        x[:150] = x[0]
    if kind == "narrow":
        x[:, 4] = 7
        x[:, 6] = 2 * x[:, 5].astype(np.float32)
        x = np.floor(x)
    x = x.astype(np.float32)
    rows = whitening.by_component(whitening.whiten(frame(spark, x).repartition(5), wanted=6)).collect()
    assert compare(rows, x, 6) == 6


def test_equal_variances_are_all_found(spark):
    """Signed unit vectors: every direction has the same variance, so each Krylov space has one step."""
    x = np.concatenate([np.eye(6), -np.eye(6)])
    rows = whitening.whiten(frame(spark, x), wanted=6).collect()
    z = np.array([r.whitened for r in rows])
    assert z.shape == (12, 6) and np.allclose(z.T @ z / 12 - np.outer(z.mean(0), z.mean(0)), np.eye(6), atol=1e-9)
    assert np.allclose(rows[0].variance, rows[0].variance[0])


def test_stops_before_all_dimensions_only_when_nothing_is_hidden(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 40)) * 20
    x[:, 30:] = 0
    rows = whitening.clean(frame(spark, x, "double"), "vec_id", "embedding")
    full = whitening.fit(rows, 2)
    assert full.steps < 40
    _, white, share = plain(x, 2)
    assert np.allclose(full.variances / full.trace, share, rtol=1e-10)
    flat = whitening.clean(frame(spark, [[float(i), 2.0 * i] + [0.0] * 60 for i in range(9)]), "vec_id", "embedding")
    assert whitening.fit(flat, 8).components.shape == (62, 1) and whitening.fit(flat, 8).steps < 10


def test_awkward_input(spark):
    x = [None, [None, 1.0], [math.nan, 1.0], [math.inf, 1.0], [], [1.0], [1.0, 2.0], [1.0, 2.0], [3.0, -2.0], [-1e30, 0.0], [5.5, 0.1]]
    df = frame(spark, x)
    for name in ("id", "v", "n", "at", "part"):
        df = df.withColumn(name, F.lit("no"))
    made = whitening.whiten(df)
    rows = {r.vec_id: r for r in made.collect()}
    assert set(rows) == {6, 7, 8, 10} and all(len(r.whitened) == 2 for r in rows.values())
    assert rows[6].whitened == rows[7].whitened
    alike = whitening.by_component(whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)))
    none = whitening.by_component(whitening.whiten(frame(spark, x).limit(0)))
    assert alike.count() == none.count() == 0 and none.columns == queries_columns()
    null_id = frame(spark, [[1.0, 2.0], [2.0, 1.0], [4.0, 4.0]]).withColumn("vec_id", F.lit(None).cast("long"))
    assert whitening.whiten(null_id).count() == 3


def queries_columns():
    return ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_long_is_null():
    big = np.array([[1 << 45, 0], [0, 0], [0, 0]], np.int64)
    centred = whitening.Centre(3, (1 << 45, 0))
    assert whitening._deviations(big, centred) == [None, None, None]
    small = whitening.Centre(3, (30, 0))
    assert whitening._deviations(np.array([[30, 0], [0, 0], [0, 0]]), small) == [3600, 900, 900]
