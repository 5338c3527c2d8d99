import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_storage import rows_made
from tidewell.llm import queries, topk


def brute(rows, step, k=5):
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for q in {i for i, _ in vectors if i % step == 0}:
        asking = [v for i, v in vectors if i == q]
        scores = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for w in asking for i, v in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "copies", "few", "zero"])
def test_search_matches_brute_force(spark, kind):
    rng = np.random.default_rng(7)
    n = 4 if kind == "few" else 700
    x = rng.normal(size=(n, 12))
    if kind == "copies":
        x[::3] = x[0]
        x[1::5] = -x[0]
    if kind == "zero":
        x[::2] = 0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(df, F.col("id") % 3 == 0, block=100, query_block=40).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)


def test_bounds_never_lose_a_vector():
    rng = np.random.default_rng(8)
    matrix = rng.integers(-60, 60, (900, 20))
    matrix[:200] = matrix[3]
    lists = topk.Lists(np.arange(900), matrix)
    for i in range(0, 900, 30):
        score = matrix @ matrix[i]
        score[i] = -(10**9)
        want = np.lexsort((np.arange(900), -score))[:5]
        for bar in (None, int(score[want[-1]])):
            ids, scores = lists.best(i, matrix[i], 5, bar)
            assert ids.tolist() == want.tolist() and scores.tolist() == score[want].tolist()


@pytest.mark.parametrize("spectrum", ["flat", "falling", "zeros"])
def test_lists_are_read_in_part(spectrum):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32)) * 256
    if spectrum == "falling":
        x /= np.arange(1, 33) ** 1.5
    if spectrum == "zeros":
        x[:, 8:] = 0
    matrix = np.floor(x).astype(np.int64)
    lists = topk.Lists(np.arange(3000), matrix)
    parts = []
    for i in range(0, 3000, 150):
        lists.read = lists.resolved = 0
        ids, scores = lists.best(i, matrix[i], 5)
        score = matrix @ matrix[i]
        score[i] = -(10**12)
        want = np.lexsort((np.arange(3000), -score))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == score[want].tolist()
        parts.append(lists.read / matrix.size)
        assert lists.resolved <= topk.FEW or lists.read >= np.count_nonzero(matrix[i]) * 3000
    assert max(parts) <= 1 and np.mean(parts) < {"flat": 0.95, "falling": 0.6, "zeros": 0.25}[spectrum]


def test_great_numbers_lose_nothing():
    rng = np.random.default_rng(10)
    matrix = rng.integers(-(2**20), 2**20, (500, 24))
    lists = topk.Lists(np.arange(500), matrix)
    for i in range(0, 500, 50):
        score = matrix @ matrix[i]
        score[i] = -(2**62)
        assert lists.best(i, matrix[i], 5)[1].tolist() == np.sort(score)[::-1][:5].tolist()


def test_repeated_ids_as_in_the_sql(spark, tmp_path):
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(c) for c in rng.integers(-3, 4, 6) / 256]) for i in rng.integers(0, 120, 400)]
    rows += [(50, rows[0][1])] * 9 + [(7, rows[1][1])] * 9
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    made = topk.search(df, F.col("id") % 50 == 0, block=90, query_block=4)
    got = sorted(tuple(r) for r in made.collect())
    assert got == brute(rows, 50)
    folder = str(tmp_path / "embeddings.parquet")
    df.write.parquet(folder)
    db = duckdb.connect()
    db.sql(f"create view embeddings as select * from read_parquet('{folder}/*.parquet')")
    assert got == sorted(db.sql(f"select query_id, rank, vec_id, score from ({queries.TOPK_SQL})").fetchall())


def test_blocks_are_sent_to_few_cells(spark):
    x = np.random.default_rng(12).normal(size=(900, 6))
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    made = topk.search(df, F.col("id") % 3 == 0, block=10, query_block=2)
    # 90 blocks of vectors to one cell each, 150 of queries to four; each to all others it meets would be 13,500
    assert 0 < rows_made(made, "GenerateExec") <= 100 + 4 * 152


@pytest.mark.parametrize("held", [1, 7000])
def test_queries_beyond_what_a_task_holds(spark, monkeypatch, held):
    monkeypatch.setattr(topk, "HELD_BYTES", held)
    x = np.random.default_rng(13).normal(size=(300, 8)).astype(np.float32)
    # components of two, four and eight bytes
    x[7], x[8, 0], x[9, 1] = 2**10, 2**20, 2**25
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(df, F.col("id") % 3 == 0, block=50, query_block=5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)


@pytest.mark.parametrize("n, q, width, tasks", [(1, 0, 0, 4), (51_282, 1_026, 64, 12), (600_000, 12_000, 64, 600), (10**7, 10**7, 64, 200), (10**6, 20_000, 4_096, 8)])
def test_grid_fills_its_cells_alike(n, q, width, tasks):
    blocks, query_blocks, groups, columns = topk.grid(n, q, width, tasks, topk.BLOCK, topk.QUERY_BLOCK)
    assert blocks % groups == query_blocks % columns == 0 and n <= blocks * topk.BLOCK and q <= query_blocks * topk.QUERY_BLOCK
    each = query_blocks // columns
    assert each == 1 or each * topk.QUERY_BLOCK * 8 * width <= topk.HELD_BYTES
    assert groups * columns >= min(tasks, -(-n // topk.BLOCK))


def test_awkward_input(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
        (5, [1.0]), (6, []), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-1.0, 0.5]), (8, [3.0, 0.5]), (10, [0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("block", F.lit(2))
    got = topk.search(df, F.col("id") % 2 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2)
    assert topk.search(df.limit(0), F.col("id") % 2 == 0).count() == 0
