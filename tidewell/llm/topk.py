"""Exact top-k inner products by reading sorted lists without random access.

Vectors are packed into blocks of bounded size, by a hash of id and vector; queries likewise. Both
are dealt to the cells of a grid, a row of cells for each group of blocks of vectors and a column for
each group of blocks of queries, so that a block is sent once to each cell of its row or column only,
not to each block it meets. A cell is one task: it holds its queries, and the blocks of vectors
pass by one after the other. There each component is a list of the block's vectors, sorted by what they can add to the score (read from the other end where the
query's component is negative). All lists are read downwards together, a batch of entries at a
time. Each entry read raises its vector's lower bound, which takes the least value of each list
not read so far for the vector. Outsiders, the vectors not met in any list, cannot score more than
the entries last read add up to; once that is under the k-th lower bound, or all vectors were met,
they are out. From then on those met are kept only while their upper bound, the lower bound with
the entries last read in place of the least, reaches the k-th lower bound. Reading stops when few
are left; their scores are resolved. A cell keeps each query's best k so far, whose least score
the next blocks must reach, and returns them at the end. The best of all cells are exact: bounds are whole numbers, and ties are kept until they are resolved by id.

Defined results: vectors that are null, hold a null or non-finite component, or have no id take
no part; shorter vectors count as zero beyond their end; every row is a candidate of the queries
of other ids, also where ids repeat, and rows of one id that ask share one answer, the best k of
all their scores; with fewer candidates than k all are returned; an empty table gives no rows.
Scores are 64-bit integers: components up to 2**20 are safe.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import col, settle

#: Vectors and queries in a block.
BLOCK, QUERY_BLOCK = 4096, 512
#: Bytes of queries that a task holds, as 64-bit components; each counts for so many components more.
HELD_BYTES, HELD_MORE = 32 << 20, 64
#: Batches in which lists are read to their end. Candidates few enough to be resolved.
BATCHES = 8
FEW = 64


def integers(vectors: DataFrame, *, key: str, vector: str, scale: int, k: int) -> DataFrame:
    """``id`` and ``v`` (floor of ``scale`` times each component) of the vectors that take part.

    Of rows alike ``k`` are kept: more can't show among the best ``k``, as candidates or as queries.
    """
    x = col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = vectors.where(col(key).isNotNull() & col(vector).isNotNull() & ~bad)
    made = good.select(col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    alike = made.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    return alike.select("id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("nth")).drop("nth")


def grid(n: int, q: int, width: int, tasks: int, block: int, query_block: int) -> tuple[int, int, int, int]:
    """Blocks of ``n`` vectors and of ``q`` queries, and the groups these are dealt to: as many blocks in each.

    There are about ``tasks`` cells, more if a column's queries were more than a task holds. The fewest rows are
    sent when as many vectors as queries are.
    """
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-q // query_block))
    held = max(1, HELD_BYTES // (8 * query_block * (width + HELD_MORE)))
    columns = max(-(-query_blocks // held), min(query_blocks, round(math.sqrt(tasks * q / max(1, n)))), 1)
    groups = min(blocks, -(-tasks // columns))
    return groups * -(-blocks // groups), columns * -(-query_blocks // columns), groups, columns


def _packed(rows: DataFrame, blocks: int, width: int) -> DataFrame:
    """Blocks of vectors: their number, the ids, and the matrix row by row in integers as short as it allows."""

    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        matrix = np.zeros((len(ids), width), np.int64)
        for i, v in enumerate(group.column("v").to_pylist()):
            matrix[i, : len(v)] = v
        order = np.argsort(ids)
        least, most = matrix.min(initial=0), matrix.max(initial=0)
        short = next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= least and most <= np.iinfo(t).max)
        return pa.table(
            {
                "number": group.column("number").slice(0, 1),
                "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                "matrix": pa.array([matrix[order].astype(short).tobytes()], pa.binary()),
            }
        )

    dealt = rows.withColumn("number", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("number").applyInArrow(pack, "number int, ids binary, matrix binary")


def _unpacked(ids: bytes, matrix: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, "<i8")
    bytes_each = len(matrix) // (len(found) * width) if width else 8
    return found, np.frombuffer(matrix, f"<i{bytes_each}").reshape(len(found), width).astype(np.int64)


class Lists:
    """The sorted lists of one block: vectors and values by place, and each vector's place by list.

    ``read`` counts the entries read so far, ``resolved`` the vectors whose scores were resolved.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        n, width = matrix.shape
        self.ids, self.matrix = ids, matrix
        order = np.argsort(-matrix, axis=0, kind="stable")  # by component, greatest first
        self.values = np.ascontiguousarray(np.take_along_axis(matrix, order, axis=0).T.astype(np.float64))
        # how far each entry is from the last one of its list, read from either end
        self.above, self.below = self.values - self.values[:, -1:], self.values - self.values[:, :1]
        self.order = np.ascontiguousarray(order.T)
        self.place = np.empty(matrix.shape, np.int16 if n < 2**15 else np.int32)
        np.put_along_axis(self.place, order, np.arange(n, dtype=self.place.dtype)[:, None], axis=0)
        self.read = self.resolved = 0

    def best(self, own: int, query: np.ndarray, k: int, bar: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best but for the query's own id; greatest first, ties by id.

        ``bar`` is a score that ``k`` vectors elsewhere reach; what stays under it may be left out.
        """
        n = len(self.ids)
        alive = np.flatnonzero(self.ids != own)
        down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)  # a negative weight reads its list from the other end
        weight = query.astype(np.float64)
        # sums beyond what a double holds exactly are given their rounding error
        most = float(np.abs(query).max(initial=0)) * float(np.abs(self.matrix).max(initial=0)) * max(1, len(query))
        slack = 0.0 if 4 * most < 2**53 else most * len(query) * 2.0**-50
        kind = np.float32 if 4 * most < 2**24 else np.float64
        least = np.where(query > 0, self.values[:, -1], self.values[:, 0]) if n else weight
        lower = np.full(n, weight @ least)
        met, all_met, outsiders = np.zeros(n, bool), False, True
        at, batch, test, wait = 0, 0, 1, 1
        step = max(1, -(-n // BATCHES))
        while len(alive) > max(FEW, k) and at < n and len(down) + len(up):
            stop = min(n, at + step)
            for lists, far, start, end in ((down, self.above, at, stop), (up, self.below, n - stop, n - at)):
                if len(lists):
                    vectors = self.order[lists, start:end].ravel()
                    lower += np.bincount(vectors, (far[lists, start:end] * weight[lists, None]).ravel(), n)
                    if not all_met:
                        met[vectors] = True
                    self.read += len(vectors)
            at, batch, all_met = stop, batch + 1, all_met or bool(met.all())
            if batch < test and at < n:
                continue
            last = np.where(query > 0, self.values[:, at - 1], self.values[:, n - at])
            known = lower[alive]
            reached = np.partition(known, len(known) - k)[len(known) - k] - slack
            reached = reached if bar is None else max(reached, bar)
            if outsiders and not all_met and weight @ last + slack >= reached:
                continue  # a vector not met yet might be among the best
            if outsiders:
                outsiders, alive = False, alive[met[alive]]
                known = lower[alive]
            # unread are the places from ``at`` on, or, read from the other end, those before ``n - at``
            place = self.place[alive] if len(alive) < n - 1 else self.place
            unread = (place >= np.where(query < 0, 0, at).astype(place.dtype)) & (place < np.where(query < 0, n - at, n).astype(place.dtype))
            ahead = unread.astype(kind) @ (weight * (last - least)).astype(kind)
            stay = known + (ahead if place is not self.place else ahead[alive]) + slack >= reached
            # a test that drops nothing makes the next ones rarer
            wait = 1 if not stay.all() else 2 * wait
            test, alive = batch + wait, alive[stay]
        score = self.matrix[alive] @ query
        self.resolved += len(alive)
        top = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][top], score[top]


def search(
    vectors: DataFrame,
    queries: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    k: int = 5,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` best for each id that ``queries`` (of ``id``) names."""
    rows = settle(integers(vectors, key=key, vector=vector, scale=scale, k=k))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(queries).alias("q"), F.max(F.size("v")).alias("w")).first()
    width, tasks = size["w"] or 0, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, query_blocks, groups, columns = grid(size["n"], size["q"], width, tasks, block, query_block)

    def sent(packed: DataFrame, part: int, first: Column, last: int, step: int) -> DataFrame:
        return packed.select(F.explode(F.sequence(first, first + F.lit(last), F.lit(step))).alias("cell"), F.lit(part).alias("part"), "ids", "matrix")

    # a cell's number is its row's times the columns, and its column's
    column, row = F.col("number") % columns, F.col("number") % groups * columns
    asked = sent(_packed(rows.where(queries), query_blocks, width), 0, column, (groups - 1) * columns, columns)
    index = sent(_packed(rows, blocks, width), 1, row, columns - 1, 1)
    cells = asked.unionByName(index).repartitionById(groups * columns, "cell").sortWithinPartitions("part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, best, reached = [], [], {}
        for batch in batches:
            for row in range(batch.num_rows):
                part, ids, matrix = (c[row].as_py() for c in batch.columns)
                if part == 0:
                    asking, q_matrix = _unpacked(ids, matrix, width)
                    held += zip(asking.tolist(), q_matrix, strict=True)
                    continue
                lists = Lists(*_unpacked(ids, matrix, width)) if held else None
                best = best or [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(held)
                for n, (i, q) in enumerate(held):
                    found, score = (np.concatenate(x) for x in zip(best[n], lists.best(i, q, k, reached.get(i)), strict=True))
                    top = np.lexsort((found, -score))[:k]
                    best[n] = found[top], score[top]
                    if len(top) == k:  # the task's blocks so far hold k vectors as good
                        reached[i] = max(reached.get(i, score[top[-1]]), score[top[-1]])
        for start in range(0, len(best), query_block):
            part = best[start : start + query_block]
            asking = np.array([i for i, _ in held[start : start + query_block]], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(asking, [len(i) for i, _ in part])),
                    pa.array(np.concatenate([i for i, _ in part])),
                    pa.array(np.concatenate([s for _, s in part])),
                ],
                ["query_id", "vec_id", "score"],
            )

    found = cells.select("part", "ids", "matrix").mapInArrow(run, "query_id long, vec_id long, score long")
    in_order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
