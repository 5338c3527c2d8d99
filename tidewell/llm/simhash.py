"""Near duplicates by SimHash fingerprints, matched through the Golay code.

A fingerprint's bit is 1 if it is set in over half the hashes of the text's 3-word shingles.
Distinct fingerprints that differ in at most 3 of 64 bits are linked. To find them, a fingerprint
is cut into segments of 21, 21 and 22 bits. Three errors leave at least two segments with at most
one error each, and words with at most one error share a codeword near both. So a fingerprint is
filed under the nearest codewords of each two segments (3 keys) and looks itself up under all
near codewords of each two segments (up to 3 x 36 keys); each pair found is verified by counting
bits. Linked fingerprints are gathered into components.

Copies meet before all that: only distinct fingerprints are filed, so a fingerprint that a third
of all texts share is one row. A pair is found from its lesser fingerprint only, at most three
times, and only links leave the join.

Defined results: null texts and texts without a word have fingerprint zero, which links like any
other; a text of fewer than three words is one shingle; an empty table gives no rows; repeated
rows and null ids are kept row by row, and a component of null ids alone has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import col, free_name, settle
from .components import components
from .golay import near_codewords
from .units import chunks, strings

SEED = 42
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit, bits
#: Shingles whose bits are counted together.
SLICE = 1 << 16


def fingerprint(text: str) -> int:
    """Signed 64-bit fingerprint of one whole text."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII blanks part words
    if not words:
        return 0
    if len(words) < 3:
        words = [b" ".join(words), b"", b""]
        shingles = iter(words[:1])
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    n, hash_of = len(words) - 2, xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, SLICE):
        part = hashes[start : start + SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, *keep: str, text: str = "text", name: str = "fp") -> DataFrame:
    """``keep`` and the fingerprint of each row's whole text."""

    names = [f"__k{i}" for i in range(len(keep))]
    # a text that is kept goes to the workers once
    body = names[keep.index(text)] if text in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, body):
            at = batch.schema.get_field_index(body)
            made = [fingerprint(t) for t in strings(batch.column(at)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(made, pa.int64())], [*names, name])

    kinds = [T.StructField(n, docs.schema[c].dataType) for n, c in zip(names, keep, strict=True)]
    rows = docs.select(
        *[col(c).alias(n) for n, c in zip(names, keep, strict=True)], *([] if text in keep else [col(text).alias(body)])
    )
    made = rows.mapInArrow(run, T.StructType([*kinds, T.StructField(name, T.LongType())]))
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], name)


def _keys(fps: np.ndarray, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key for each key of the fingerprints: the nearest codewords' or all near ones'."""
    words = fps.view(np.uint64)
    found = [near_codewords((words >> np.uint64(s)) & np.uint64((1 << n) - 1)) for s, n in SEGMENTS]
    rows, keys = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        left, right = (found[a], found[b]) if near else (found[a][:, :1], found[b][:, :1])
        key = (pair << 24) + (left[:, :, None] << 12) + right[:, None, :]
        valid = (left[:, :, None] >= 0) & (right[:, None, :] >= 0)
        row = np.broadcast_to(np.arange(len(fps))[:, None, None], key.shape)
        rows.append(row[valid])
        keys.append(key[valid])
    return np.concatenate(rows), np.concatenate(keys)


def _with_keys(fps: DataFrame, near: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                fp = whole.column(0).slice(start, 2048).to_numpy(zero_copy_only=False)
                rows, keys = _keys(np.ascontiguousarray(fp, np.int64), near)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(fp[rows])], ["key", "fp"])

    return fps.mapInArrow(run, "key int, fp long")


def links(fps: DataFrame, *, bits: int = 3) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (column ``fp``) that differ in at most ``bits`` bits.

    The keys find all pairs up to 3 bits apart.
    """
    if not 1 <= bits <= 3:
        raise ValueError("the segments find pairs of 1 to 3 differing bits")
    filed, sought = _with_keys(fps, False).alias("f"), _with_keys(fps, True).alias("s")
    near = F.bit_count(F.col("f.fp").bitwiseXOR(F.col("s.fp"))) <= bits
    met = (F.col("f.key") == F.col("s.key")) & (F.col("f.fp") < F.col("s.fp")) & near
    return filed.join(sought, met).select(F.col("f.fp").alias("a"), F.col("s.fp").alias("b")).distinct()


def grouped(rows: DataFrame, *, key: str = "doc_id", fp: str = "fp", bits: int = 3) -> DataFrame:
    """Distinct ``fp`` with ``__root``, the component's least fingerprint, and ``component_id``."""
    distinct = settle(rows.groupBy(col(fp).alias("fp")).agg(F.min(col(key)).alias("first")))
    found = components(links(distinct.select("fp"), bits=bits))
    known = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("__root"), "first"
    )
    least = known.groupBy("__root").agg(F.min("first").alias("component_id"))
    return known.select(F.col("fp").alias("__fp"), "__root").join(least, "__root")


def as_hex(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", bits: int = 3) -> DataFrame:
    """``key``, ``fingerprint`` and ``component_id``, one row for each row of ``docs``."""
    rows = settle(fingerprints(docs, key, text=text))
    groups = grouped(rows, key=key, bits=bits)
    return rows.join(groups, F.col("fp") == F.col("__fp")).select(
        col(key), as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, *, key: str = "doc_id", text: str = "text", bits: int = 3) -> DataFrame:
    """One document of each component: its least ``key``, with all columns of ``docs``.

    The texts are read twice, once for their fingerprints alone, and are shuffled once to meet the
    ids that stay. Of rows alike in id and fingerprint one stays.
    """
    rows = settle(fingerprints(docs, key, text=text))
    groups = grouped(rows, key=key, bits=bits)
    ranked = rows.join(groups, F.col("fp") == F.col("__fp")).groupBy("__root").agg(
        F.min(F.struct(col(key).isNull().alias("no"), col(key).alias("id"), F.col("fp").alias("fp"))).alias("first")
    )
    keep = ranked.select(F.col("first.id").alias("__id"), F.col("first.fp").alias("__keep_fp"))
    fp = free_name(docs, "fingerprint")
    again = fingerprints(docs, *docs.columns, text=text, name=fp)
    kept = again.join(keep, col(key).eqNullSafe(F.col("__id")) & (col(fp) == F.col("__keep_fp")), "left_semi")
    place = free_name(docs, "place")
    order = [col(c).asc_nulls_first() for c in docs.columns]
    one = Window.partitionBy(col(key), col(fp)).orderBy(*order)
    return kept.withColumn(place, F.row_number().over(one)).where(col(place) == 1).select(*[col(c) for c in docs.columns])
