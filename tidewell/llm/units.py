"""Coding texts by their repeated parts inside a task.

A batch of texts is cut into units (words with what belongs to them) by Arrow's string kernels,
equal units of the batch are found by its hash kernel, and only units a worker has not met yet
reach an encoder. A worker's memory of units is bounded and only saves time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on together, and units that a worker remembers.
CHUNK_BYTES = 8 << 20
REMEMBERED = 700_000


def strings(column) -> pa.Array:
    """One plain string array with null read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def chunks(batches: Iterable[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices whose texts hold at most ``most`` bytes, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start, before = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


class Cut:
    """Texts cut into units: ``codes`` (one per unit) into ``units``, ``offsets`` (one per text, and the end)."""

    def __init__(self, lists: pa.ListArray):
        coded = lists.flatten().dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.units: pa.Array = coded.dictionary
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        self.offsets = offsets - offsets[0]


class Memory:
    """What an encoder returned for units, end to end in one array, up to a bound."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], bound: int = REMEMBERED):
        self.encode_many, self.bound = encode_many, bound
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.kept_flat = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def places(self, units: list[str]) -> np.ndarray:
        """Where ``starts`` and ``sizes`` have each unit; valid until the next call.

        A full memory stays as it is, since frequent units are met early; what it lacks is coded
        for this call alone. It is given up once it lacks most of what is asked.
        """
        n = len(self.known)
        self.starts, self.sizes = self.starts[:n], self.sizes[:n]
        at = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return at
        full = n + len(missing) > self.bound or self.kept_flat > 16 * self.bound
        if full and n and 2 * len(missing) > len(units):
            self.forget()
            return self.places(units)
        new = [units[i] for i in missing]
        flat, sizes = self.encode_many(new)
        used = self.kept_flat + len(flat)
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.kept_flat], np.zeros(2 * used - self.kept_flat, np.int32)])
        self.flat[self.kept_flat : used] = flat
        at[missing] = np.arange(n, n + len(new))
        self.starts = np.concatenate([self.starts, self.kept_flat + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        if not full:
            self.known.update(zip(new, at[missing].tolist(), strict=True))
            self.kept_flat = used
        return at

    def spread(self, units: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the coded units stand for, end to end, and the length of each."""
        at = self.places(units)
        lengths = self.sizes[at][codes]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[at][codes] - ends + lengths, lengths)
        return self.flat[shift + np.arange(len(shift))], lengths


def per_text(lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of unit lengths by text."""
    sums = np.concatenate([[0], np.cumsum(lengths)])
    return sums[offsets[1:]] - sums[offsets[:-1]]
