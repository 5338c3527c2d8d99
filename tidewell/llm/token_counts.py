"""Token counts with a two-tier lookup on the map side.

Texts are cut before every blank that something other than white space follows. Such a blank always
begins a pre-token of the byte-level pattern, whatever stands before it, so the counts of the parts add
up. The first tier is a broadcast table of frequent pre-tokens and their lengths, found in a
bounded random sample of the texts (it only saves time); the second is each worker's bounded
memory, which has the library encode what it has not met. No pre-token is ever shuffled, and neither tier changes a
result.

Texts that hold a special string of the tokenizer, around which blanks are read otherwise, or the
mark the cut uses, are encoded whole by the library, as are all texts of a tokenizer of another build.

Defined results: a null text counts as empty (0 tokens); an empty table gives no rows; repeated
rows and null ids are counted row by row.
"""

from __future__ import annotations

import collections
import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import col
from .units import Cut, Memory, chunks, per_text, strings

MARK = "\x01"  # not in a text that is cut
#: A blank and what may follow it at a cut: no white space of any kind, nor what is taken for it somewhere.
CUT = r" ([^\x00-\x20\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200F}\x{2028}-\x{202F}\x{205F}-\x{206F}\x{3000}\x{FEFF}])"
#: Rows of the sample that the table is made from (expected number), and bytes of them that are read at most.
SAMPLE, SAMPLE_BYTES = 4096, 64 << 20
#: Entries of the broadcast table, and the longest pre-token in it: 4 MB at most.
FREQUENT = 32_768
LONGEST = 64


class _Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        pre = spec["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.cuttable = (
            spec["normalizer"] is None
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
            and all(pre.get(k) == v for k, v in plain.items())
        )
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.unproven = "|".join([MARK, *special])
        self.memory = Memory(lambda units: (np.array(self.lengths(units), np.int32), np.ones(len(units), np.int64)))

    def lengths(self, units: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(units, add_special_tokens=False)]

    def proven(self, texts: pa.Array) -> np.ndarray:
        if not self.cuttable:
            return np.zeros(len(texts), bool)
        return ~pc.match_substring_regex(texts, self.unproven).to_numpy(zero_copy_only=False)

    @staticmethod
    def cut(texts: pa.Array) -> Cut:
        return Cut(pc.split_pattern(pc.replace_substring_regex(texts, CUT, MARK + r" \1"), MARK))


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> _Counter:
    return _Counter(path)


def frequent_units(
    docs: DataFrame, path: str, *, text: str = "text", entries: int = FREQUENT, sample: int = SAMPLE, seed: int = 1
) -> DataFrame:
    """The most frequent pre-tokens of a random sample of the texts, with their token counts: ``unit``, ``tokens``.

    About ``sample`` rows come to one task, which reads the first :data:`SAMPLE_BYTES` of them.
    """
    n = docs.count()
    some = docs.select(col(text).alias("text")).sample(min(1.0, sample / max(n, 1)), seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        found, left = collections.Counter(), SAMPLE_BYTES
        for batch in chunks(batches, "text", 1 << 20):
            if left < 0:
                break
            texts = strings(batch.column(0))
            left -= pc.sum(pc.binary_length(texts)).as_py() or 0
            cut = counter.cut(texts.filter(pa.array(counter.proven(texts))))
            short = pc.less_equal(pc.binary_length(cut.units), LONGEST).to_numpy(zero_copy_only=False)
            times = np.bincount(cut.codes, minlength=len(cut.units))
            found.update(dict(zip(cut.units.filter(pa.array(short)).to_pylist(), times[short].tolist(), strict=True)))
        units = [u for u, times in found.most_common(entries) if times > 1]
        yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(counter.lengths(units), pa.int32())], ["unit", "tokens"])

    return some.repartition(1).mapInArrow(count, "unit string, tokens int")


def token_counts(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", limit: int = 512, entries: int = FREQUENT
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text."""
    # at most ``entries`` short strings
    table = frequent_units(docs, path, text=text, entries=entries).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (strings(table.column("unit")), table.column("tokens").to_numpy().astype(np.int32))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        units, lengths = shared.value
        for batch in chunks(batches, "text"):
            texts = strings(batch.column(1))
            proven = counter.proven(texts)
            n = np.zeros(len(texts), np.int64)
            if proven.any():
                cut = counter.cut(texts.filter(pa.array(proven)))
                at = pc.index_in(cut.units, value_set=units)
                known = at.is_valid().to_numpy(zero_copy_only=False)
                sizes = np.zeros(len(cut.units), np.int64)
                sizes[known] = lengths[at.drop_null().to_numpy()]
                rest = counter.memory.places(cut.units.filter(pa.array(~known)).to_pylist())
                sizes[~known] = counter.memory.flat[counter.memory.starts[rest]]
                n[proven] = per_text(sizes[cut.codes], cut.offsets)
            if not proven.all():
                n[~proven] = counter.lengths(texts.filter(pa.array(~proven)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("key", kind),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )
    return docs.select(col(key).alias("key"), col(text).alias("text")).mapInArrow(count, schema).withColumnRenamed("key", key)
