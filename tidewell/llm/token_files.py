"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

Ids are replaced by their rank in the corpus, most frequent first, so that most take one byte.
Each rank is written in 1 to 4 little-endian bytes; the byte counts stand apart, two bits each,
four to a control byte (byte count less one, first id in the lowest bits). Decoding looks the
four counts of each control byte up in a table and gathers the data bytes with numpy.

A folder holds two Parquet tables, which Spark writes and commits and which any store can hold:

``vocabulary``  rank, id, n: the ids in use
``blocks``      shard, block, start, n_docs, n_tokens, body: documents in ascending key order

``body`` is little-endian: 4 bytes ``TWB1``; uint32 number of documents; then for all documents
one validity byte, int64 key, uint32 number of ids, uint32 number of data bytes; then all control
bytes (ceil(ids / 4) for each document), then all data bytes. ``start`` counts the ids before the
block. A shard is a key range cut at quantiles of the keys; its documents are sorted and written
by one task, a block at a time.

Texts are tokenized once, into a table of plain ids beside the other two (``ids``: shard, key, n,
ids), from which ids and each shard's tokens are counted and the files are written.

Defined results: a null text counts as empty and holds the end id alone; an empty table gives
empty files; null keys come first; rows of one key follow each other in the order of their code.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import col
from .pieces import PieceCoder
from .units import Cut, Memory, chunks, per_text, strings

MAGIC = b"TWB1"
#: Ids in a block, documents in a shard (and task), and shards at most (their bounds are broadcast).
BLOCK_IDS = 1 << 20
SHARD_DOCS = 8192
MOST_SHARDS = 1 << 14

# ---------------------------------------------------------------------------------------------
# the code


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    counts = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    counts[: len(ranks)] = size - 1
    control = counts.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


#: Byte counts that a control byte stands for.
COUNTS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of one run of control and data bytes."""
    size = COUNTS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    word = padded[at] | padded[at + 1] << 8 | padded[at + 2] << 16 | padded[at + 3] << 24
    return word & MASKS[size]


# ---------------------------------------------------------------------------------------------
# tokenizing

#: Characters in a word from which on the library codes it.
LONG = 256
#: Words with other characters than these are cut and cased by the library.
UNPROVEN = r"^$|[^!-~\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]"


class WordMerges:
    """Merge rounds, as the piece coder makes them, over the bytes of parts of words.

    A part is written as one character for each byte, 256 higher for the last, which the
    vocabulary marks as a word's end.
    """

    _build_table, _slot, find = PieceCoder._build_table, PieceCoder._slot, PieceCoder.find
    rounds, _ranks_at = PieceCoder._rounds, PieceCoder._ranks_at

    def __init__(self, model: dict, alphabet: dict[int, int]):
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        self.pairs = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(model["merges"])
        }
        self.base = max(vocabulary.values()) + 1
        self._build_table()
        names = [chr(alphabet[b]) for b in range(256)]
        self.of_point = np.array([vocabulary[n] for n in names] + [vocabulary[n + end] for n in names], np.int32)

    @staticmethod
    def written(part: str) -> str:
        plain = part if part.isascii() else part.encode().decode("latin-1")
        return plain[:-1] + chr(256 + ord(plain[-1]))


class WordCoder:
    """Ids of texts by their blank-separated words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        # Blanks vanish and no part reaches over one: then words can be coded one by one.
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and not cuts[1]["use_regex"]
            and not any(b in s for s in self.special for b in " \t\n\r\x0b\x0c")
            and spec["model"]["type"] == "BPE" and spec["model"]["end_of_word_suffix"] and not spec["model"].get("dropout")
            and not spec["model"].get("continuing_subword_prefix") and not spec["model"].get("ignore_merges")
        )
        self.memory = Memory(self._code)
        self.unproven = "|".join([UNPROVEN, *[re.escape(s) for s in self.special]])
        self.id_kind = "<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        if self.by_word:
            text = cuts[0]["pattern"]["Regex"]
            self.cut = re.compile(text.replace(r"\p{L}", "a-zß-öø-ÿ").replace(r"\p{N}", "0-9"))
            # the byte-level alphabet: printable bytes stand for themselves, others for 256 and up
            plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
            rest = [b for b in range(256) if b not in plain]
            self.merges = WordMerges(spec["model"], {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)})

    def _code(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has."""
        # Arrow's regular expressions judge all words at once; long words are the library's
        proven = pc.invert(pc.match_substring_regex(pa.array(words, pa.string()), self.unproven)).to_pylist()
        parts: list[str] = []
        n_parts = np.zeros(len(words), np.int64)
        others = []
        for i, word in enumerate(words):
            if not proven[i] or len(word) > LONG:
                others.append(i)
            elif word.isascii() and word.isalpha():  # one part
                parts.append(word.lower())
                n_parts[i] = 1
            else:
                cut = self.cut.findall(word.lower())
                parts += cut
                n_parts[i] = len(cut)
        flat, lengths = self.merges.rounds([self.merges.written(p) for p in parts])
        sizes = per_text(lengths, np.concatenate([[0], np.cumsum(n_parts)]))
        if not others:
            return flat, sizes
        coded = self.library.encode_batch_fast([words[i] for i in others], add_special_tokens=False)
        ends, pieces, before = np.cumsum(sizes), [], 0
        for i, e in zip(others, coded, strict=True):  # these have nothing in the rounds' result
            stop = int(ends[i])
            pieces += [flat[before:stop], np.array(e.ids, np.int32)]
            sizes[i], before = len(e.ids), stop
        return np.concatenate([*pieces, flat[before:]]), sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if not self.by_word:
            found = [e.ids for e in self.library.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter((x for ids in found for x in ids), np.int32, int(sizes.sum())), sizes
        cut = Cut(pc.ascii_split_whitespace(texts))
        ids, lengths = self.memory.spread(cut.units.to_pylist(), cut.codes)
        return ids, per_text(lengths, cut.offsets)


@functools.lru_cache(maxsize=2)
def _coder(path: str) -> WordCoder:
    return WordCoder(path)


# ---------------------------------------------------------------------------------------------
# files


def _bounds(docs: DataFrame, shard_docs: int) -> np.ndarray:
    """Upper ends of all shards but the last."""
    n = docs.count()
    shards = min(MOST_SHARDS, -(-n // shard_docs))
    if shards < 2:
        return np.zeros(0, np.int64)
    at = [i / shards for i in range(1, shards)]
    found = docs.select(F.percentile_approx("key", at, F.lit(4 * shards + 100))).first()[0]
    return np.unique(np.array(found or [], np.int64))


def _shard(keys: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """Shards from 0; null keys are in the first."""
    least = np.iinfo(np.int64).min
    values = pc.fill_null(keys, least).to_numpy(zero_copy_only=False)
    return np.searchsorted(bounds, values, side="left").astype(np.int32)


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    shard_docs: int = SHARD_DOCS,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Tokenize every whole text with the tokenizer at ``path`` and write its ids to ``folder``."""
    spark = docs.sparkSession
    rows = docs.select(col(key).cast("long").alias("key"), col(text).alias("text"))
    bounds = spark.sparkContext.broadcast(_bounds(rows.select("key"), shard_docs))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in chunks(batches, "text"):
            ids, sizes = coder.encode(strings(batch.column(1)))
            ids, sizes = np.insert(ids, np.cumsum(sizes), end_id).astype(coder.id_kind), sizes + 1
            ends = np.concatenate([[0], np.cumsum(sizes * ids.itemsize)])
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype("<i4")), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(_shard(batch.column(0), bounds.value)), batch.column(0), pa.array(sizes, pa.int32()), packed],
                ["shard", "key", "n", "ids"],
            )

    rows.mapInArrow(tokenize, "shard int, key long, n int, ids binary").write.option("compression", "zstd").parquet(f"{folder}/ids")
    plain = spark.read.parquet(f"{folder}/ids")

    def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and how many each row has."""
        sizes = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        packed = b"".join(batch.column(3).to_pylist())
        return np.frombuffer(packed, "<u2" if len(packed) == 2 * sizes.sum() else "<u4"), sizes

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, tokens = np.zeros(0, np.int64), np.zeros(len(bounds.value) + 1, np.int64)
        for batch in batches:
            ids, sizes = unpacked(batch)
            found = np.bincount(ids, minlength=len(n))
            found[: len(n)] += n
            n = found
            np.add.at(tokens, batch.column(0).to_numpy(zero_copy_only=False), sizes)
        for is_id, counts in ((True, n), (False, tokens)):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([is_id] * len(at), pa.bool_()), pa.array(at), pa.array(counts[at])], ["is_id", "at", "n"])

    # as many rows as ids are in use and shards are there
    tallied = plain.mapInArrow(tally, "is_id boolean, at long, n long").groupBy("is_id", "at").agg(F.sum("n").alias("n")).collect()
    used = sorted((-r["n"], r["at"]) for r in tallied if r["is_id"])
    spark.createDataFrame([(i, at, -n) for i, (n, at) in enumerate(used)], "rank long, id long, n long").coalesce(1).write.parquet(f"{folder}/vocabulary")
    rank_of = np.zeros(max((at for _, at in used), default=0) + 1, np.uint32)
    rank_of[[at for _, at in used]] = np.arange(len(used))
    tokens = np.zeros(len(bounds.value) + 1, np.int64)
    for r in tallied:
        if not r["is_id"]:
            tokens[r["at"]] = r["n"]
    shared = spark.sparkContext.broadcast((rank_of, np.cumsum(tokens) - tokens))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, _ = shared.value
        for batch in batches:
            ids, sizes = unpacked(batch)
            ends = np.cumsum(sizes)
            coded = [encode_ranks(ranks[ids[e - n : e]]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([c for c, _ in coded], pa.binary()), pa.array([d for _, d in coded], pa.binary())],
                ["shard", "key", "n", "control", "data"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first = shared.value
        shard, block, start, held = -1, 0, 0, []

        def out() -> pa.RecordBatch:
            n = sum(row[1] for row in held)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([len(held)], pa.int32()), pa.array([n], pa.int64()), pa.array([_body(held)], pa.binary())],
                ["shard", "block", "start", "n_docs", "n_tokens", "body"],
            )

        full = 0
        for batch in batches:
            for at, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (at != shard or full >= block_ids):
                    yield out()
                    block, start, held, full = block + 1, start + full, [], 0
                if at != shard:
                    shard, block, start = at, 0, int(first[at])
                held.append(row)
                full += row[1]
        if held:
            yield out()

    coded = plain.mapInArrow(code, "shard int, key long, n int, control binary, data binary")
    in_order = coded.repartitionById(len(bounds.value) + 1, "shard").sortWithinPartitions(
        "shard", F.asc_nulls_first("key"), "data", "control"
    )
    in_order.mapInArrow(pack, "shard int, block int, start long, n_docs int, n_tokens long, body binary").write.option(
        "compression", "zstd"
    ).parquet(f"{folder}/blocks")


def _body(rows: list) -> bytes:
    keys = [k for k, *_ in rows]
    return b"".join(
        [
            MAGIC,
            struct.pack("<I", len(rows)),
            bytes(k is not None for k in keys),
            np.array([k or 0 for k in keys], "<i8").tobytes(),
            np.array([n for _, n, *_ in rows], "<u4").tobytes(),
            np.array([len(d) for *_, d in rows], "<u4").tobytes(),
            *[c for *_, c, _ in rows],
            *[d for *_, d in rows],
        ]
    )


def read_body(body: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document of a block: its key and the ranks of its ids."""
    if body[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    (n,) = struct.unpack_from("<I", body, 4)
    at = 8
    valid = np.frombuffer(body, np.uint8, n, at)
    keys = np.frombuffer(body, "<i8", n, at := at + n)
    ids = np.frombuffer(body, "<u4", n, at := at + 8 * n).astype(np.int64)
    data = np.frombuffer(body, "<u4", n, at := at + 4 * n).astype(np.int64)
    control = -(-ids // 4)
    at += 4 * n
    # Documents begin at whole control bytes; the ids that fill the last one up are dropped.
    codes = np.frombuffer(body, np.uint8, int(control.sum()), at)
    values = np.frombuffer(body, np.uint8, int(data.sum()), at + len(codes))
    c, d = np.cumsum(control) - control, np.cumsum(data) - data
    for i in range(n):
        yield (
            int(keys[i]) if valid[i] else None,
            decode_ranks(codes[c[i] : c[i] + control[i]], values[d[i] : d[i] + data[i]], int(ids[i])),
        )


def read_token_files(spark: SparkSession, folder: str, *, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """``key``, ``start``, ``n_tokens``, ``ids_crc32`` of each document, and its ``ids`` if wanted."""
    # at most one row for each id of the tokenizer
    vocabulary = spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").select("id").toArrow()
    id_of = spark.sparkContext.broadcast(vocabulary.column("id").to_numpy().astype("<u4"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [(k, id_of.value[ranks]) for k, ranks in read_body(body)]
                sizes = np.array([len(x) for _, x in found], np.int64)
                columns = [
                    pa.array([k for k, _ in found], pa.int64()),
                    pa.array(start + np.cumsum(sizes) - sizes),
                    pa.array(sizes),
                    pa.array([zlib.crc32(x.tobytes()) for _, x in found], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([x.astype(np.int32) for _, x in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["key", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return spark.read.parquet(f"{folder}/blocks").select("start", "body").mapInArrow(decode, schema).withColumnRenamed("key", key)
