"""SentencePiece encoding and decoding by vectorised merge rounds.

A text becomes the library's normalised form (blanks shown as U+2581, one in front) and is cut
before each run of blanks, where no piece of the model can merge. Units a worker has not met are
cut once more between characters that stand together in no piece, and coded together: flat numpy
arrays hold the symbols of all parts; a round finds each part's least pair rank, merges its pairs
of that rank from the left in all parts at once, and compacts the arrays; parts without a pair leave.
Ranks order pieces by score, as the library's queue does. The library takes one pair at a time, so
the merges of a part in one round end with the first that makes a new pair of no greater rank,
which the library would take next: merge order and result are the library's at every length.

Models of another build (not BPE, an own normaliser, user-defined pieces, or pieces with a blank
after another character) are coded by the library.

Defined results: a null text counts as empty and has no ids; an empty table gives no rows;
repeated rows and null ids are coded row by row.
"""

from __future__ import annotations

import functools
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

BLANK = "▁"
MARK = "\x01"
NONE = np.iinfo(np.int32).max


class PieceCoder:
    """One model: its pieces, the pairs that merge, and what it has coded."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.piece_size())
        self.pieces = [sp.id_to_piece(i) for i in ids]
        normal = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = np.array([sp.get_score(i) for i in normal])
        # equal scores share a rank; the leftmost pair goes first among them
        rank = np.searchsorted(np.unique(-scores), -scores)
        self.plain = self._plain(sp) and not any(BLANK in self.pieces[i].lstrip(BLANK) for i in normal)
        self.symbol = {self.pieces[i]: i for i in normal}
        for i in normal:  # characters that only occur inside pieces
            for c in self.pieces[i]:
                self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for i, r in zip(normal, rank, strict=True):
            piece = self.pieces[i]
            for k in range(1, len(piece)):
                left, right = self.symbol.get(piece[:k]), self.symbol.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left, right] = (int(r), i)
        self.pairs = pairs
        self.base = len(self.pieces) + len(self.symbol) + 1
        self._build_table()
        beside = {(self.symbol[a], self.symbol[b]) for i in normal for a, b in zip(self.pieces[i], self.pieces[i][1:])}
        self.beside = np.unique(np.array([a * self.base + b for a, b in beside], np.int64))
        points = np.array([(ord(c), i) for c, i in self.symbol.items() if len(c) == 1], np.int64).reshape(-1, 2)
        self.of_point = np.full(0x110000, -1, np.int32)
        self.of_point[points[:, 0]] = points[:, 1]
        byte = {int(self.pieces[i][1:-1], 16): i for i in ids if sp.is_byte(i)}
        self.bytes = np.array([byte.get(b, sp.unk_id()) for b in range(256)], np.int32)
        self.plain = self.plain and len(byte) == 256 and bool(pairs)
        # a character of one byte that is no piece is its byte's piece from the start
        lone = np.flatnonzero(self.of_point[:128] < 0)
        self.of_point[lone] = self.bytes[lone]
        self.width = [1 if sp.is_byte(i) else len(self.pieces[i]) for i in ids]
        self.shown = [b"" if sp.is_control(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        for b, i in byte.items():
            self.shown[i] = bytes([b])
        self.shown[sp.unk_id()] = b""
        self.memory = Memory(self._code_units)

    @staticmethod
    def _plain(sp) -> bool:
        """Whether the model only writes blanks as U+2581, with one in front."""
        probe = " a  b\tﬁ Éé "
        return sp.normalize(probe) == BLANK + probe.replace(" ", BLANK)

    # -- encoding ---------------------------------------------------------------------------

    def _build_table(self) -> None:
        """The pairs in a flat table: a pair lies at its hash or one of the next few places."""
        keys = np.array([a * self.base + b for a, b in self.pairs], np.int64)
        found = np.array([*self.pairs.values()], np.int32).reshape(-1, 2)
        self.bits = max(8, int(len(keys)).bit_length() + 3)
        places = 1 << self.bits
        self.slot_key = np.full(places + 64, -1, np.int64)
        self.slot_rank, self.slot_made = np.full(places + 64, NONE, np.int32), np.zeros(places + 64, np.int32)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            free = self.slot_key[at[left]] < 0
            _, first = np.unique(at[left][free], return_index=True)
            placed = left[free][first]
            self.slot_key[at[placed]] = keys[placed]
            self.slot_rank[at[placed]], self.slot_made[at[placed]] = found[placed, 0], found[placed, 1]
            left = np.setdiff1d(left, placed)
            at[left] += 1
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair; :data:`NONE` where the two don't merge."""
        wanted = np.where((left < 0) | (right < 0), np.int64(-2), left.astype(np.int64) * self.base + right)
        at = self._slot(wanted)
        for _ in range(self.probes - 1):
            key = self.slot_key[at]
            astray = np.flatnonzero((key != wanted) & (key >= 0))
            if not len(astray):
                break
            at[astray] += 1
        hit = self.slot_key[at] == wanted
        return np.where(hit, self.slot_rank[at], NONE), self.slot_made[at]

    def _code_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and how many each has."""
        flat, sizes = self._rounds(units, every=True)
        odd = (flat < 0) | (flat >= len(self.pieces))
        rare = np.unique(np.repeat(np.arange(len(units)), sizes)[odd]).tolist()
        ends = np.cumsum(sizes)
        parts, before = [], 0
        for i in rare:
            stop = int(ends[i])
            start = stop - int(sizes[i])
            made = self._with_bytes(flat[start:stop], units[i])
            parts += [flat[before:start], made]
            sizes[i], before = len(made), stop
        return np.concatenate([*parts, flat[before:]]), sizes

    def _with_bytes(self, symbols: np.ndarray, unit: str) -> np.ndarray:
        """Ids of merged symbols; characters that are no piece become bytes."""
        ids, at = [], 0
        for s in symbols.tolist():
            if 0 <= s < len(self.pieces):
                ids.append(s)
                at += self.width[s]
            else:
                ids.extend(self.bytes[list(unit[at].encode())].tolist())
                at += 1
        return np.array(ids, np.int32)

    def _rounds(self, units: list[str], *, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols of all units end to end, and how many each has.

        A round merges the leftmost pair of least rank of each unit; with ``every`` all such
        pairs, in each part of a unit by itself.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        symbols = self.of_point[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        unit = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
        owner = np.arange(len(units), dtype=np.int32)
        if every and len(symbols):
            starts = self._apart(symbols) | (np.diff(unit, prepend=-1) > 0)
            owner = unit[starts]
            unit = np.cumsum(starts, dtype=np.int32) - 1
        done_unit, done_symbols = [unit[:0]], [symbols[:0]]
        rank, made = self._ranks_at(symbols, unit, np.arange(len(symbols)))
        self.rounds_run = 0
        while len(symbols):
            starts = np.flatnonzero(np.diff(unit, prepend=-1))
            size = np.diff(starts, append=len(symbols))
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            stay = least != NONE
            if not stay.all():  # units without a pair leave
                done_unit.append(unit[~stay])
                done_symbols.append(symbols[~stay])
            hit = np.flatnonzero((rank == least) & stay)
            if not len(hit):
                break
            self.rounds_run += 1
            if every:
                hit = self._mergeable(hit, symbols, unit, rank, made)
            else:
                hit = hit[np.flatnonzero(np.diff(unit[hit], prepend=-1))]  # leftmost in each unit
            symbols[hit] = made[hit]
            stay[hit + 1] = False
            at = (np.cumsum(stay) - 1)[hit]  # where the merged symbols lie after compaction
            symbols, unit, rank, made = symbols[stay], unit[stay], rank[stay], made[stay]
            before = at[at > 0] - 1
            around = np.concatenate([at, before[unit[before] == unit[before + 1]]])
            rank[around], made[around] = self._ranks_at(symbols, unit, around)
        part, flat = np.concatenate(done_unit), np.concatenate(done_symbols)
        order = np.argsort(part, kind="stable")
        return flat[order], np.bincount(owner[part], minlength=len(units))

    def _apart(self, symbols: np.ndarray) -> np.ndarray:
        """Where a character follows one that stands before it in no piece; no merge reaches over such a place."""
        left, right = symbols[:-1].astype(np.int64), symbols[1:]
        key = np.where((left < 0) | (right < 0), np.int64(-1), left * self.base + right)
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        return np.concatenate([[True], self.beside[at] != key])

    def _mergeable(self, hit, symbols, unit, rank, made) -> np.ndarray:
        """The pairs, of those of least rank, that are next in order one after the other.

        From the left, pairs that share a symbol with the one before fall out. A merge that makes
        a pair of no greater rank with a neighbour, as the neighbours are at that time, is a
        part's last in this round.
        """
        new_run = np.diff(hit, prepend=-2) > 1
        new_run[1:] |= unit[hit[1:]] != unit[hit[:-1]]
        run_start = hit[np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))]
        hit = hit[(hit - run_start) % 2 == 0]
        head = np.diff(unit[hit], prepend=-1) > 0
        if head.all():
            return hit
        last = len(symbols) - 1
        product, limit, own = made[hit], rank[hit], unit[hit]
        right = np.minimum(hit + 2, last)
        after = self.find(product, symbols[right])[0]
        low = (hit + 2 <= last) & (unit[right] == own) & (after <= limit)
        left = np.maximum(hit - 1, 0)
        neighbour = symbols[left]
        joined = np.flatnonzero((np.diff(hit, prepend=-3) == 2) & ~head)
        neighbour[joined] = product[joined - 1]
        before = self.find(neighbour, product)[0]
        low |= (hit > 0) & (unit[left] == own) & (before <= limit)
        earlier = np.cumsum(low) - low
        return hit[earlier == earlier[np.maximum.accumulate(np.where(head, np.arange(len(hit)), 0))]]

    def _ranks_at(self, symbols: np.ndarray, unit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each symbol at ``at`` with its right neighbour in the unit."""
        following = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self.find(symbols[at], symbols[following])
        return np.where((following > at) & (unit[following] == unit[at]), rank, NONE), made

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if not self.plain:
            found = [np.array(x, np.int32) for x in self.library.encode(texts.to_pylist(), num_threads=1)]
            return (np.concatenate(found) if found else np.zeros(0, np.int32)), np.fromiter(map(len, found), np.int64, len(found))
        texts = pc.replace_substring(texts, BLANK, " ")
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            lists = pa.array([re.findall(" +[^ ]*", " " + t) if t else [] for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            empty = pc.equal(texts, "")
            marked = pc.replace_substring_regex(pc.binary_join_element_wise(" ", texts, ""), "( +)", MARK + r"\1")
            # what stands before the first mark is nothing
            lists = pc.split_pattern(pc.if_else(empty, "", marked), MARK)
        cut = Cut(lists)
        ids, lengths = self.memory.spread(pc.replace_substring(cut.units, " ", BLANK).to_pylist(), cut.codes)
        return ids, per_text(lengths, cut.offsets)

    # -- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """What the library's ``decode(ids)`` returns."""
        if not self.plain or (len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces))):
            return self.library.decode(ids.tolist())
        shown = b"".join(map(self.shown.__getitem__, ids.tolist()))
        try:
            text = shown.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids.tolist())
        if len(ids) and ((ids < 3).any() or not self.pieces[ids[0]].startswith(BLANK)):
            return self.library.decode(ids.tolist())
        return text[1:]


@functools.lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def encode_pieces(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(path)
        for batch in chunks(batches, "text"):
            ids, sizes = pieces.encode(strings(batch.column(1)))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            decoded = [pieces.decode(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.string())], ["key", "ids", "decoded"])

    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType(), True)),
            T.StructField("decoded", T.StringType()),
        ]
    )
    return docs.select(col(key).alias("key"), col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)


def digests(coded: DataFrame, *more: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas), ``decoded_sha256``, and ``more``."""
    return coded.select(
        col(key),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
