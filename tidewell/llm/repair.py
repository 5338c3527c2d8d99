"""Conversation structure repair by cheapest edits, worked out in one pass over sorted rows.

Rows are repartitioned by conversation and sorted by turn; a stream over each partition carries
the state of a dynamic program across Arrow batches. Every row is kept, given another role or
deleted, and empty turns may be inserted, so that the roles read ``(system? (user assistant)+)?``
at the least cost; among equally cheap edits those whose initials (Delete, Insert, Keep, Rerole)
come first in ASCII order are taken.

The program has four states (nothing yet, after system, after user, after assistant). What it
carries is the cost of each state above the cheapest and the order of their edit strings, of which
there are few, so a step is a lookup. Two different states never have edit strings of which one
begins the other (both hold one letter for each row and end in one), so the order of the strings
decides every later tie. A row leaves four bytes of backpointers. They and the rows wait for the
end of the conversation; those of giant conversations go to an unnamed scratch file of the task,
as Spark's own sorts do, and a task that is lost is run again from its shuffled rows.

Whether a row was seen before is found by a window over (conversation, role, text), so that the
stream remembers no texts.

Defined results: null roles and texts read as one space; null turns come first; null is a
conversation of its own; rows of one turn are ordered by role and text; a role counts by its first
character; repeated rows are duplicates of the first; an empty table gives no rows; columns other than
the four named don't enter.
"""

from __future__ import annotations

import functools
import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import BLANKS, col

#: Costs of the edits, and of a truncated row that stays.
RECAST, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 20
#: Characters that wait in memory (a row counts ROW more), and rows of one output batch.
HELD, ROW, OUT_ROWS = 16 << 20, 100, 5_000

SCHEMA = "conv long, row long, turn long, edit string, fault string, given string, role string, text string, cost long"


def following(state: int) -> int:
    """The state after a user or assistant turn: assistant after user, else user."""
    return ASSISTANT if state == USER else USER


def _edits(state: int, initial: str, gone: bool, truncated: bool) -> Iterator[tuple[int, int, str]]:
    """(new state, cost, letters) of what can be done with a row in a state, inserts before it included."""
    spent, letters = 0, ""
    while len(letters) < 4:  # a fourth insert leads where the second one did
        yield state, spent + DELETE, letters + "D"
        if not gone:
            stay = spent + TRUNCATED * truncated
            after = following(state)
            if initial == ("a" if after == ASSISTANT else "u"):
                yield after, stay, letters + "K"
            if initial == "s" and state == NOTHING:
                yield SYSTEM, stay, letters + "K"
            yield after, stay + RECAST, letters + "R"
        state, spent, letters = following(state), spent + INSERT, letters + "I"


@functools.lru_cache(maxsize=1 << 16)
def step(front: tuple, initial: str, gone: bool, truncated: bool):
    """One row: (new front, cost it adds to all states, backpointers).

    A front has the cost above the cheapest and the place in string order of each state. A
    backpointer byte holds the state before (2 bits), the inserts (2) and the letter (2).
    """
    best: dict[int, tuple] = {}
    for state, (cost, place) in enumerate(front):
        if cost < FAR:
            for after, more, letters in _edits(state, initial, gone, truncated):
                offer = (cost + more, place, letters, state)
                if after not in best or offer < best[after]:
                    best[after] = offer
    least = min(b[0] for b in best.values())
    order = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
    after = tuple((best[s][0] - least, order[s]) if s in best else (FAR, 9) for s in range(4))
    back = bytes(
        best[s][3] | (len(best[s][2]) - 1) << 2 | "DKR".index(best[s][2][-1]) << 4 if s in best else 0 for s in range(4)
    )
    return after, least, back


BEGIN = ((0, 0), (FAR, 9), (FAR, 9), (FAR, 9))


def finish(front: tuple) -> tuple[int, int]:
    """The state to end from and the inserts after the last row."""
    ends = []
    for state, (cost, place) in enumerate(front):
        if cost < FAR:
            inserts = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
            ends.append((cost + INSERT * inserts, place, "I" * inserts, state))
    _, _, letters, state = min(ends)
    return state, len(letters)


class Spool:
    """Rows and backpointers of one conversation, in memory and, beyond ``held`` characters, in a scratch file."""

    def __init__(self, held: int):
        self.held, self.size, self.rows, self.backs, self.file, self.blocks = held, 0, [], [], None, []

    def add(self, row: tuple, back: bytes) -> None:
        self.rows.append(row)
        self.backs.append(back)
        self.size += len(row[2]) + ROW
        if self.size >= self.held:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        table = pa.table({str(i): pa.array(c) for i, c in enumerate(zip(*self.rows, strict=True))})
        at = self.file.tell()
        with pa.ipc.new_stream(self.file, table.schema) as writer:
            writer.write_table(table)
        mid = self.file.tell()
        self.file.write(b"".join(self.backs))
        self.blocks.append((at, mid, len(self.rows)))
        self.size, self.rows, self.backs = 0, [], []

    def backpointers(self) -> Iterator[bytes]:
        """From the last row to the first."""
        yield from reversed(self.backs)
        for _, mid, n in reversed(self.blocks):
            self.file.seek(mid)
            block = self.file.read(4 * n)
            for i in range(n - 1, -1, -1):
                yield block[4 * i : 4 * i + 4]

    def replay(self) -> Iterator[tuple]:
        """The rows, first to last."""
        for at, _, _ in self.blocks:
            self.file.seek(at)
            for batch in pa.ipc.open_stream(self.file):
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)
        yield from self.rows


def _trace(spool: Spool, state: int) -> bytearray:
    """One byte for each row, last to first: inserts before it (from bit 2) and letter."""
    path = bytearray()
    for back in spool.backpointers():
        byte = back[state]
        path.append(byte >> 2)
        state = byte & 3
    return path


def _repaired(conv, spool: Spool, front: tuple) -> Iterator[tuple]:
    """The edits of a conversation in order, as rows of :data:`SCHEMA`."""
    state, tail = finish(front)
    path = _trace(spool, state)
    state, row = NOTHING, 0

    def inserted(n: int) -> Iterator[tuple]:
        nonlocal state, row
        for _ in range(n):
            state = following(state)
            yield conv, row, None, "I", None, None, ROLES[state], "", INSERT
            row += 1

    for turn, role, text, fault in spool.replay():
        byte = path.pop()
        yield from inserted(byte & 3)
        edit = "DKR"[byte >> 2]
        now, cost = role, 0
        if edit == "D":
            now, cost = None, DELETE
        else:
            state = SYSTEM if edit == "K" and role[:1] == "s" else following(state)
            if edit == "R":
                now, cost = ROLES[state], RECAST
            cost += TRUNCATED * (fault == "truncated")
        yield conv, row, turn, edit, fault, role, now, text, cost
        row += 1
    yield from inserted(tail)


def _stream(frames: Iterator[pd.DataFrame], held: int) -> Iterator[tuple]:
    spool, front, current = None, BEGIN, None
    for frame in frames:
        convs = [None if pd.isna(c) else int(c) for c in frame["conv"]]
        turns = [None if pd.isna(t) else int(t) for t in frame["turn"]]
        for conv, turn, role, text, fault in zip(convs, turns, frame["role"], frame["text"], frame["fault"], strict=True):
            if spool is None or conv != current:
                if spool is not None:
                    yield from _repaired(current, spool, front)
                spool, front, current = Spool(held), BEGIN, conv
            fault = fault or None
            front, _, back = step(front, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
            spool.add((turn, role, text, fault), back)
    if spool is not None:
        yield from _repaired(current, spool, front)


def _frames(rows: Iterator[tuple], size: int, columns: list[str], whole: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """Frames of at most ``size`` rows; the columns ``whole`` are nullable integers."""
    held: list[tuple] = []

    def frame() -> pd.DataFrame:
        made = pd.DataFrame(held, columns=columns)
        return made.astype({c: "Int64" for c in whole})

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield frame()
            held = []
    if held:
        yield frame()


def faults(text: Column, seen: Column) -> Column:
    """The first fault of a row: blank, duplicate, truncated, or an empty text for none."""
    bare = F.rtrim(text, F.lit(BLANKS))
    return (
        F.when(bare == "", "blank")
        .when(seen, "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )


def repair(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", held: int = HELD
) -> DataFrame:
    """One row for each edit (:data:`SCHEMA`); rows of a conversation stand together, in order.

    ``edit`` is K, R, D or I, ``fault`` the row's first fault, ``given`` its role before and ``role``
    after (null if deleted), ``row`` its number within the conversation. The repaired
    conversation are the rows that are not deleted.
    """
    rows = turns.select(
        col(conv).cast("long").alias("conv"), col(turn).cast("long").alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    alike = Window.partitionBy("conv", F.sha2(F.concat("role", F.lit("\0"), "text"), 256)).orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("fault", faults(F.col("text"), F.row_number().over(alike) > 1))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", F.col("fault") == "duplicate")
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(frames):
        return _frames(_stream(frames, held), OUT_ROWS, names, ("conv", "row", "turn", "cost"))

    return ordered.mapInPandas(run, SCHEMA)


# ---------------------------------------------------------------------------------------------
# report

REPORT = (
    "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class _Tally:
    def __init__(self):
        self.low = self.high = self.last = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.before, self.audit, self.hash, self.begun = None, [], hashlib.sha256(), False

    def add(self, turn, edit, fault, given, role, text, cost) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.high = turn
                self.turns += turn != self.last
                self.last = turn
            if fault:
                self.faults[fault] += 1
            if self.before is not None and self.before + given[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = given[:1]
        if edit != "D":
            self.hash.update((("\n" if self.begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            self.begun = True

    def row(self, conv) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = tuple(self.faults.values())
        return conv, gaps, *counts, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def report(repaired: DataFrame) -> DataFrame:
    """One row (:data:`REPORT`) for each conversation of :func:`repair`'s result, read where it was made.

    ``gaps`` are the turn numbers missing between the least and the greatest, ``illegal`` the
    neighbours whose given roles don't follow each other, ``audit`` the edits' initials, and the
    digest is of the repaired ``role:text`` joined by newlines, taken up row by row.
    """
    names = [f.split()[0] for f in REPORT.split(", ")]

    def rows(frames):
        tally, current = None, None
        for frame in frames:
            convs = [None if pd.isna(c) else int(c) for c in frame["conv"]]
            turns = [None if pd.isna(t) else int(t) for t in frame["turn"]]
            for conv, turn, *rest in zip(
                convs, turns, *[frame[c] for c in ("edit", "fault", "given", "role", "text", "cost")], strict=True
            ):
                if tally is None or conv != current:
                    if tally is not None:
                        yield tally.row(current)
                    tally, current = _Tally(), conv
                tally.add(turn, *rest)
        if tally is not None:
            yield tally.row(current)

    return repaired.mapInPandas(lambda frames: _frames(rows(frames), OUT_ROWS, names, ("conv",)), REPORT)


# ---------------------------------------------------------------------------------------------
# damage


def damage(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", out_of: int = 20
) -> DataFrame:
    """Rows ``conv_id``, ``turn``, ``role``, ``text`` with faults put in by crc32 of ``conv_id:turn`` (nulls: one space).

    Remainder 0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes
    it the user's.
    """
    place = F.concat(
        F.coalesce(col(conv).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(col(turn).cast("string"), F.lit(" "))
    )
    given = turns.select(
        col(conv).alias("conv_id"), col(turn).alias("turn"),
        F.coalesce(col(role), F.lit(" ")).alias("role"), F.coalesce(col(text), F.lit(" ")).alias("text"),
        (F.crc32(place.cast("binary")) % out_of).alias("code"),
    )
    hurt = given.where("code <> 0").withColumns(
        {
            "role": F.when(F.col("code") == 4, "user").otherwise(F.col("role")),
            "text": F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        }
    )
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return hurt.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def repair_damaged(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", held: int = HELD
) -> DataFrame:
    """:func:`report` of the damaged conversations, with every conversation there was."""
    made = report(repair(damage(turns, conv=conv, turn=turn, role=role, text=text), held=held))
    every = turns.select(col(conv).cast("long").alias("conv_id")).distinct()
    both = every.join(made, every.conv_id.eqNullSafe(made.conv), "left")
    zero = F.lit(0).cast("long")
    numbers = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
