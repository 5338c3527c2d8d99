import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SMALL
from tidewell.llm import queries, repair

GOOD = re.compile(r"(s?(ua)+)?")
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def first_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, edits, repaired rows) by a search in order of (cost, letters), with all edits tried."""
    marks = first_faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, roles, made = heapq.heappop(heap)
        if i == len(rows) and GOOD.fullmatch(roles):
            return cost, letters, made
        key = (i, roles[-1:], "s" in roles[:1], bool(roles))
        if key in done:
            continue
        done.add(key)
        offers = [("I", 2, 0, r, "") for r in ("user", "assistant")]
        if i < len(rows):
            _, role, text = rows[i]
            offers.append(("D", 3, 1, None, None))
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                offers.append(("K", more, 1, role, text))
                offers += [("R", 2 + more, 1, r, text) for r in ("user", "assistant")]
        for letter, more, used, role, text in offers:
            now = roles + (role[:1] or "?") if role is not None else roles
            if re.fullmatch(r"s?(ua)*u?", now):
                step = made if role is None else (*made, (role, text))
                heapq.heappush(heap, (cost + more, letters + letter, i + used, now, step))
    raise AssertionError


def ordered(rows):
    clean = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(clean, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def want(rows):
    rows = ordered(rows)
    marks = first_faults(rows)
    cost, audit, made = cheapest(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[marks.count(k) for k in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest(),
    )


def hurt(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        mine += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def made(df):
    return {r.conv: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("held", [repair.HELD, 300])
def test_cheapest_edits_match_search(spark, held):
    rng = random.Random(5)
    rows = []
    for conv in range(250):
        for i in range(rng.randint(1, 9)):
            text = rng.choice(["yes.", "no!", "cut off", "", " \t", "so?  ", f"text {i}.", "\n"])
            rows.append((conv, rng.choice([i, i, 2 * i, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    got = made(repair.report(repair.repair(frame(spark, rows), held=held)))
    for conv in range(250):
        assert got[conv] == want([r[1:] for r in rows if r[0] == conv]), conv
    assert len(got) == 250


def test_repaired_rows_read_as_a_conversation(spark):
    rows = [(1, 1, "user", "hi."), (1, 2, "user", "more."), (1, 3, "assistant", "cut"), (1, 5, "tool", "x."), (2, 0, "system", "s.")]
    out = repair.repair(frame(spark, rows)).where("edit <> 'D'").orderBy("conv", "row").collect()
    roles = ["".join(r.role[0] for r in out if r.conv == c) for c in (1, 2)]
    assert all(GOOD.fullmatch(r) for r in roles)
    assert {r.text for r in out if r.edit == "K"} <= {r[3] for r in rows}


def test_query_on_given_conversations(spark):
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_conversation_repair"](spark, SMALL).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = hurt(rows)
    assert got.keys() == damaged.keys()
    for conv, mine in damaged.items():
        expected = want(mine) if mine else (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
        assert got[conv] == expected, conv


def test_giant_conversation_over_many_batches(spark):
    rng = random.Random(6)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), f"t{rng.randint(0, 2500)}{rng.choice('.!x')}") for i in range(4000)]
    rows += [(c, 0, "user", "one.") for c in range(8, 12)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 300)
    try:
        runs = [made(repair.report(repair.repair(frame(spark, rows), held=h))) for h in (repair.HELD, 5000)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert runs[0] == runs[1]
    mine = ordered([r[1:] for r in rows if r[0] == 7])
    # cost of the cheapest edits by a plain program over (row, last initial)
    best, marks = {"": 0}, first_faults(mine)
    for (_, role, _), mark in zip(mine, marks, strict=True):
        now = {}
        for last, cost in best.items():
            for inserts in range(4):
                at = last
                for _ in range(inserts):
                    at = "a" if at == "u" else "u"
                after = "a" if at == "u" else "u"
                now[at] = min(now.get(at, 1 << 30), cost + 2 * inserts + 3)
                if mark in ("", "truncated"):
                    price = cost + 2 * inserts + (mark == "truncated") + (0 if role[0] == after else 2)
                    now[after] = min(now.get(after, 1 << 30), price)
        best = now
    assert runs[0][7][5] == min(c + 2 * (last == "u") for last, c in best.items())


def test_awkward_input(spark):
    long = "word. " * 200_000
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "b."), (1, None, "user", "b."), (2, 3, "user", long),
        (2, 3, "assistant", long), (2, 10, "assistant", "é\x00."), (3, 0, "ünknown", "x."),
    ]
    df = frame(spark, rows)
    for name in ("conv", "row", "fault", "edit", "copy", "code", "cost", "audit"):
        df = df.withColumn(name, F.lit(9))
    got = made(repair.report(repair.repair(df)))
    for conv in (None, 1, 2, 3):
        assert got[conv] == want([r[1:] for r in rows if r[0] == conv]), conv
    assert {r.conv_id for r in repair.repair_damaged(df).collect()} == {None, 1, 2, 3}
    assert repair.repair_damaged(df.limit(0)).count() == 0
