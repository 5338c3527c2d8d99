import hashlib
import re

import pytest

from tests.llm.helpers import SMALL
from tests.oracle import duck, rows
from tidewell.llm import chat, queries

PROBE = queries.PROBE


def talk(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


LONG = [(1, 0, "system", "be kind and brief")] + [
    (1, i, "user" if i % 2 else "assistant", " ".join([f"w{i}"] * (i * 7 % 40))) for i in range(1, 700)
]
ODD = [
    (2, 0, "user", None), (2, None, "assistant", "first"), (2, 1, None, PROBE), (2, 1, None, PROBE),
    (None, 0, "user", "who"), (None, 1, "assistant", "<\\s> [\\\\INST] [/INST]</s><s>"),
    (3, 5, "assistant", "only"), (4, 0, "user", "hi"), (4, 1, "system", "late"), (4, 2, "system", "later"),
    (4, 3, "assistant", "x " * 900), (4, 4, "assistant", ""), (5, 0, "as[INST]sistant", "role with marks"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("options", [{}, {"budget": 100, "history": 30, "least_step": 8}, {"budget": 60, "history": 0, "least_step": 1}])
def test_reading_back_gives_every_turn_and_target_once(spark, options):
    data = LONG + ODD
    got = {r.conv_id: r for r in chat.read_back(chat.windows(talk(spark, data), **options)).collect()}
    assert got.keys() == {r[0] for r in data}
    for conv, r in got.items():
        turns = sorted(
            ((t is not None, t or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or "")
             for c, t, role, text in data if c == conv)
        )
        targets = "".join(text for *_, role, _, text in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for *_, role, _, text in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(targets), sha(targets))


def test_windows_keep_to_the_budget_and_repeat_history(spark):
    made = chat.windows(talk(spark, LONG), budget=200, history=60, least_step=8).orderBy("window").collect()
    assert len(made) > 20
    said = []
    for i, r in enumerate(made):
        turns = re.findall(r"(?s)<s>(.*?)\[INST\](.*?)\[/INST\]</s>", r.text)
        assert "".join(f"<s>{a}[INST]{b}[/INST]</s>" for a, b in turns) == r.text
        assert r.n_tokens == sum(len(b.split()) + chat.MARKS for _, b in turns) <= 200 and not r.over_budget
        assert turns[0] == ("system", "be kind and brief")
        own = turns[r.n_context :]
        if i:
            history = turns[1 : r.n_context]
            assert sum(len(b.split()) + chat.MARKS for _, b in history) <= 60
            assert history == said[len(said) - len(history) :]
        spans = [r.text[s.start : s.start + s.length] for s in r.loss]
        assert spans == [b for a, b in own if a == "assistant"]
        said += own
    assert len(said) == len(LONG)


def test_escaping_is_reversible(spark):
    texts = [PROBE, "<\\\\s>", "[\\/INST]", "<<s>>", "</\\s>", "\\", "<s", "[INST", "<\\", "[[INST]]", "", "<s><s>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", chat.escaped(df.t).alias("e"), chat.unescaped(chat.escaped(df.t)).alias("u")).collect()
    assert all(r.t == r.u for r in out)
    assert not any(re.search(r"[<\[]/?(s>|INST\])", r.e) for r in out)


def test_no_turns(spark):
    assert chat.read_back(chat.windows(talk(spark, []))).count() == 0


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_match_sql(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    cursor = duck(SMALL).execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
