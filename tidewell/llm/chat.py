"""Chat formatting in windows of a token budget.

Prefix sums of turn tokens place every turn of a conversation on a line. The line is cut into
steps, and the turns that start in a step make a window; a step is half of what the budget leaves
beside the system turn and the repeated history, so that a window's turns fit although the last
one may reach over the step's end. A turn longer than a step stands in a window of its own. Each
window opens with the conversation's system turn (once it has come), repeats the turns before it
up to the history's tokens, and goes on with its own turns. Only assistant texts among the own
turns are under the loss mask, so every assistant text is a target once.

Template: ``<s>role[INST]text[/INST]</s>`` for each turn. Control strings inside roles and texts
get a backslash after their first character (one more, if there are some), which is taken off
again on reading.

Only DataFrame functions are used. Turns are numbered and summed within chunks of turn numbers and
over the chunks' totals, windows meet their turns by (conversation, step), and a task gathers one
window at a time; no step of the formatting gathers a conversation.

Defined results: null texts and roles count as empty; a null turn comes first; rows alike in turn
are ordered by role and the text's MD5 digest, and repeated rows are turns of their own; null is a conversation of
its own; an empty table gives no rows; a window whose parts alone are longer than the budget is
kept whole and marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import col, total, words

#: Tokens of a window, of the history in it, and of a turn's marks; the least step.
BUDGET, HISTORY, MARKS, LEAST_STEP = 1024, 256, 4, 64
#: Turn numbers whose turns are put in order together.
CHUNK = 256
#: The chunk of turns without a number.
BEFORE_ALL = -(1 << 60)

# The template's control strings as a pattern.
CONTROL = r"(/?(?:s>|INST\]))"
OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "[/INST]</s>"
TURN = r"(?s)<s>(.*?)\[INST\](.*?)\[/INST\]</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


#: Rows of one turn are ordered by role and by a digest of the text, so that texts need not move.
ORDER = ("turn", "role", "tie")


def _placed(rows: DataFrame) -> DataFrame:
    """Each row with its ``place`` in its chunk of turn numbers, from 1."""
    in_chunk = Window.partitionBy("ck", "chunk").orderBy(*[F.col(c).asc_nulls_first() for c in ORDER])
    return rows.withColumn("place", F.row_number().over(in_chunk))


def _on_line(rows: DataFrame) -> DataFrame:
    """Placed rows with ``ord`` (from 1 in the conversation) and the tokens before and with each."""
    in_chunk = Window.partitionBy("ck", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("ck").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        rows.groupBy("ck", "chunk").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
        .select("ck", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"))
    )
    end = F.col("t0") + F.col("run")
    return (
        _placed(rows).withColumn("run", F.sum("tokens").over(in_chunk))
        .join(chunks, ["ck", "chunk"])
        .select("ck", "conv", "chunk", "place", "role", "tokens", (F.col("n0") + F.col("place")).alias("ord"),
                (end - F.col("tokens")).alias("start"), end.alias("end"))
    )


def windows(
    conversations: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: Column | None = None,
    budget: int = BUDGET,
    history: int = HISTORY,
    least_step: int = LEAST_STEP,
) -> DataFrame:
    """The windows of all conversations, one row each.

    ``conv``; ``window`` (its order in the conversation); ``text`` with the template; ``n_context``
    (turns in front that are repeated); ``loss``, the (``start``, ``length``) of the spans under
    the mask, in code points from 0; ``n_tokens`` and ``over_budget``. ``tokens`` counts the
    tokens of the column ``text``; by default its words.
    """
    turns = conversations.select(
        F.concat(F.when(col(conv).isNull(), "n").otherwise("v"), F.coalesce(col(conv).cast("string"), F.lit(""))).alias("ck"),
        col(conv).alias("conv"),
        col(turn).alias("turn"),
        F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    turns = turns.withColumns(
        {
            "chunk": F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(BEFORE_ALL)),
            "tie": F.md5("text"),
            "tokens": (F.size(words(F.col("text"))) if tokens is None else tokens) + MARKS,
        }
    )
    # Windows are made of rows without texts; texts move only to meet the rows that show them.
    placed = _on_line(turns.select("ck", "conv", "chunk", *ORDER, "tokens"))
    texts = _placed(turns.select("ck", "chunk", *ORDER, "text")).select("ck", "chunk", "place", "role", "text")
    first = (
        placed.where("role = 'system'").groupBy("ck").agg(F.min(F.struct("ord", "tokens", "chunk", "place")).alias("s"))
        .select(F.col("ck").alias("sk"), F.col("s.ord").alias("s_ord"), F.col("s.tokens").alias("s_tokens"),
                F.col("s.chunk").alias("s_chunk"), F.col("s.place").alias("s_place"))
    )
    step = F.greatest(F.floor((budget - history - F.coalesce("s_tokens", F.lit(0))) / 2), F.lit(least_step))
    line = (
        placed.join(first.select("sk", "s_ord", "s_tokens"), F.col("ck") == F.col("sk"), "left")
        .withColumn("step", step)
        .withColumn("bin", F.floor(F.col("start") / F.col("step")))
        .withColumn("window", F.col("bin") * 2 + (F.col("tokens") > F.col("step")).cast("int"))
        .withColumn("is_system", F.coalesce(F.col("ord") == F.col("s_ord"), F.lit(False)))
    )
    parts = ["ck", "conv", "window", "kind", "ord", "chunk", "place", "tokens"]
    own = line.withColumn("kind", F.lit(2)).select(parts)
    opened = line.groupBy("ck", "conv", "window", "step", "s_ord").agg(
        F.min("ord").alias("first_ord"), F.min("start").alias("from")
    )
    # A window's history starts in the few steps that its tokens reach back over.
    reach = F.sequence(
        F.greatest(F.floor((F.col("from") - history) / F.col("step")), F.lit(0)), F.floor((F.col("from") - 1) / F.col("step"))
    )
    asked = opened.where("from > 0").select(
        "ck", "conv", F.col("window").alias("w"), "from", F.explode(reach).alias("bin")
    )
    told = line.where("not is_system").select("ck", "bin", "ord", "chunk", "place", "tokens", "start", "end")
    repeated = (
        asked.join(told, ["ck", "bin"])
        .where((F.col("start") >= F.col("from") - history) & (F.col("end") <= F.col("from")))
        .select("ck", "conv", F.col("w").alias("window"), F.lit(1).alias("kind"), "ord", "chunk", "place", "tokens")
    )
    led = (
        opened.where(F.col("s_ord") < F.col("first_ord"))
        .join(first.drop("s_ord"), F.col("ck") == F.col("sk"))
        .select("ck", "conv", "window", F.lit(0).alias("kind"), F.col("s_ord").alias("ord"), F.col("s_chunk").alias("chunk"),
                F.col("s_place").alias("place"), F.col("s_tokens").alias("tokens"))
    )
    members = own.unionByName(repeated).unionByName(led).join(texts, ["ck", "chunk", "place"])
    piece = F.struct(
        "kind", "ord",
        F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE)).alias("head"),
        escaped(F.col("text")).alias("body"),
        ((F.col("kind") == 2) & (F.col("role") == "assistant")).alias("target"),
        "tokens",
    )
    # turns of one window: bounded by the budget
    gathered = members.groupBy("ck", "conv", "window").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    shown = F.array_join(F.transform("p", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    none = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")
    )

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["head"])
        length = F.char_length(x["body"]).cast("bigint")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length + len(CLOSE)).alias("at"),
            F.when(x["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    n_tokens = total(F.transform("p", lambda x: x["tokens"].cast("bigint")))
    return gathered.select(
        F.col("conv").alias(conv),
        "window",
        shown.alias("text"),
        F.size(F.filter("p", lambda x: x["kind"] < 2)).alias("n_context"),
        F.aggregate("p", none, add)["spans"].alias("loss"),
        n_tokens.alias("n_tokens"),
        (n_tokens > budget).alias("over_budget"),
    )


def read_back(formatted: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """What the windows say, by conversation: turns, texts under the mask, and characters.

    A digest of a whole conversation needs its text in one row, so this gathers a conversation.
    """
    roles = F.slice(F.regexp_extract_all("text", F.lit(TURN), F.lit(1)), F.col("n_context") + 1, F.lit(1 << 30))
    texts = F.slice(F.regexp_extract_all("text", F.lit(TURN), F.lit(2)), F.col("n_context") + 1, F.lit(1 << 30))
    spans = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"].cast("int") + 1, s["length"].cast("int"))))
    said = formatted.select(
        col(conv).alias("conv"),
        "window",
        F.char_length("text").cast("bigint").alias("chars"),
        F.size(roles).cast("bigint").alias("n"),
        F.array_join(F.zip_with(roles, texts, lambda r, t: F.concat(unescaped(r), F.lit("\n"), unescaped(t), F.lit("\n"))), "").alias("turns"),
        F.array_join(spans, "").alias("targets"),
    )
    whole = said.groupBy("conv").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"),
    )
    targets = F.array_join("w.targets", "")
    return whole.select(
        F.col("conv").alias(conv),
        "n_turns",
        F.sha2(F.array_join("w.turns", ""), 256).alias("turns_sha256"),
        F.char_length(targets).cast("bigint").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"),
        "formatted_chars",
    )
