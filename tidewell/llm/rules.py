"""Quality rules: a learned decision list.

Sequential covering: a rule is a conjunction of thresholds on document statistics. It grows one
condition at a time by information gain on two thirds of the labelled rows, is cut back to the
prefix that does best on the last third, and is kept if it is precise there; the rows it covers
leave, and the next rule is grown. Each step is one Spark aggregate over all labelled rows; the
driver sees counts per (statistic, threshold), whose number the parameters bound. The result is
an ordered Spark conditional expression.

Defined results: a null text has no words; an empty table gives no rows; without labels of both
kinds the list is empty and only the base rule speaks; labels of one document that disagree
count as junk; repeated rows are judged one by one; null ids and labels teach nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import BLANKS, col, let, settle, text_of, total, words

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _repeat_words(word_list: Column) -> Column:
    """Words that lie in a 3-word window found twice or more."""

    def of_windows(windows: Column) -> Column:
        in_order = F.sort_array(windows)
        doubled = let(
            in_order,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, i: (x["w"] == F.get(s, i - 1)["w"]) | (x["w"] == F.get(s, i + 1)["w"]),
                ),
                lambda x: x["at"],
            ),
        )
        return let(
            F.sort_array(doubled),
            lambda at: total(
                F.transform(
                    at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))).cast("bigint")
                )
            ),
        )

    def of_words(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        windows = F.transform(
            starts,
            lambda x, i: F.struct(F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("at")),
        )
        return let(windows, of_windows)

    return of_words(word_list)


#: The counts of a text, in order.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars", "n_lines", "n_capitals", "n_marks",
)


def counts(text: Column) -> Column:
    """A struct of :data:`COUNTS`, in one expression."""
    has_word = f"[^{BLANKS}]"

    def of_parts(t: Column, w: Column, lines: Column) -> Column:
        chars = F.char_length(t)
        made = {
            "n_words": F.size(w),
            "word_chars": F.char_length(_without(t, BLANKS)),
            "n_symbols": chars - F.char_length(_without(t, SYMBOLS)),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeat_words(w),
            "n_chars": chars,
            "n_lines": F.size(lines),
            "n_capitals": chars - F.char_length(_without(t, CAPITALS)),
            "n_marks": chars - F.char_length(_without(t, "!?")),
        }
        return F.struct(*[made[n].cast("bigint").alias(n) for n in COUNTS])

    return let(
        text,
        lambda t: let(
            words(t),
            lambda w: let(F.filter(F.split(t, "\n"), lambda x: x.rlike(has_word)), lambda lines: of_parts(t, w, lines)),
        ),
    )


def statistics(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and the counts of every whole text, worked out in one pass without a shuffle."""
    return docs.select(*[col(c) for c in keep], counts(text_of(text)).alias("__counts")).select(
        *[col(c) for c in keep], *[f"__counts.{n}" for n in COUNTS]
    )


#: Shares the rules may test: name, numerator, denominator. None depends on length or language.
FEATURES = (
    ("symbol_share", "n_symbols", "word_chars"),
    ("repeat_share", "n_repeat_words", "n_words"),
    ("capital_share", "n_capitals", "word_chars"),
    ("mark_share", "n_marks", "n_words"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
)
#: Where counts are found: columns by default, the fields of a struct inside :func:`let`.
Source = Callable[[str], Column]


def feature(name: str, of: Source = F.col) -> Column:
    _, above, below = next(f for f in FEATURES if f[0] == name)
    return F.coalesce(F.try_divide(of(above).cast("double"), of(below)), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, of: Source = F.col) -> Column:
        value = feature(self.feature, of)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self, of: Source = F.col) -> Column:
        out = self.conditions[0].column(of)
        for c in self.conditions[1:]:
            out = out & c.column(of)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def base_failed(of: Source = F.col) -> Column:
    """The fixed rule: fewer than 50 words, or over half the words in repeated windows."""
    return (of("n_words") < 50) | (100 * of("n_repeat_words") > 50 * of("n_words"))


def decision_list(rules: list[Rule], of: Source = F.col) -> Column:
    """Number of the first rule that holds, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        out = F.when(rules[i].column(of), F.lit(i + 1)).otherwise(out)
    return out


def _cuts(rows: DataFrame, grid: int) -> dict[str, list[float]]:
    """Threshold candidates: halfway between neighbouring quantiles of either class."""
    at = [i / grid for i in range(grid + 1)]
    got = rows.groupBy("junk").agg(
        *[
            F.concat(
                F.percentile_approx(f[0], at, F.lit(10000)), F.array(F.min(f[0]), F.max(f[0]))
            ).alias(f[0])
            for f in FEATURES
        ]
    ).collect()  # two rows of bounded arrays
    cuts = {}
    for name, *_ in FEATURES:
        values = sorted({v for row in got for v in row[name] or () if v is not None})
        cuts[name] = [(a + b) / 2 for a, b in zip(values, values[1:], strict=False)]
    return cuts


def learn(
    stats: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    label: str = "quality",
    grid: int = 24,
    max_rules: int = 8,
    max_conditions: int = 3,
    min_precision: float = 0.9,
    min_covered: int = 2,
) -> list[Rule]:
    """An ordered list of rules, each of which marks junk (``label`` 0).

    All labelled rows are used. ``grid`` bounds the thresholds per statistic, the other
    parameters the size of the list.
    """
    marks = (
        labels.where(col(key).isNotNull() & col(label).isNotNull())
        .groupBy(col(key).alias("__key"))
        .agg(F.min(col(label)).alias("__mark"))
    )
    rows = settle(
        stats.join(marks, col(key) == F.col("__key")).select(
            (F.col("__mark") < 1).alias("junk"),
            (F.pmod(F.xxhash64("__key"), F.lit(3)) == 0).alias("prune"),
            *[feature(f[0]).alias(f[0]) for f in FEATURES],
        )
    )
    cuts = _cuts(rows, grid)

    def holds(c: Condition) -> Column:
        value = F.col(c.feature)
        return value >= c.threshold if c.at_least else value < c.threshold

    def covered(conditions) -> Column:
        out = F.lit(True)
        for c in conditions:
            out = out & holds(c)
        return out

    # A statistic's slot is the number of its thresholds at or below it; slots are kept, so that
    # each step groups small integers.
    def slot(name: str) -> Column:
        steps = F.array(*[F.lit(t) for t in cuts[name]]).cast("array<double>")
        return F.size(F.filter(steps, lambda t: t <= F.col(name)))

    slots = [F.struct(F.lit(i).alias("f"), slot(f[0]).alias("slot")) for i, f in enumerate(FEATURES)]
    rows = settle(rows.withColumn("slots", F.array(*slots)))
    left, rules = rows, []
    barred: set[str] = set()  # statistics whose rule failed on the kept third; they open no other
    while len(rules) < max_rules:
        conditions: list[Condition] = []
        held: tuple[int, int] | None = None
        while len(conditions) < max_conditions and (held is None or held[1]):
            slot_counts = (
                left.where(~F.col("prune") & covered(conditions))
                .select("junk", F.explode("slots").alias("s"))
                .groupBy("s.f", "s.slot", "junk")
                .agg(F.count(F.lit(1)).alias("n"))
                .collect()  # at most 4 * (grid + 3) * 2 rows for each of FEATURES
            )
            found = _best(slot_counts, cuts, set() if conditions else barred)
            if found is None:
                break
            condition, held = found
            conditions.append(condition)
        if not conditions:
            break
        parts = [covered(conditions[: k + 1]) for k in range(len(conditions))]
        tried = left.agg(
            *[
                F.count_if(part & (F.col("junk") == junk) & (F.col("prune") | every)).alias(f"c{k}_{int(junk)}_{int(every)}")
                for k, part in enumerate(parts)
                for junk in (True, False)
                for every in (True, False)
            ]
        ).first()

        def worth(k: int, every: int) -> float:
            p, n = tried[f"c{k}_1_{every}"], tried[f"c{k}_0_{every}"]
            return (p - n) / (p + n) if p + n else -1.0

        # the third kept for it decides; all labelled rows where it can't tell prefixes apart
        best = max(range(len(parts)), key=lambda k: (worth(k, 0), worth(k, 1), -k))
        p, n = tried[f"c{best}_1_1"], tried[f"c{best}_0_1"]
        if p < min_covered or p < min_precision * (p + n):
            barred.add(conditions[0].feature)
            continue
        rule = conditions[: best + 1]
        rules.append(Rule(tuple(rule)))
        left = left.where(~covered(rule))
    return rules


def _best(counts, cuts, barred: set[str]) -> tuple[Condition, tuple[int, int]] | None:
    """The condition with the greatest gain; among equal ones the middle threshold."""
    by: dict[int, dict[int, list[int]]] = {}
    for row in counts:
        by.setdefault(row["f"], {}).setdefault(row["slot"], [0, 0])[0 if row["junk"] else 1] += row["n"]
    if not by:
        return None
    whole = [sum(v[i] for v in next(iter(by.values())).values()) for i in (0, 1)]
    if not all(whole):
        return None
    start = math.log2(whole[0] / sum(whole))
    tried: dict[tuple, list[int]] = {}
    for f in sorted(by):
        if FEATURES[f][0] in barred:
            continue
        below = [0, 0]
        for k in range(len(cuts[FEATURES[f][0]])):
            for i in (0, 1):
                below[i] += by[f].get(k, [0, 0])[i]
            for at_least, (p, n) in ((True, (whole[0] - below[0], whole[1] - below[1])), (False, tuple(below))):
                if p:
                    gain = p * (math.log2(p / (p + n)) - start)
                    tried.setdefault((-round(gain, 9), f, not at_least, p, n), []).append(k)
    best = min(tried, default=None)
    if best is None or best[0] >= 0:
        return None
    _, f, less, p, n = best
    ks = tried[best]
    name = FEATURES[f][0]
    return Condition(name, not less, cuts[name][ks[len(ks) // 2]]), (p, n)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with the base rule, the number of the learned rule that fired, and ``kept``."""
    return (
        stats.withColumn("base_failed", base_failed())
        .withColumn("rule", decision_list(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def quality_rules(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """Statistics and verdict of every document, one row per input row.

    The texts are read once: their statistics are settled, rules are learned from those with
    labels, and the list is applied to all.
    """
    stats = settle(statistics(docs, key, text=text))
    return judge(stats, learn(stats, labels, key=key, **learning))


def keep_documents(docs: DataFrame, taught: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", **learning) -> DataFrame:
    """The rows of ``docs`` that the rules learned from ``taught`` keep, with all their columns.

    No join: the list is evaluated on each text where it stands.
    """
    rules = learn(statistics(taught, key, text=text), labels, key=key, **learning)
    return docs.where(
        let(counts(text_of(text)), lambda c: ~base_failed(c.getField) & decision_list(rules, c.getField).isNull())
    )
