"""Quality classifier: regularised quadratic discriminant analysis.

Documents become a vector of transformed statistics (logarithms of counts, angles of shares).
Each class has a mean and a covariance, gathered by one Spark aggregate over all labelled rows;
covariances are shrunk towards the pooled one and towards their diagonal, and their Cholesky
factors are worked out once on the driver from matrices of a fixed size. The score is the
logistic of the difference of log densities: Mahalanobis distances by forward substitution with
the cached factors, as a Spark expression on each text where it stands.

Defined results: a null text counts as empty and gets the score of an empty text; an empty table
gives no rows; documents whose labels disagree count as label 0; null labels and ids teach
nothing; without rows of both labels every document scores the share of label 1, or 1 without
any label; repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import BLANKS, col, let, settle, text_of, words

#: Words before each text in its shares; the transformed statistics, in order.
PRIOR = 10
STATISTICS = ("size", "word_length", "symbols", "capitals", "marks", "variety", "stutter", "digits")


def statistics(text: Column) -> Column:
    """Array of :data:`STATISTICS` of one whole text.

    Shares are taken as if :data:`PRIOR` words (or as many characters as these have) without
    anything remarkable stood before the text, so that a single repeat says little in a short one.
    """

    def angle(part: Column, whole: Column, prior: float) -> Column:
        # the transformation that evens out the variance of a share
        return F.asin(F.sqrt(F.least(part.cast("double") / (whole + F.lit(prior)), F.lit(1.0))))

    def made(t: Column, w: Column) -> Column:
        n, chars = F.size(w), F.char_length(F.translate(t, BLANKS, ""))

        def among(characters: str) -> Column:
            return F.char_length(t) - F.char_length(F.translate(t, characters, ""))

        repeats = F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1)))
        return F.array(
            F.log1p(n.cast("double")),
            F.log1p(F.coalesce(F.try_divide(chars.cast("double"), n), F.lit(0.0))),
            angle(among("#*$%&|<>"), chars, 5 * PRIOR),
            angle(among("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars, 5 * PRIOR),
            angle(among("!?"), chars, 5 * PRIOR),
            angle(F.size(F.array_distinct(w)) + PRIOR, n, PRIOR),
            angle(repeats, n, PRIOR),
            angle(among("0123456789"), chars, 5 * PRIOR),
        )

    return let(text, lambda t: let(words(t), lambda w: made(t, w)))


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians; ``factors`` are the inverse Cholesky factors of their covariances."""

    means: np.ndarray  # 2 x d
    factors: np.ndarray  # 2 x d x d, lower triangular
    offsets: np.ndarray  # log prior less half the log determinant
    constant: float | None = None

    def log_odds(self, x: Column) -> Column:
        """Log odds of label 1 for a statistics array."""
        sides = []
        for k in (0, 1):
            distance = F.lit(0.0)
            for i in range(self.means.shape[1]):
                z = F.lit(0.0)
                for j in range(i + 1):
                    z = z + F.lit(float(self.factors[k, i, j])) * (F.get(x, F.lit(j)) - F.lit(float(self.means[k, j])))
                distance = distance + F.pow(z, F.lit(2.0))
            sides.append(F.lit(float(self.offsets[k])) - distance / 2)
        return sides[1] - sides[0]

    def score(self, text: Column) -> Column:
        """Chance of label 1, from 0 to 1."""
        return self.score_of(statistics(text))

    def score_of(self, x: Column) -> Column:
        """The same for a statistics array."""
        if self.constant is not None:
            return F.lit(self.constant)
        odds = let(x, self.log_odds)
        return F.lit(1.0) / (1 + F.exp(-F.greatest(F.least(odds, F.lit(500.0)), F.lit(-500.0))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: Callable[[Column], Column] | None = None,
    pooling: float = 0.2,
    shrinkage: float = 0.05,
) -> Discriminant:
    """Fit on the documents that have a label; ``rows`` of the key says which of them may teach.

    ``pooling`` is the weight of the pooled covariance, ``shrinkage`` that of the diagonal.
    """
    # The statistics are worked out before the join, so that no text is shuffled.
    x = docs.select(col(key).alias("__id"), statistics(text_of(text)).alias("x"))
    return fit_statistics(x, labels, key=key, label=label, rows=rows, pooling=pooling, shrinkage=shrinkage)


def fit_statistics(
    x: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    label: str = "quality",
    rows: Callable[[Column], Column] | None = None,
    pooling: float = 0.2,
    shrinkage: float = 0.05,
) -> Discriminant:
    """:func:`fit` from the statistics array ``x`` of each id ``__id``."""
    marks = labels.where(col(key).isNotNull() & col(label).isNotNull())
    if rows is not None:
        marks = marks.where(rows(col(key)))
    marks = marks.groupBy(col(key).alias("__key")).agg((F.min(col(label)) >= 1).cast("int").alias("side"))
    taught = x.join(marks, F.col("__id") == F.col("__key"))
    d = len(STATISTICS)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = taught.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d)],
        *[F.sum(F.get("x", F.lit(i)) * F.get("x", F.lit(j))).alias(f"p{i}_{j}") for i, j in pairs],
    ).collect()  # two rows
    by = {r["side"]: r for r in sums}
    if len(by) < 2:
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), float(max(by, default=1)))
    n = np.array([by[k]["n"] for k in (0, 1)], float)
    means = np.array([[by[k][f"s{i}"] for i in range(d)] for k in (0, 1)]) / n[:, None]
    scatter = np.zeros((2, d, d))
    for k in (0, 1):
        for i, j in pairs:
            scatter[k, i, j] = scatter[k, j, i] = by[k][f"p{i}_{j}"] - n[k] * means[k, i] * means[k, j]
    pooled = scatter.sum(0) / n.sum()
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    factors, offsets = [], []
    for k in (0, 1):
        own = (1 - pooling) * scatter[k] / n[k] + pooling * pooled
        own = (1 - shrinkage) * own + shrinkage * spread
        factor = np.linalg.cholesky(own)
        factors.append(np.linalg.inv(factor))
        offsets.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def classify(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = 0.7, **fitting
) -> DataFrame:
    """``key``, ``score`` and ``predicted`` of each row of ``docs``, by a model fitted on those with a label.

    The texts are read once: their statistics are settled, and the model is fitted and applied to them.
    """
    x = settle(docs.select(col(key).alias("__id"), statistics(text_of(text)).alias("x")))
    model = fit_statistics(x, labels, key=key, **fitting)
    score = x.select(F.col("__id").alias(key), model.score_of(F.col("x")).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def scored(docs: DataFrame, model: Discriminant, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from the threshold on)."""
    return docs.withColumn("score", model.score(text_of(text))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_documents(docs: DataFrame, model: Discriminant, *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that the model predicts to have label 1, with all their columns."""
    return docs.where(model.score(text_of(text)) >= threshold)


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
