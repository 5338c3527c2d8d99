import math
import zlib

import numpy as np

from tests.llm.helpers import no_documents, odd_documents, small, words
from tidewell.llm import discriminant as D
from tidewell.llm import queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op4_quality_classifier"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert held and sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def plain_statistics(text):
    """The statistics of one text, counted in plain Python."""
    text = text or ""
    w = words(text)
    n, chars = len(w), sum(map(len, w))

    def angle(part, whole, prior):
        return math.asin(math.sqrt(min(part / (whole + prior), 1.0)))

    def share(wanted):
        return angle(sum(wanted(c) for c in text), chars, 5 * D.PRIOR)

    return [
        math.log(1 + n),
        math.log(1 + chars / n) if n else 0.0,
        share(lambda c: c in "#*$%&|<>"),
        share(lambda c: "A" <= c <= "Z"),
        share(lambda c: c in "!?"),
        angle(len(set(w)) + D.PRIOR, n, D.PRIOR),
        angle(sum(a == b for a, b in zip(w, w[1:])), n, D.PRIOR),
        share(lambda c: "0" <= c <= "9"),
    ]


def test_statistics_are_those_of_plain_python(spark):
    docs = odd_documents(spark).select("doc_id", "text").unionByName(small(spark, "documents", "doc_id", "text"))
    for r in docs.select("text", D.statistics(D.text_of("text")).alias("x")).collect():
        assert np.allclose(r.x, plain_statistics(r.text), rtol=0, atol=1e-12), r.text


def test_fit_is_that_of_numpy(spark):
    """Moments centred before multiplying, shrinkage and factors; the order of the rows changes nothing."""
    docs, labels = small(spark, "documents", "doc_id", "text"), small(spark, "labels", "doc_id", "quality")
    mark = {}
    for r in labels.where("quality is not null and doc_id is not null").collect():
        mark[r.doc_id] = min(mark.get(r.doc_id, 1), r.quality)
    rows = [(mark[r.doc_id], plain_statistics(r.text)) for r in docs.collect() if r.doc_id in mark]
    sides = [np.array([x for m, x in rows if m == k]) for k in (0, 1)]
    assert min(map(len, sides)) > 10
    pooling, shrinkage, n = 0.2, 0.05, len(rows)
    means = [x.mean(0) for x in sides]
    own = [(x - m).T @ (x - m) for x, m in zip(sides, means, strict=True)]
    pooled = sum(own) / n
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    model = D.fit(docs, labels, pooling=pooling, shrinkage=shrinkage)
    turned = D.fit(docs.orderBy("text").repartition(7), labels, pooling=pooling, shrinkage=shrinkage)
    for k in (0, 1):
        mixed = (1 - pooling) * own[k] / len(sides[k]) + pooling * pooled
        covariance = (1 - shrinkage) * mixed + shrinkage * spread
        assert np.allclose(model.means[k], means[k], atol=1e-9)
        assert np.allclose(model.factors[k] @ covariance @ model.factors[k].T, np.eye(len(spread)), atol=1e-6)
        assert np.allclose(model.factors[k], np.tril(model.factors[k]))
        offset = math.log(len(sides[k]) / n) - np.linalg.slogdet(covariance)[1] / 2
        assert abs(model.offsets[k] - offset) < 1e-6
    assert np.allclose(model.factors, turned.factors, rtol=1e-6) and np.allclose(model.offsets, turned.offsets, atol=1e-6)


def test_score_is_the_difference_of_log_densities(spark):
    docs, labels = small(spark, "documents", "doc_id", "text"), small(spark, "labels", "doc_id", "quality")
    model = D.fit(docs, labels)
    rows = docs.limit(40).select("text", D.statistics(docs["text"]).alias("x"), model.score(docs["text"]).alias("score")).collect()
    for r in rows:
        x = np.array(r.x)
        side = []
        for k in (0, 1):
            covariance = np.linalg.inv(model.factors[k]) @ np.linalg.inv(model.factors[k]).T
            away = x - model.means[k]
            side.append(model.offsets[k] - away @ np.linalg.solve(covariance, away) / 2)
        odds = np.clip(side[1] - side[0], -500, 500)
        assert abs(r.score - 1 / (1 + np.exp(-odds))) < 1e-6


def test_labels_kept_from_learning_change_nothing(spark):
    docs, labels = small(spark, "documents", "doc_id", "text"), small(spark, "labels", "doc_id", "quality")
    spoilt = labels.withColumn("quality", labels.quality * 0).where(D.held_out(labels.doc_id))
    other = labels.where(~D.held_out(labels.doc_id)).unionByName(spoilt)
    fits = [D.fit(docs, x, rows=lambda key: ~D.held_out(key)) for x in (labels, other)]
    assert np.allclose(fits[0].means, fits[1].means) and np.allclose(fits[0].factors, fits[1].factors)


def test_awkward_input(spark):
    docs = odd_documents(spark)
    one_side = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, quality int")
    two_sides = spark.createDataFrame([(1, 1), (2, 1), (21, 0), (22, 0), (21, 1)], "doc_id long, quality int")
    for labels in (one_side, two_sides, one_side.limit(0)):
        model = D.fit(docs, labels)
        scored = D.scored(docs.select("doc_id", "text"), model).collect()
        assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert D.fit(docs, one_side).constant == 1.0
    assert D.scored(no_documents(spark), D.fit(docs, two_sides)).count() == 0
    kept = D.keep_documents(docs, D.fit(docs, two_sides))
    assert kept.columns == docs.columns
