import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, no_documents, odd_documents
from tidewell.llm import queries
from tidewell.llm import toxicity as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
D = 2


def plain_words(text):
    out = []
    for word in WORD.findall(text or ""):
        small = "".join(c.lower() if c.isascii() else c for c in word)
        out.append(small.strip(T.MARKS) or small)
    return out


def plain_differences(taught, texts, d=D, passage=T.PASSAGE):
    """The models of the docstring, word by word, without hashes, filters or tables."""
    split = [(plain_words(t), s) for t, s in taught]
    pairs = [collections.Counter(), collections.Counter()]

    def after(words):
        words = ["<start>", *words]
        return list(zip(words, words[1:], strict=False))

    for words, side in split:
        pairs[side].update(set(after(words)))
    both = pairs[0] + pairs[1]
    k = [collections.Counter(w for _, w in p) for p in (*pairs, both)]
    n, m = [collections.Counter() for _ in range(3)], [collections.Counter() for _ in range(3)]
    for i, p in enumerate((*pairs, both)):
        for (h, _), x in p.items():
            n[i][h] += x
            m[i][h] += min(x, d)
    total, vocabulary = [sum(c.values()) for c in k], len(k[2])

    def shared(w):
        left = T.SHARED_DISCOUNT * vocabulary / (vocabulary + 1)
        return (max(k[2][w] - T.SHARED_DISCOUNT, 0) + left) / total[2]

    def p(c, h, w):
        mass = sum(min(x, d) for x in k[c].values())
        one = (max(k[c][w] - d, 0) + mass * shared(w)) / total[c]
        two = (max(both[h, w] - d, 0) + m[2][h] * one) / n[2][h] if n[2][h] else one
        return (max(pairs[c][h, w] - d, 0) + m[c][h] * two) / n[c][h] if n[c][h] else two

    nothing = [sum(min(x, d) for x in k[c].values()) / total[c] for c in (0, 1)]
    base = math.log(nothing[1] / nothing[0])
    out = []
    for text in texts:
        r = [math.log(p(1, h, w) / p(0, h, w)) - base for h, w in after(plain_words(text))]
        r += [0.0] * (passage - len(r))
        out.append(max(sum(r[i : i + passage]) / passage for i in range(len(r) - passage + 1)))
    return out


def corpus(seed=3, n=160):
    rng = random.Random(seed)
    plain, bad = [f"w{i}" for i in range(30)], ["rotten", "vile"]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) if rng.random() < 0.9 else f"once{i}_{rng.random()}" for _ in range(rng.randint(0, 25))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                words.insert(rng.randint(0, len(words)), rng.choice(["Rotten!", "vile", "VILE,"]))
            words.append(rng.choice(bad))
        rows.append((" ".join(words), toxic))
    return rows


@pytest.mark.parametrize("frequent", [T.FREQUENT, 5, 0])
@pytest.mark.parametrize("passage", [1, 2, 5])
def test_differences_match_plain_models(spark, frequent, passage):
    """Also when most of the model has to be joined."""
    rows = corpus()
    taught = spark.createDataFrame(rows, "text string, side int").repartition(3)
    texts = [t for t, _ in rows] + ODD + ["vile", "w1 vile w2", "new words only", "w1 " * 3000 + "vile rotten"]
    model = T.fit(taught, discount=D, frequent=frequent)
    assert len(model.keys) <= frequent < model.entries.count() or frequent == T.FREQUENT
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.s for r in T.differences(docs, model, passage=passage).collect()}
    want = plain_differences(rows, texts, passage=passage)
    assert len(got) == len(texts)
    for i, s in enumerate(want):
        assert abs(got[i] - s) < 1e-5, texts[i][:80]


def test_filter_says_no_only_rightly(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 63, 3000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(4)
    sieve = T.Sieve.of(df, slots=1 << 12)
    assert sieve.has(keys.astype(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 20000).astype(np.uint64)
    assert sieve.has(others).mean() < 0.1
    full = T.Sieve.of(df, slots=4)  # overfull: everything passes, nothing is lost
    assert full.has(keys.astype(np.uint64)).all()


def test_rising_shares():
    counts, positives = np.array([10, 10, 10, 10]), np.array([1, 4, 2, 9])
    got = T.rising(counts, positives)
    assert (np.diff(got) >= 0).all() and got[1] == got[2]
    assert abs(got[0] - (1 + 0.4) / 11) < 1e-12 and abs(got[3] - (9 + 0.4) / 11) < 1e-12


def test_accuracy_on_rows_held_out(spark):
    """Labels hold noise (toxic ones without any insult), so insults are looked for in the text."""
    sf = "/root/testdata/sf0.1"
    rows = queries.QUERIES["op11_toxicity"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    marked = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    told = [r for r in rows if labels.get(r.doc_id) == 1 and not r.held_out]
    common = collections.Counter(w for r in told for w in set(plain_words(texts[r.doc_id])))
    clean = collections.Counter(w for r in rows if labels.get(r.doc_id) == 0 for w in set(plain_words(texts[r.doc_id])))
    insults = {w for w, n in common.items() if n > 30 and not clean[w]}
    assert insults
    bad = [r for r in marked if labels[r.doc_id] and insults & set(plain_words(texts[r.doc_id]))]
    good = [r for r in marked if not labels[r.doc_id]]
    assert sum(r.predicted for r in bad) >= 0.95 * len(bad)
    assert sum(r.predicted for r in good) <= 0.01 * len(good)


def test_labels_held_out_change_nothing(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(corpus(n=300))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, s) for i, (_, s) in enumerate(corpus(n=300))], "doc_id long, toxic int")
    held = T.held_out(F.col("doc_id"))
    spoilt = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    runs = [
        sorted(map(tuple, T.classify(docs, x, rows=lambda key: ~T.held_out(key), discount=D).collect()))
        for x in (labels, spoilt)
    ]
    assert runs[0] == runs[1]


def test_awkward_input(spark):
    docs = odd_documents(spark)
    one_side = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    two_sides = spark.createDataFrame([(i, int(i > 9)) for i in range(len(ODD))] + [(4, 1), (5, 0)], "doc_id long, toxic int")
    for labels, constant in ((one_side, 1.0), (two_sides, None), (one_side.limit(0), 0.0)):
        out = T.classify(docs, labels, discount=1)
        rows = out.collect()
        assert out.columns == ["doc_id", "score", "predicted"] and len(rows) == docs.count()
        assert all(0 <= r.score <= 1 for r in rows)
        assert constant is None or {r.score for r in rows} == {constant}
        again = [r.score for r in rows if r.doc_id in (23, 24)]
        assert len(set(again)) == 1
    assert T.classify(no_documents(spark), two_sides).count() == 0
