import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import ascii_lower, no_documents, odd_documents, small, words
from tidewell.llm import golay, simhash
from tidewell.llm.components import components


def brute_fingerprint(text):
    w = words(ascii_lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_golay_code():
    _, _, errors = golay.tables()
    assert (errors[:, 0] >= 0).all()
    weight = np.array([[bin(e).count("1") if e >= 0 else -1 for e in row] for row in errors.tolist()])
    # a perfect code: every word has exactly one codeword within three bits, some five more at four
    assert (weight[:, 0] <= 3).all()
    assert all((row[1:] == (4 if row[0] == 3 else -1)).all() for row in weight)
    rng = np.random.default_rng(2)
    word = rng.integers(0, 1 << 23, 4000)
    near = golay.near_codewords(word)
    other = golay.near_codewords(word ^ (1 << rng.integers(0, 23, 4000)))
    assert (other == near[:, :1]).any(1).all() and (near == other[:, :1]).any(1).all()


def test_links_are_all_pairs_within_three_bits(spark):
    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(150)] + [0]
    for x in list(fps):
        for k in (1, 2, 3, 3, 4, 5):
            y = x
            for b in rng.sample(range(64), k):
                y ^= 1 << b
            fps.append(y)
    fps = sorted({signed(x) for x in fps})
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    got = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(0,)], "fp long"), bits=4)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in range(100)],
        "star": [(500, i) for i in range(400)] + [(3, 3)],
        "none": [],
    }[shape]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == brute_roots(nodes, [e for e in edges if e[0] != e[1]])
    assert len(got) == len(nodes)


def test_near_duplicates_match_brute_force(spark):
    given = small(spark, "documents", "doc_id", "text").collect()
    rng = random.Random(6)
    rows = [(r.doc_id, r.text) for r in given]
    for r in given[:40]:  # near copies: one word less
        w = r.text.split(" ")
        w.pop(rng.randrange(len(w)))
        rows.append((1000 + r.doc_id, " ".join(w)))
    rows += [(2000, None), (2001, "!"), (2002, ""), (1999, "  "), (None, ""), (None, given[0].text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(docs).collect()
    fp = [(i, brute_fingerprint(t)) for i, t in rows]
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted((i or -1, f"{f:016x}") for i, f in fp)
    distinct = sorted({f for _, f in fp})
    root = brute_roots(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if (a ^ b).bit_count() <= 3])
    least = {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((i or -1, least[root[f]]) for i, f in fp)
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == want


def test_one_document_of_each_group_stays(spark):
    docs = small(spark, "documents")
    twice = docs.unionByName(docs.limit(60))
    kept = simhash.keep_first(twice)
    assert kept.columns == docs.columns
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(groups)


def test_awkward_input(spark):
    docs = odd_documents(spark)
    assert simhash.near_duplicates(docs).count() == docs.count()
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.where("text = 'same text twice'").count() == 1
    assert simhash.near_duplicates(no_documents(spark)).count() == 0
    only_null = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(only_null).collect()] == [None, None]
    assert simhash.keep_first(only_null).count() == 1
