import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import no_documents, odd_documents, small, words
from tidewell.llm import mixing


def shared_out(sizes, share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets(spark):
    docs = small(spark, "documents", "doc_id", "text", "source").unionByName(odd_documents(spark, extra=False))
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    got = mixing.sources(mixing.sizes(docs, key="doc_id", source="source", text="text")).collect()
    want = shared_out(size)
    assert {r.source: r.source_size for r in got} == dict(size)
    assert all(abs(r.target - want[r.source]) < 1e-6 for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257])
def test_permutation(spark, n):
    for turn in (0, 1):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(0), F.lit("s"), F.lit(turn)).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def hashed(*values):
    """Spark's ``xxhash64``: ("i", int), ("l", long) or text, nulls left out."""
    h = 42
    for v in values:
        if v is None:
            continue
        raw = v.encode() if isinstance(v, str) else struct.pack("<i" if v[0] == "i" else "<q", v[1])
        h = xxhash.xxh64(raw, seed=h).intdigest()
    return h - 2**64 if h >= 2**63 else h


def plain_mix(docs, block, shard_blocks):
    """Words taken and shards met of each (id, source, size), worked out slot by slot in plain Python."""
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs]
    size = Counter()
    for _, source, n in rows:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    target = shared_out(size)
    plan = {}
    for s in order:
        taken = int(target[s] + 1e-9)
        if taken:
            blocks = -(-size[s] // block)
            plan[s] = taken, blocks, taken // size[s] * blocks + -(-(taken % size[s]) // block)
    shards = max(1, -(-sum(n for _, _, n in plan.values()) // shard_blocks))
    buckets = max(1, -(-len(rows) // mixing.BUCKET_ROWS))
    got, met = Counter(), {}
    for s, (taken, blocks, n_slots) in plan.items():
        mine = [r for r in rows if r[1] == s]
        bucket = lambda r: hashed(None if r[0] is None else ("l", r[0]), ("l", r[2])) % buckets
        mine.sort(key=lambda r: (bucket(r), r[0] is not None, r[0] or 0, r[2]))
        stream = [r for r in mine for _ in range(r[2])]
        drawn = Counter(hashed(("i", 0), "shard", s, ("l", q)) % shards for q in range(n_slots))
        holds = [shard for shard in sorted(drawn) for _ in range(drawn[shard])]
        full, left = size[s] // block, taken
        for q in range(n_slots):
            turn, x = divmod(q, blocks)
            if x < full:
                for i in range(1, mixing.ROUNDS + 1):
                    partner = (hashed(("i", 0), s, ("l", turn), ("i", i)) - x) % full
                    if hashed(("i", 0), s, ("l", turn), ("i", i), ("l", max(x, partner))) & 1:
                        x = partner
            for r in stream[x * block : (x + 1) * block][:left]:
                got[r] += 1
                met.setdefault(r, set()).add(holds[q])
            left -= min(left, len(stream[x * block : (x + 1) * block]))
        assert left == 0
    return got, met


@pytest.mark.parametrize("block", [16, 2048])
def test_mix_matches_a_plain_one(spark, block):
    docs = small(spark, "documents", "doc_id", "text", "source").unionByName(odd_documents(spark, extra=False))
    given = docs.collect()
    source = {(r.doc_id, len(words(r.text)), r.source) for r in given}
    got, met = plain_mix(given, block, 50)
    out = mixing.mix(docs, block=block, shard_blocks=50).collect()
    assert len(out) == len(given)
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    of_size = {}
    for r in mixing.sources(mixing.sizes(docs, key="doc_id", source="source", text="text")).collect():
        of_size[r.source_size] = r.source
    assert len(of_size) == len({r.source for r in given})  # the sources differ in size here
    taken, shards = Counter(), {}
    for r in out:
        name = (r.doc_id, of_size[r.source_size], r.size)
        assert (name[0], name[2], name[1]) in source
        taken[name] += r.taken
        if r.taken:
            shards.setdefault(name, []).extend([r.first_shard, r.last_shard])
        else:
            assert r.first_shard is None and r.last_shard is None
    assert +taken == got
    assert {n: (min(s), max(s)) for n, s in shards.items()} == {n: (min(s), max(s)) for n, s in met.items()}
    assert max(max(s) for s in met.values()) > 10 or block > 16


def test_shards_hold_consecutive_slots_by_their_counts(spark):
    docs = small(spark, "documents", "doc_id", "text", "source")
    each = mixing.sources(mixing.sizes(docs, key="doc_id", source="source", text="text"))
    plan = mixing.slot_plan(each, block=8)
    n_slots = {r.number: r.n_slots for r in plan.collect()}
    counts = mixing.shard_counts(plan, shard_blocks=30).collect()
    for number, n in n_slots.items():
        mine = sorted((r.shard, r["first"], r.drawn) for r in counts if r.number == number)
        at = 0
        for _, first, drawn in mine:
            assert first == at and drawn > 0
            at += drawn
        assert at == n
    held = Counter((r.number, r.shard) for r in mixing.slots(each, block=8, shard_blocks=30).collect())
    assert held == {(r.number, r.shard): r.drawn for r in counts}


def test_parts_are_the_mix_as_dealt(spark):
    docs = small(spark, "documents", "doc_id", "text", "source").unionByName(odd_documents(spark, extra=False))
    parts = mixing.mixed_parts(docs, block=64, shard_blocks=20).collect()
    taken, shards = Counter(), Counter()
    for r in parts:
        taken[r.doc_id] += r.n_words
        shards[r.shard] += r.n_words
        assert r.n_words > 0 and r.first_word + r.n_words <= r.size and r["at"] + r.n_words <= 64
    want = Counter()
    for r in mixing.mix(docs, block=64, shard_blocks=20).collect():
        want[r.doc_id] += r.taken
    assert taken == +want
    # a place of a shard is one block of one source
    assert len({(r.shard, r.place) for r in parts}) == len({(r.shard, r.place, r.source, r["pass"]) for r in parts})


def test_many_rows_alike(spark):
    rows = [(7, "a b c", "x")] * 300 + [(None, "d e", None)] * 200 + [(i, "f " * i, "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, block=16).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    made = mixing.mixed_documents(docs, block=16).collect()
    got = Counter()
    for r in made:
        got[r.doc_id] += len(words(r.text))
    want = Counter()
    for r in out:
        want[r.doc_id] += r.taken
    assert got == +want
    assert max(Counter((r.doc_id, r.source) for r in made).values()) <= 600


def test_shards_are_in_the_plan(spark):
    plan = mixing.mix(small(spark, "documents", "doc_id", "text", "source"))._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan and "drawn" in plan


def test_reruns_agree_however_the_table_is_split(spark):
    docs = small(spark, "documents", "doc_id", "text", "source")
    first = sorted(map(str, mixing.mix(docs, block=64).collect()))
    assert sorted(map(str, mixing.mix(docs.repartition(7), block=64).collect())) == first


def test_shards_hold_their_share(spark):
    docs = small(spark, "documents", "doc_id", "text", "source")
    slots = mixing.slots(mixing.sources(mixing.sizes(docs, key="doc_id", source="source", text="text")), block=8, shard_blocks=200).collect()
    shards = Counter(s.shard for s in slots)
    assert len(shards) == -(-len(slots) // 200)
    assert all(120 < n < 290 for n in shards.values())
    # each block stands at most once in a pass
    assert max(Counter((s.number, s["pass"], s.block) for s in slots).values()) == 1


def test_mixed_documents_hold_the_words_taken(spark):
    docs = small(spark, "documents").unionByName(no_documents(spark).withColumn("lang", F.lit("")))
    made = mixing.mixed_documents(docs, block=64)
    assert made.columns == docs.columns
    got = Counter()
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in made.collect():
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
        assert not Counter(words(r.text)) - Counter(words(text[r.doc_id]))
    assert +got == +Counter({r.doc_id: r.taken for r in mixing.mix(docs, block=64).collect()})


def test_awkward_input(spark):
    docs = odd_documents(spark)
    assert mixing.mix(docs).count() == docs.count()
    made = mixing.mixed_documents(docs, block=16)
    assert made.columns == docs.columns
    assert sum(len(words(r.text)) for r in made.collect()) == sum(r.taken for r in mixing.mix(docs, block=16).collect())
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.mixed_documents(no_documents(spark)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(empty).collect()] == [0, 0]
