"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary texts, give every word a log-likelihood after the word
before it. Both back off to the same counts, so that an expression too rare to tell the classes apart
says nothing:

    p_c(w | h) = (max(n_c(h w) - D, 0) + m_c(h) q_c(w | h)) / n_c(h)       the class's own expressions
    q_c(w | h) = (max(n(h w) - D, 0) + m(h) p_c(w)) / n(h)                 expressions of both classes
    p_c(w)     = (max(k_c(w) - D, 0) + M_c p(w)) / K_c                     the class's own words
    p(w)       = (max(k(w) - d, 0) + d V / (V + 1)) / K                    words of both classes

``n`` counts documents, ``k`` is the continuation count (after how many different words w stands), and
``m``, ``M`` are what the discounts D and d take away. Since copies of a text repeat its expressions but put no word after a new one, groups of copies count little.

A passage's toxic and ordinary log-likelihoods are divided by its length and compared; a text counts
by its most toxic passage, however long it is around it. Passages of a text shorter than one are filled up
with words that say nothing. Differences become chances by a monotone (pool adjacent violators)
fit on a fourth of the labelled rows, which the models never see.

The counts cover all words of all labelled rows and stay in tables. What leaves them for the tasks is
bounded: a filter of fixed size that says which keys the model has, and the model's most frequent
keys. Keys that pass the filter and aren't among those are joined with the table.

Words are runs of characters other than ASCII blanks, in small ASCII letters, without ASCII marks
around them. They are counted by hashes of 32 bits, so that an expression is one number; words that share
a hash are one word.

Texts of labelled rows meet their labels once (in a shuffle, unless Spark finds the labels small) and are kept in a table; a filter over
the labels' ids leaves most other texts out before. Nothing else that is shuffled holds texts.

Defined results: a null text counts as empty, and an empty text differs by nothing; documents whose labels
disagree count as toxic; null labels and ids teach nothing; without rows of both labels every text
gets the share of label 1 (0 without labels); where no row of one label is left to fit chances on, the difference is
added to the log odds of that share; repeated rows are scored one by one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import col, folder, settle
from .units import Cut, chunks, per_text, strings

#: Discounts of class counts and of shared continuation counts.
DISCOUNT, SHARED_DISCOUNT = 12, 0.75
#: Words of a passage.
PASSAGE = 2
#: Bytes of text that are worked on together; a word takes some twenty numbers meanwhile.
CHUNK_BYTES = 4 << 20
#: Model entries that go to every task (16 bytes each), and 64-bit words of a filter.
FREQUENT, SLOTS = 1 << 19, 1 << 19
#: Parts of a unit of difference, and the differences told apart.
STEPS, LOWEST, HIGHEST = 32, -4, 8

#: The word before the first.
START = np.uint64(1)
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


# ---------------------------------------------------------------------------------------------
# words, keys, filters


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit keys scattered by multiplying and shifting."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Two words of 32 bits; as no word is 0, no pair is a word."""
    return before << np.uint64(32) | word


class Sieve:
    """Which keys were put in: four bits in one of a fixed number of 64-bit words. Never says no wrongly."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def bits(keys: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        x = mixed(keys)
        mask = np.zeros(len(x), np.uint64)
        for shift in (0, 6, 12, 18):
            mask |= np.uint64(1) << (x >> np.uint64(shift) & np.uint64(63))
        return (x >> np.uint64(24)) % np.uint64(slots), mask

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot, mask = self.bits(keys, len(self.words))
        return self.words[slot] & mask == mask

    @classmethod
    def of(cls, keys: DataFrame, slots: int = SLOTS) -> Sieve:
        """Of a table's one column of keys; tasks fill filters of their own, Spark unites them word by word."""

        def fill(batches):
            words = np.zeros(slots, np.uint64)
            for batch in batches:
                slot, mask = cls.bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), slots)
                np.bitwise_or.at(words, slot, mask)
            used = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["slot", "bits"])

        filled = keys.mapInArrow(fill, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = np.zeros(slots, np.uint64)
        words[filled["slot"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
        return cls(words)


class Keyed:
    """The words of a chunk of texts as keys: ``units`` (one each), ``codes`` into them, ``sizes`` and ``starts`` of the texts."""

    def __init__(self, texts: pa.Array):
        cut = Cut(pc.ascii_split_whitespace(texts))
        small = pc.ascii_lower(cut.units.cast(pa.string()))
        bare = pc.ascii_trim(small, characters=MARKS)
        plain = pc.if_else(pc.equal(bare, ""), small, bare).to_pylist()
        hashed = np.fromiter(map(xxhash.xxh32_intdigest, plain), np.uint64, len(plain))
        self.units = np.maximum(hashed, START + np.uint64(1))
        some = pc.greater(pc.binary_length(cut.units), 0).to_numpy(zero_copy_only=False)
        word = some[cut.codes] if len(cut.codes) else np.zeros(0, bool)
        self.codes = cut.codes[word]
        self.sizes = per_text(word.astype(np.int64), cut.offsets)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def before(self, words: np.ndarray) -> np.ndarray:
        out = np.empty_like(words)
        out[1:] = words[:-1]
        out[self.starts[self.sizes > 0]] = START
        return out

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.uint64), self.sizes)


def _once_a_text(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Where each text has each key first."""
    return np.unique(mixed(keys ^ mixed(owners + np.uint64(3))), return_index=True)[1]


# ---------------------------------------------------------------------------------------------
# counts


def _expressions(taught: DataFrame) -> DataFrame:
    """``pair`` (h and w) and the documents ``n0`` and ``n1`` of each label that hold w after h."""

    def count(batches):
        for part in chunks(batches, "text", CHUNK_BYTES):
            side = part.column("side").to_numpy(zero_copy_only=False).astype(bool)
            words = Keyed(strings(part.column("text")))
            w = words.units[words.codes]
            h = words.before(w)
            pairs, owners = pair_keys(h, w), words.owners()
            once = _once_a_text(pairs, owners)
            _, first, place = np.unique(pairs[once], return_index=True, return_inverse=True)
            toxic = side[owners[once].astype(np.int64)]
            n1 = np.bincount(place[toxic], minlength=len(first))
            n0 = np.bincount(place[~toxic], minlength=len(first))
            keys = pairs[once][first].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n0), pa.array(n1)], ["pair", "n0", "n1"])

    parts = taught.select("text", "side").mapInArrow(count, "pair long, n0 long, n1 long")
    return parts.groupBy("pair").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _entries(pairs: DataFrame, discount: int) -> DataFrame | None:
    """The model: for each ``key`` what it adds ``here`` and to the word after it (``next``), and its ``weight``.

    A word's own entry holds its difference by the words' counts and, for the next word, that of the
    weights of its back-off; an expression's entry holds what is to be added to these two.
    """
    big = F.lit(float(discount))

    def above(n: Column) -> Column:
        return F.greatest(n - big, F.lit(0.0))

    pairs = pairs.withColumns({"h": F.shiftrightunsigned("pair", 32), "w": F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))})
    n0, n1 = F.col("n0"), F.col("n1")
    sums = {
        "w": {"k0": (n0 > 0).cast("long"), "k1": (n1 > 0).cast("long"), "k": F.lit(1)},
        "h": {"n0": n0, "n1": n1, "m0": F.least(n0, big), "m1": F.least(n1, big), "m": F.least(n0 + n1, big)},
    }
    # an expression counts for its last word and for its first: two rows that are summed in one shuffle
    ends = F.array(*[
        F.struct(F.col(side).alias("key"), *[(v if name in mine else F.lit(0)).cast("long").alias(name) for part in sums.values() for name, v in part.items()])
        for side, mine in sums.items()
    ])
    names = [name for part in sums.values() for name in part]
    path = folder(pairs.sparkSession, "toxicity-words")
    pairs.select(F.explode(ends).alias("e")).groupBy("e.key").agg(*[F.sum(f"e.{x}").alias(x) for x in names]).write.parquet(path)
    words = pairs.sparkSession.read.parquet(path)
    k0, k1 = F.col("k0"), F.col("k1")
    t = words.agg(
        F.sum("k0").alias("K0"), F.sum("k1").alias("K1"), F.sum("k").alias("K"), F.count_if(F.col("k") > 0).alias("V"),
        F.sum(F.least(k0, big)).alias("M0"), F.sum(F.least(k1, big)).alias("M1"),
    ).first()
    if not t.K0 or not t.K1:
        return None
    base = float(np.log(t.M1 / t.K1) - np.log(t.M0 / t.K0))  # what a rare word differs by, which says nothing
    shared = (F.greatest(F.col("k") - SHARED_DISCOUNT, F.lit(0.0)) + SHARED_DISCOUNT * t.V / (t.V + 1)) / float(t.K)
    p0 = (above(k0) + float(t.M0) * shared) / float(t.K0)
    p1 = (above(k1) + float(t.M1) * shared) / float(t.K1)

    def left(n: str, m: str) -> Column:
        return F.when(F.col(n) > 0, F.col(m) / F.col(n)).otherwise(1.0)

    words = words.select(
        "key", p0.alias("p0"), p1.alias("p1"), (F.log(p1 / p0) - base).alias("here"),
        (F.log(left("n1", "m1")) - F.log(left("n0", "m0"))).alias("next"),
        F.col("n0").alias("h0"), F.col("n1").alias("h1"), "m0", "m1", "m", "k",
    )
    after = words.select(F.col("key").alias("w"), "p0", "p1", F.col("here").alias("w_here"))
    before = words.select(F.col("key").alias("h"), "h0", "h1", "m0", "m1", "m", F.col("next").alias("h_next"))
    often = pairs.where(n0 + n1 > big).join(before, "h").join(after, "w")

    def whole(n: str, total: str, mass: str, p: str) -> Column:
        q = (above(n0 + n1) + F.col("m") * F.col(p)) / (F.col("h0") + F.col("h1"))
        return F.when(F.col(total) > 0, (above(F.col(n)) + F.col(mass) * q) / F.col(total)).otherwise(q)

    more = F.log(whole("n1", "h1", "m1", "p1") / whole("n0", "h0", "m0", "p0")) - base - F.col("w_here") - F.col("h_next")
    often = often.select(F.col("pair").alias("key"), more.alias("here"), F.lit(0.0).alias("next"), (n0 + n1).alias("weight"))
    single = words.select("key", "here", "next", (F.col("h0") + F.col("h1") + F.col("k")).cast("long").alias("weight"))
    entries = single.unionByName(often)
    return settle(entries.where("abs(here) > 1e-9 or abs(next) > 1e-9"))


@dataclass(frozen=True)
class Model:
    """``entries`` is the whole model; the arrays are what the tasks get of it."""

    entries: DataFrame
    held: np.ndarray  # keys of the model
    keys: np.ndarray  # the most frequent ones, in order
    here: np.ndarray
    next: np.ndarray


def fit(taught: DataFrame, *, discount: int = DISCOUNT, frequent: int = FREQUENT) -> Model | None:
    """The model of rows ``text`` and ``side`` (1: toxic); none if a side has no words."""
    spark = taught.sparkSession
    path = folder(spark, "toxicity-expressions")
    _expressions(taught).write.parquet(path)
    entries = _entries(spark.read.parquet(path), discount)
    if entries is None:
        return None
    top = entries.orderBy(F.desc("weight"), "key").limit(frequent).toArrow()
    keys = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    here, after = (top[c].to_numpy()[order].astype(np.float32) for c in ("here", "next"))
    return Model(entries, Sieve.of(entries.select("key")).words, keys[order], here, after)


# ---------------------------------------------------------------------------------------------
# scores


class _Lookup:
    def __init__(self, model: tuple):
        held, self.keys, self.here, self.next = model
        self.held = Sieve(held)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``here``, ``next`` and whether the key must be looked up in the table."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        there = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        pick = (lambda a: np.where(there, a[at], 0)) if len(self.keys) else (lambda a: np.zeros(len(keys)))
        return pick(self.here), pick(self.next), self.held.has(keys) & ~there


def most_toxic(values: np.ndarray, sizes: np.ndarray, starts: np.ndarray, passage: int = PASSAGE) -> np.ndarray:
    """The greatest mean over a passage of each text; words missing from a passage count as 0."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    out = (sums[starts + sizes] - sums[starts]) / passage
    long = np.flatnonzero(sizes >= passage)
    if len(long):
        run = np.full(len(values), -np.inf)
        run[: len(values) - passage + 1] = (sums[passage:] - sums[:-passage]) / passage
        # passages that reach over a text's end are none
        ends = (starts + sizes)[sizes > 0]
        for back in range(1, passage):
            run[np.maximum(ends - back, 0)] = -np.inf
        full = sizes > 0
        best = np.maximum.reduceat(run, starts[full])
        spread = np.zeros(len(sizes))
        spread[full] = best
        out[long] = spread[long]
    return out


def _differences(docs: DataFrame, model, passage: int) -> DataFrame:
    """``row``, ``id`` and ``s``; with ``values``, ``at`` and ``keys`` where the table must be asked first."""

    def read(batches):
        lookup = _Lookup(model.value)
        for part in chunks(batches, "text", CHUNK_BYTES):
            words = Keyed(strings(part.column("text")))
            codes, n = words.codes, len(words.codes)
            here, after, ask = lookup.find(words.units)
            start_next, start_ask = lookup.find(np.array([START]))[1:]
            w = words.units[codes]
            values = here[codes].astype(np.float64)
            filled = words.sizes > 0
            next_here = np.concatenate([[0.0], after[codes][:-1]]) if n else np.zeros(0)
            next_here[words.starts[filled]] = start_next[0]
            values += next_here
            pairs = pair_keys(words.before(w), w)
            maybe = np.flatnonzero(lookup.held.has(pairs)) if n else np.zeros(0, np.int64)
            more, _, pair_ask = lookup.find(pairs[maybe])
            values[maybe] += more
            # a request is a place and a key; a word is asked for at its own place
            own = np.flatnonzero(ask[codes]) if n else np.zeros(0, np.int64)
            ats, keys = [own, maybe[pair_ask]], [w[own], pairs[maybe[pair_ask]]]
            if start_ask[0]:
                ats.append(words.starts[filled] - 1)
                keys.append(np.full(int(filled.sum()), START))
            owner = np.repeat(np.arange(len(words.sizes)), words.sizes)
            owners = [owner[own], owner[maybe[pair_ask]]] + ([np.flatnonzero(filled)] if start_ask[0] else [])
            at, key, who = np.concatenate(ats), np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(who, kind="stable")
            at, key, who = at[order] - words.starts[who[order]], key[order], who[order]
            counts = np.bincount(who, minlength=len(words.sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            kept = [
                values[b : b + size].astype(np.float32).tobytes() if c else None
                for b, size, c in zip(words.starts.tolist(), words.sizes.tolist(), counts.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), pa.array(most_toxic(values, words.sizes, words.starts, passage)),
                 pa.array([None if k is None else pa.compress(k, "lz4", asbytes=True) for k in kept], pa.binary()),
                 pa.array(words.sizes),
                 pa.ListArray.from_arrays(offsets, pa.array(at.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(key.view(np.int64)))],
                ["row", "id", "s", "packed", "size", "at", "keys"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        read, f"row long, id {kind}, s double, packed binary, size long, at array<int>, keys array<long>"
    )


def differences(docs: DataFrame, model: Model | None, *, key: str = "doc_id", text: str = "text", passage: int = PASSAGE) -> DataFrame:
    """``id`` and ``s`` of every row: by how much its most toxic passage is likelier as toxic, per word."""
    if model is None:
        return docs.select(col(key).alias("id"), F.lit(0.0).alias("s"))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((model.held, model.keys, model.here, model.next))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(key).alias("id"), col(text).cast("string").alias("text"))
    path = folder(spark, "toxicity-scores")
    _differences(rows, sent, passage).write.parquet(path)
    read = spark.read.parquet(path)
    asked = read.where("packed is not null").select("row", F.explode(F.arrays_zip("at", "keys")).alias("x"))
    told = (
        asked.select("row", F.col("x.at").alias("at"), F.col("x.keys").alias("key"))
        .join(model.entries.select("key", "here", "next"), "key")
        .groupBy("row")
        .agg(F.collect_list(F.struct("at", "here", "next")).alias("told"))  # at most twice a text's words
    )
    waiting = read.where("packed is not null").select("row", "id", "packed", "size").join(told, "row", "left")

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packed, size, told in zip(*[batch.column(c).to_pylist() for c in ("packed", "size", "told")], strict=True):
                values = np.frombuffer(pa.decompress(packed, 4 * size, "lz4", asbytes=True), np.float32).astype(np.float64)
                for x in told or ():
                    if x["at"] >= 0:
                        values[x["at"]] += x["here"]
                    if x["at"] + 1 < size:
                        values[x["at"] + 1] += x["next"]
                out.append(most_toxic(values, np.array([size]), np.array([0]), passage)[0])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.float64())], ["id", "s"])

    kind = read.schema["id"].dataType.simpleString()
    done = read.where("packed is null").select("id", "s")
    return done.unionByName(waiting.select("id", "packed", "size", "told").mapInArrow(finish, f"id {kind}, s double"))


def rising(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """The never falling shares nearest to the given ones, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for n, p in zip(counts.tolist(), positives.tolist(), strict=True):
        blocks.append([p, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, n, m = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p, blocks[-1][1] + n, blocks[-1][2] + m]
    share = positives.sum() / counts.sum()
    return np.concatenate([np.full(int(m), (p + share) / (n + 1)) for p, n, m in blocks])


def chances(told: DataFrame, prior: float, passage: int = PASSAGE) -> Callable[[Column], Column]:
    """The chance of label 1 for a difference, fitted on rows ``s`` and ``side``."""
    least, most = LOWEST * STEPS, HIGHEST * STEPS
    place = F.greatest(F.least(F.floor(F.col("s") * STEPS), F.lit(most)), F.lit(least))
    found = told.groupBy(place.cast("int").alias("place")).agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("p"))
    bins = sorted((r.place, r.n, r.p) for r in found.collect())  # as many rows as there are steps
    grid = np.arange(least, most + 2)
    if 0 < sum(b[2] for b in bins) < sum(b[1] for b in bins):
        at, n, p = (np.array(c) for c in zip(*bins, strict=True))
        table = np.interp(grid, at + 0.5, rising(n, p))
    elif 0 < prior < 1:
        table = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + grid / STEPS * passage)))
    else:
        table = np.full(len(grid), prior)
    steps = F.array(*[F.lit(float(x)) for x in table])

    def chance(s: Column) -> Column:
        x = F.greatest(F.least(s * STEPS, F.lit(float(most))), F.lit(float(least))) - least
        below = F.floor(x).cast("int")
        low, high = F.get(steps, below), F.get(steps, below + 1)
        return low + (high - low) * (x - below)

    return chance


# ---------------------------------------------------------------------------------------------
# whole


def _crc(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary"))


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text is 1 modulo 3."""
    return F.coalesce(_crc(key) % 3 == 1, F.lit(False))


def _taught(docs: DataFrame, marks: DataFrame, key: str, text: str) -> DataFrame:
    """``text`` and ``side`` of the rows that have a label (``__id``, ``side``), in a table of its own."""
    spark = docs.sparkSession
    sieve = spark.sparkContext.broadcast(Sieve.of(marks.select(F.xxhash64("__id"))).words)

    @F.pandas_udf("boolean")
    def perhaps(ids: pd.Series) -> pd.Series:
        return pd.Series(Sieve(sieve.value).has(ids.to_numpy(np.int64).view(np.uint64)))

    rows = docs.select(col(key).alias("id"), col(text).cast("string").alias("text")).where(F.col("id").isNotNull())
    rows = rows.where(perhaps(F.xxhash64(F.col("id").cast(marks.schema["__id"].dataType))))
    path = folder(spark, "toxicity-taught")
    rows.join(marks, F.col("id") == F.col("__id")).select("text", "side").write.parquet(path)
    return spark.read.parquet(path)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: Callable[[Column], Column] | None = None,
    threshold: float = 0.7,
    **fitting,
) -> DataFrame:
    """``key``, ``score`` and ``predicted`` of each row of ``docs``, by models of those with a label.

    ``rows`` of the key says which labels may teach; a fourth of those fits the chances.
    """
    marks = labels.where(col(key).isNotNull() & col(label).isNotNull())
    if rows is not None:
        marks = marks.where(rows(col(key)))
    marks = marks.groupBy(col(key).alias("__id")).agg((F.max(col(label)) >= 1).cast("int").alias("side"))
    # A table has a known size: while it is small it goes to the texts, then the texts are shuffled to it.
    path = folder(docs.sparkSession, "toxicity-marks")
    marks.withColumn("tells", F.floor(_crc(F.col("__id")) / 3) % 4 == 1).write.parquet(path)
    marks = docs.sparkSession.read.parquet(path)
    n, toxic = marks.agg(F.count(F.lit(1)), F.sum("side")).first()
    prior = toxic / n if n else 0.0
    model = fit(_taught(docs, marks.where(~F.col("tells")), key, text), **fitting) if 0 < prior < 1 else None
    found = settle(differences(docs, model, key=key, text=text))
    told = found.join(marks.where("tells"), F.col("id") == F.col("__id")).select("s", "side")
    chance = chances(told, prior)
    scored = found.select(F.col("id").alias(key), chance(F.col("s")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
