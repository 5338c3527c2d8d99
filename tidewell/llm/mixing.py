"""Mixing sources to target weights.

Each source's words, in a fixed order of its documents, form one stream that is cut into blocks
of a fixed length (the last may be short). A source's target gives it a number of slots. How many
of them each output shard holds is drawn: every slot picks a shard pseudorandomly, and the picks
are counted, so a source's counts over the shards are multinomial and add up to its slots. The
prefix sums of these counts number the slots: a shard holds consecutive slots of a source, mixed
with those of the others by a pseudorandom place. Slot number q stands for the block that a
pseudorandom permutation of the source's block numbers gives (a new one for each pass over the
source). Blocks meet documents by block number. A pass comes to its end before the next begins,
so no shard repeats what an earlier pass has not given yet; the last slot is cut at the target, so
a source gets its target to the word and a document is taken at most once a pass.

The permutation is a swap-or-not shuffle: a round pairs each number x with (k - x) mod n, and
swaps the two or doesn't by a hash of the greater one. It needs no table, and any task can work
out any slot.

Only DataFrame functions are used. Rows alike in id, source and size are counted before they are
ordered, so that any number of them is one row there. Prefix sums are taken in two steps, within
hashed buckets and over the buckets' totals, so a source that holds most rows is spread over many
tasks. The table of sources is the only one sorted as a whole.

Defined results: a null or empty text has size 0 and nothing is taken of it; null is a source of
its own, the last one; an empty table gives no rows; repeated rows are mixed row by row; the mix
depends on ids, sources and sizes alone, not on how the table is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import col, free_name, settle, text_of, words

BLOCK = 2048
SHARD_BLOCKS = 1024
BUCKET_ROWS = 8192
ROUNDS = 24
#: Slots, or rows alike, that one task makes at a time.
CHUNK = 1 << 16
#: Shards whose counts are summed in one window.
SHARD_GROUP = 4096
#: Numbers below zero over which documents without a block are spread.
NO_BLOCK = 1 << 20


def sources(sized: DataFrame, *, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``number``, ``source``, ``source_size``, ``weight``, ``target``.

    Weights repeat over the sources by code point, null last; together the targets are ``share``
    of all sizes, none is over ``most`` times its source's size, and what is over goes to the
    others by weight. That fixed point is the least of limit and weight times one level, and the
    level is found by going through the sources by limit over weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    each = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name))
        .withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") - 1) % len(weights)))
        .withColumn("limit", F.col("source_size") * F.lit(float(most)))
    )
    whole = Window.partitionBy(F.lit(0))
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("limit") / F.col("weight"), "number")
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(
        F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    level = left / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    levelled = each.withColumn("level", level).withColumn(
        "common", F.max(F.when(F.col("limit") > F.col("weight") * F.col("level"), F.col("level"))).over(whole)
    )
    target = F.coalesce(F.least(F.col("limit"), F.col("weight") * F.col("common")), F.col("limit"))
    return levelled.select("number", "source", "source_size", "weight", target.alias("target"))


def permuted(x: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """Where a pseudorandom permutation of 0 .. n-1, one for each key, puts ``x``."""

    def swap(x: Column, i: Column) -> Column:
        partner = F.pmod(F.xxhash64(*key, i) - x, n)
        greater = F.greatest(x, partner)
        return F.when(F.xxhash64(*key, i, greater).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, swap)


def _numbers(rows: DataFrame, count: str, name: str) -> DataFrame:
    """``rows`` once for each of 0 .. ``count`` - 1, as ``name``; a great count is dealt to several tasks."""
    count = col(count)
    parts = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((count - 1) / CHUNK))).alias("chunk"))
    first = F.col("chunk") * CHUNK
    each = F.explode(F.sequence(first, F.least(first + CHUNK, count) - 1)).alias(name)
    return parts.repartition(*parts.columns).select("*", each).drop("chunk")


def slot_plan(each: DataFrame, *, block: int) -> DataFrame:
    """``each`` source of which words are taken, with ``taken``, its ``blocks``, the ``full`` ones, and ``n_slots``."""
    size, taken = F.col("source_size"), F.floor("target")
    passes = F.floor(taken / size)
    blocks = F.ceil(size / block)
    last = F.least(F.ceil((taken - passes * size) / block), blocks)
    return each.where(taken > 0).select(
        "number", "source", "source_size", taken.alias("taken"), F.floor(size / block).alias("full"), blocks.alias("blocks"),
        (passes * blocks + last).alias("n_slots"),
    )


def shard_counts(plan: DataFrame, *, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """``plan`` with a row per ``shard`` that holds slots of the source: how many (``drawn``), and the number of the ``first``.

    The counts of a source are one multinomial draw of its slots over equally likely shards.
    """
    # the table of sources has few rows; one number
    shards = F.greatest(F.ceil(plan.agg(F.sum("n_slots")).scalar() / shard_blocks), F.lit(1))
    pick = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "source", "draw"), shards)
    draws = _numbers(plan.select("number", "source", "n_slots"), "n_slots", "draw")
    counts = draws.select("number", pick.alias("shard")).groupBy("number", "shard").agg(F.count(F.lit(1)).alias("drawn"))
    counts = counts.withColumn("group", F.floor(F.col("shard") / SHARD_GROUP))
    earlier = Window.partitionBy("number", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    groups = Window.partitionBy("number").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("number", "group").agg(F.sum("drawn").alias("all"))
        .select("number", "group", F.coalesce(F.sum("all").over(groups), F.lit(0)).alias("offset"))
    )
    first = F.col("offset") + F.coalesce(F.sum("drawn").over(earlier), F.lit(0))
    return counts.join(offsets, ["number", "group"]).withColumn("first", first).drop("group", "offset").join(plan, "number")


def slots(each: DataFrame, *, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 0) -> DataFrame:
    """The mix: ``shard``, ``place`` (order in it), ``number`` of the source, ``slot``, ``pass``, ``block``, ``n`` words."""
    counts = shard_counts(slot_plan(each, block=block), shard_blocks=shard_blocks, seed=seed)
    numbered = _numbers(counts, "drawn", "slot").withColumn("slot", F.col("first") + F.col("slot"))
    size = F.col("source_size")
    rank = F.col("slot") % F.col("blocks")
    turn = F.floor(F.col("slot") / F.col("blocks"))
    before = turn * size + F.least(rank, F.col("full")) * block
    drawn = permuted(rank, F.col("full"), F.lit(seed), F.col("source"), turn)
    return numbered.select(
        "shard",
        F.xxhash64(F.lit(seed), F.lit("place"), "source", "slot").alias("place"),
        "number",
        "slot",
        turn.alias("pass"),
        F.when(rank < F.col("full"), drawn).otherwise(F.col("full")).alias("block"),
        F.least(F.lit(block), size - F.least(rank, F.col("full")) * block, F.col("taken") - before).alias("n"),
    )


def _streams(sized: DataFrame, each: DataFrame) -> DataFrame:
    """``sized`` with its source's columns and ``start``, the words of the source before the row.

    ``key``, ``source``, ``size`` and ``nth`` (from 0, of rows alike) name a row.
    """
    alike = sized.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    rows = alike.join(each.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    buckets = F.greatest(F.ceil(sized.agg(F.count(F.lit(1))).scalar() / BUCKET_ROWS), F.lit(1))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "size"), buckets)).withColumn("words", F.col("size") * F.col("copies"))
    earlier = (
        Window.partitionBy("number", "bucket").orderBy(F.col("key").asc_nulls_first(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    over = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy("number", "bucket").agg(F.sum("words").alias("n"))
        .select("number", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("offset"))
    )
    local = rows.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    placed = local.join(totals, ["number", "bucket"]).withColumn("start", F.col("start") + F.col("offset"))
    single = _numbers(placed.drop("offset", "bucket", "words"), "copies", "nth")
    return single.withColumn("start", F.col("start") + F.col("nth") * F.col("size")).drop("copies")


def _taken(sized: DataFrame, *, block: int, shard_blocks: int, seed: int, **shares) -> DataFrame:
    """Each part of a document that a slot takes; documents of which none is taken, once, with nulls."""
    each = settle(sources(sized, **shares))
    rows = _streams(sized, each)
    end = F.col("start") + F.col("size")
    # what has no words meets no slot
    none = F.array(-1 - F.pmod(F.xxhash64("key", "nth"), F.lit(NO_BLOCK)))
    parts = rows.select(
        "*",
        F.explode(
            F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))).otherwise(none)
        ).alias("block"),
    )
    at = F.greatest(F.col("start"), F.col("block") * block)
    parts = parts.withColumn("from", at - F.col("block") * block).withColumn(
        "length", F.least(end, (F.col("block") + 1) * block) - at
    ).withColumn("in_document", at - F.col("start"))
    made = slots(each, block=block, shard_blocks=shard_blocks, seed=seed)
    # The slots grow with the corpus, but are estimated by the table of sources they come from.
    met = parts.join(made.hint("merge"), ["number", "block"], "left")
    return met.withColumn("got", F.greatest(F.least(F.coalesce("n", F.lit(0)) - F.col("from"), F.col("length")), F.lit(0)))


def sizes(docs: DataFrame, *, key: str, source: str, text: str) -> DataFrame:
    """``key``, ``source``, ``size`` (words of the whole text); settled, since it is read often."""
    return settle(
        docs.select(
            col(key).alias("key"), col(source).alias("source"), F.size(words(text_of(text))).cast("bigint").alias("size")
        )
    )


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 0,
    **shares,
) -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target`` and ``taken`` of every row of ``docs``.

    ``first_shard`` and ``last_shard`` are the least and greatest output shard that holds words of it, or null.
    """
    sized = sizes(docs, key=key, source=source, text=text)
    parts = _taken(sized, block=block, shard_blocks=shard_blocks, seed=seed, **shares)
    shard = F.when(F.col("got") > 0, F.col("shard"))
    each = parts.groupBy("number", "key", "size", "nth", "source_size", "target").agg(
        F.sum("got").alias("taken"), F.min(shard).alias("first_shard"), F.max(shard).alias("last_shard")
    )
    return each.select(F.col("key").alias(key), "size", "source_size", "target", "taken", "first_shard", "last_shard")


def mixed_parts(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 0,
    **shares,
) -> DataFrame:
    """The mix as it is dealt to output shards: a row per part of a document that a slot holds.

    ``shard``, ``place`` and ``at`` order the parts of a shard (``at``: where the part stands in its
    block); ``key``, ``source``, ``size`` and ``nth`` (of rows alike in these, from 0) name the
    document, ``first_word`` and ``n_words`` the part, ``pass`` the pass over the source.
    """
    sized = sizes(docs, key=key, source=source, text=text)
    parts = _taken(sized, block=block, shard_blocks=shard_blocks, seed=seed, **shares).where("got > 0")
    return parts.select(
        "shard", "place", F.col("from").alias("at"), F.col("key").alias(key), F.col("source").alias(source), "size", "nth",
        F.col("in_document").alias("first_word"), F.col("got").alias("n_words"), "pass",
    )


def mixed_documents(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    n_chars: str = "n_chars",
    block: int = BLOCK,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = 0,
    **shares,
) -> DataFrame:
    """The mix as documents: a row for each pass that takes words of a document, with its columns.

    A document that is taken whole keeps its text; else the text is the words that are taken,
    joined by blanks. A column ``n_chars`` is brought up to date.
    """
    sized = sizes(docs, key=key, source=source, text=text)
    parts = _taken(sized, block=block, shard_blocks=shard_blocks, seed=seed, **shares).where("got > 0")
    piece = F.struct(F.col("in_document").alias("at"), F.col("got").alias("n"))
    # no more pieces than a document has blocks, and no more turns than passes
    each = parts.groupBy("key", "source", "size", "nth", "pass").agg(
        F.sum("got").alias("got"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    turns = each.groupBy("key", "source", "size", "nth").agg(F.collect_list(F.struct("pass", "got", "pieces")).alias("__turns"))
    turns = turns.select(*[F.col(c).alias(f"__{c}") for c in ("key", "source", "size", "nth")], "__turns")
    size, nth, turn = free_name(docs, "size_"), free_name(docs, "nth_"), free_name(docs, "turn_")
    body = text_of(text)
    known = docs.withColumn(size, F.size(words(body)).cast("bigint"))
    # rows alike in id, source and size are told apart by their number
    alike = Window.partitionBy(col(key), col(source), col(size)).orderBy(*[col(c).asc_nulls_first() for c in docs.columns])
    met = known.withColumn(nth, (F.row_number().over(alike) - 1).cast("bigint")).join(
        turns,
        col(key).eqNullSafe(F.col("__key"))
        & col(source).eqNullSafe(F.col("__source"))
        & (col(size) == F.col("__size"))
        & (col(nth) == F.col("__nth")),
    )
    own = met.withColumn(turn, F.explode("__turns"))
    some = F.array_join(
        F.flatten(F.transform(col(turn)["pieces"], lambda p: F.slice(words(body), (p["at"] + 1).cast("int"), p["n"].cast("int")))), " "
    )
    out = {c: col(c) for c in docs.columns}
    out[text] = F.when(col(turn)["got"] == col(size), body).otherwise(some)
    final = own.select(*[c.alias(n) for n, c in out.items()])
    if n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        final = final.withColumn(n_chars, F.char_length(col(text)).cast(kind))
    return final
