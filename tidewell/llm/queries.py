"""One query per operator over the whole given tables, with its SQL where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, discriminant, licences, mixing, pieces, repair, rules, simhash, token_counts, token_files, topk, toxicity, whitening
from .base import folder, share_code, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            share_code(spark)
            return build(spark, sf_dir)

        QUERIES[name] = functools.wraps(build)(run)
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@register("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules are learned, so SQL cannot state ``kept``; counts and base rule are tested by brute force."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return rules.quality_rules(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against the library's own counts."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@register("op8_sentencepiece")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against the library's ids and decoded texts."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pieces.digests(pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")))


@register("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against the library's own ids."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    files = folder(spark, "token-files")
    token_files.write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), files, end_id=1)
    return token_files.read_token_files(spark, files, ids=False)


@register("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores are learned; tested by accuracy on the rows held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    out = discriminant.classify(docs, labels, rows=lambda key: ~discriminant.held_out(key))
    return out.select("doc_id", discriminant.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@register("op6_simhash_golay")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against all pairs by brute force."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def _licence_sql() -> str:
    """Every phrase looked for at every word."""

    def places(phrase: str) -> str:
        words = phrase.split()
        test = " and ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words))
        return f"list_filter(range(0, len(w) - {len(words) - 1}), lambda i: {test})"

    def share(wording: str, phrase: str) -> str:
        body, must = wording.split(), phrase.split()
        ahead = next(i for i in range(len(body)) if body[i : i + len(must)] == must)
        hits = " + ".join(
            f"(case when i + {k - ahead} >= 0 and w[i + {k - ahead + 1}] = '{x}' then 1 else 0 end)" for k, x in enumerate(body)
        )
        return f"list_max(list_transform({places(phrase)}, lambda i: ({hits}) / {len(body)}.0::double))"

    base = ", ".join(f"list_transform({places(p)}, lambda i: {{'at': i, 'label': '{label}'}})" for p, label in licences.BASE)
    more = ", ".join(f"case when len({places(p)}) > 0 then '{label}' end" for label, _, p in licences.TEMPLATES)
    best = ", ".join(share(wording, p) for _, wording, p in licences.TEMPLATES)
    return rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licences.CAPITALS}', '{licences.SMALL}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
s as (select doc_id, len(w) as n, flatten([{base}]) as b, [{more}] as m, list_max([{best}]) as best from d)
select doc_id, cast(n as bigint) as n_words, cast(len(b) as bigint) as n_base,
  list_min(list_transform(b, lambda x: x.at)) as first_word, list_max(list_transform(b, lambda x: x.at)) as last_word,
  array_to_string(list_sort(list_distinct(list_transform(b, lambda x: x.label))), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(b, lambda x: x.label), m))), ',') as labels,
  coalesce(best, 0.0) as score
from s
"""


@register("op10_licence_scan", _licence_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op9_source_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The draws are pseudorandom; tested against the same mix worked out word by word."""
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


PROBE = "</s>[INST] ok [/INST]"
CHAT_SQL = rf"""
with given as (
  select conv_id as conv, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{PROBE}' union all select -1, 1, 'assistant', '{PROBE}'
),
counted as (
  select *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {chat.MARKS} as tokens,
    row_number() over (partition by conv order by turn nulls first, role, md5(text)) as ord
  from given
),
summed as (
  select *, sum(tokens) over (partition by conv order by ord) as until,
    min(case when role = 'system' then ord end) over (partition by conv) as s_ord
  from counted
),
stepped as (
  select *, until - tokens as since, greatest(({chat.BUDGET} - {chat.HISTORY}
      - coalesce(max(case when ord = s_ord then tokens end) over (partition by conv), 0)) // 2, {chat.LEAST_STEP}) as step
  from summed
),
line as (
  select *, (since // step) * 2 + case when tokens > step then 1 else 0 end as w,
    length('<s>[INST][/INST]</s>')
      + length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g'))
      + length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) as chars
  from stepped
),
opened as (select conv, w, min(ord) as first_ord, min(since) as begins, any_value(s_ord) as s_ord from line group by all),
members as (
  select conv, chars from line
  union all
  select o.conv, l.chars from opened o join line l on l.conv is not distinct from o.conv
    and l.until <= o.begins and l.since >= o.begins - {chat.HISTORY} and l.ord is distinct from o.s_ord
  union all
  select o.conv, l.chars from opened o join line l on l.conv is not distinct from o.conv and l.ord = o.s_ord and o.s_ord < o.first_ord
),
sized as (select conv, sum(chars) as formatted_chars from members group by conv),
said as (
  select conv, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by ord)) as turns_sha256,
    coalesce(string_agg(text, '' order by ord) filter (role = 'assistant'), '') as targets
  from line group by conv
)
select a.conv as conv_id, cast(n_turns as bigint) as n_turns, turns_sha256, cast(length(targets) as bigint) as loss_chars,
  sha256(targets) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from said a join sized b on a.conv is not distinct from b.conv
"""


@register("op7_chat_windows", CHAT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], given.schema)
    return chat.read_back(chat.windows(given.unionByName(probe)))


TOPK_SQL = """
with given as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from given q join given c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""


@register("op3_sorted_list_topk", TOPK_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 50 == 0)


@register("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest edits with their ties are found by a program over states; tested against every edit string."""
    return repair.repair_damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tested against the eigenvectors of the covariance."""
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding")))


@register("op11_toxicity")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores are learned; the model is tested against plain Python, the scores on the rows held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    out = toxicity.classify(docs, labels, rows=lambda key: ~toxicity.held_out(key))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
