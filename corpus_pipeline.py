"""From raw documents to tokens: quality rules, classifier, near duplicates, source mix, coding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import discriminant, mixing, pieces, rules, simhash
from tidewell.llm.base import folder, share_code, table

#: What the rules and the classifier learn, what the draws give, and the coding are beyond SQL.
ORACLE_SQL: str | None = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor a learned rule rejects."""
    share_code(spark)
    return rules.keep_documents(docs, docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be good by a model of all labelled documents, rejected ones included."""
    share_code(spark)
    taught = table(spark, sf_dir, "documents", "doc_id", "text")
    model = discriminant.fit(taught, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return discriminant.keep_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near duplicates."""
    share_code(spark)
    return simhash.keep_first(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a mix of the sources takes, once for each pass that takes of them."""
    share_code(spark)
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, with the digests of ids and decoded text."""
    share_code(spark)
    coded = pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.digests(coded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents", "*")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        path = folder(spark, f"pipeline-{i}-{name}")
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
