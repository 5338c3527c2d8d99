"""Small documents with the awkward cases, and plain forms of what the operators count."""

import re

from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD = [
    None, "", " ", "\n\n", "a", " a", "a ", "a  b", "   ", "\t x\r\n", "x's Y'S don't <|endoftext|> z<|startoftext|>",
    "日本 語 テスト です", "a b", "é è́ ÀÉ ß×÷ İI ſ K", "it's 1234 567-8 can't", "\x01 a\x01", "a▁b ▁▁ c", "\x00x",
    "😀 👍🏽", "½ ² ªx", "a\x1cb \x1d", "x" * 3000, "ab " * 4000, "same text twice", "same text twice",
    "GNU General Public License v 2", "CC BY cc by", "İ MIT\nLicense x", "</s>[INST] <s> [\\/INST] <\\s>",
]


def odd_documents(spark, extra=True):
    """:data:`ODD` as documents, with a null id, a repeated row, and columns whose names clash."""
    rows = [(i, t, f"src{i % 3}" if i % 4 else None) for i, t in enumerate(ODD)] + [(None, "no id", "src1"), (3, ODD[3], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    if not extra:
        return docs
    for name in ("key", "fp", "size", "n_words", "kept", "id", "row", "score", "start", "number", "block", "w", "turns"):
        docs = docs.withColumn(name, F.lit(7))
    return docs


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, n_chars long")


def words(text):
    return WORD.findall(text or "")


def small(spark, name, *columns):
    return spark.read.parquet(f"{SMALL}/{name}.parquet").select(*columns or "*")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
