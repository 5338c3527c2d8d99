"""Licence scans with a positional index of rare words.

Licence templates are indexed by word: which template, at which place. A text's licence words are
taken with their positions. For each template the file's two mandatory words of the highest
inverse document frequency (over all given documents) are looked up; where both point to the same
start, the template may stand there. A start counts if every mandatory word stands at its place
there, and its strength is the share of all the template's words that do. Mandatory words are
part of every accepted place, so looking up only the rarest of them loses none.

Only DataFrame functions are used. Texts are read once; what goes on is the list of licence words
of the few texts that hold any, keyed by row. Function words are listed only near a licence
word. The templates and their postings are fixed and small, so they are broadcast.

Defined results: a null text counts as empty (0 words, no labels, empty label lists, null
positions, score 0); an empty table gives no rows; repeated rows and null ids are kept row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import col, let, settle, text_of

# Phrases whose places are counted, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, wording of the notice, mandatory phrase in it.
TEMPLATES = (
    ("gpl", "gnu general public license", "gnu general public license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license", "apache license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("epl", "eclipse public license", "eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd", "cc by nd"),
    ("cc-by-nc-sa", "licensed under cc by nc sa", "cc by nc sa"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)

# Words too common to be looked up by themselves.
FUNCTION_WORDS = (
    "a", "all", "and", "any", "are", "by", "for", "free", "in", "into", "is", "of", "or", "the", "this", "to",
    "under", "use", "with", "without", "0", "1", "2", "3", "4", "v", "copy", "person", "source", "terms",
)

#: No template has a function word further than this from one that is looked up.
REACH = 4

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that part words once A-Z are lower-cased.
PARTING = "".join(chr(c) for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A))


def licence_words(text: Column) -> Column:
    """Words of digits, lower-cased letters and all characters beyond ASCII."""
    plain = F.translate(text, CAPITALS + PARTING, SMALL + " " * len(PARTING))
    return F.array_remove(F.split(plain, " "), "")


def _postings(spark) -> DataFrame:
    """``word``, ``template``, ``label``, ``place``, ``mandatory``, ``n_words``, ``n_mandatory``."""
    rows = []
    for t, (label, wording, phrase) in enumerate(TEMPLATES):
        body, must = wording.split(), phrase.split()
        first = next(i for i in range(len(body)) if body[i : i + len(must)] == must)
        for place, word in enumerate(body):
            inside = first <= place < first + len(must)
            rows.append((word, t, label, place, inside, len(body), len(must)))
    return spark.createDataFrame(
        rows, "word string, template int, label string, place int, mandatory boolean, n_words int, n_mandatory int"
    )


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _scan(w: Column) -> Column:
    """Number of words, places of base phrases, and licence words with their places."""
    rare = sorted({x for _, wording, _ in TEMPLATES for x in wording.split()} - set(FUNCTION_WORDS))

    def stands(phrase: str, i: Column) -> Column:
        out = F.lit(True)
        for k, word in enumerate(phrase.split()):
            out = out & (F.get(w, i + k) == word)
        return out

    def base_at(x: Column, i: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in BASE:
            label = F.when((x == phrase.split()[0]) & stands(phrase, i), name).otherwise(label)
        return F.struct(i.alias("at"), label.alias("label"))

    places = F.filter(F.transform(w, base_at), lambda b: b["label"].isNotNull())

    def near(i: Column) -> Column:
        out = F.lit(False)
        for k in range(1, REACH + 1):
            out = out | F.coalesce(F.get(w, i - k).isin(rare), F.lit(False)) | F.coalesce(F.get(w, i + k).isin(rare), F.lit(False))
        return out

    found = F.filter(
        F.transform(w, lambda x, i: F.struct(i.alias("at"), F.when(x.isin(rare) | (x.isin(*FUNCTION_WORDS) & near(i)), x).alias("word"))),
        lambda o: o["word"].isNotNull(),
    )
    # Most texts hold no licence word at all; for them nothing is made per word.
    none_at, none_found = "array<struct<at:int,label:string>>", "array<struct<at:int,word:string>>"
    return F.struct(
        F.size(w).cast("bigint").alias("n"),
        F.when(F.arrays_overlap(w, _array(p.split()[0] for p, _ in BASE)), places).otherwise(F.array().cast(none_at)).alias("base"),
        F.when(F.arrays_overlap(w, _array(rare)), found).otherwise(F.array().cast(none_found)).alias("found"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, labels and score of every whole text, one row for each row of ``docs``."""
    scanned = docs.select(
        F.monotonically_increasing_id().alias("row"),
        col(key).alias("__key"),
        let(licence_words(text_of(text)), _scan).alias("s"),
    )
    rows = settle(scanned.select("row", "__key", "s.n", "s.base", "s.found"))
    with_words = rows.where(F.size("found") > 0)
    postings = F.broadcast(_postings(docs.sparkSession))
    n_docs = rows.agg(F.count(F.lit(1)).cast("double")).scalar()

    held = with_words.select("row", F.explode(F.array_distinct(F.col("found.word"))).alias("word"))
    # one row for each word of the templates
    idf = (
        held.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
        .select("word", F.log((1 + n_docs) / (1 + F.col("df"))).alias("idf"))
    )
    # The two rarest mandatory words a file has of each template, if it has all of them.
    must = postings.where("mandatory").select("word", "template", "n_mandatory").distinct()
    distinct_words = must.groupBy("template").agg(F.count(F.lit(1)).alias("n_distinct"))
    anchors = (
        held.join(F.broadcast(idf), "word")
        .join(F.broadcast(must), "word")
        .groupBy("row", "template")
        # as many words as the mandatory phrase has, at most
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("idf")).alias("rare"), "word"))).alias("words"))
        .join(F.broadcast(distinct_words), "template")
        .where(F.size("words") == F.col("n_distinct"))
        .select("row", "template", F.col("words")[0]["word"].alias("first"), F.get("words", F.lit(1))["word"].alias("second"))
    )
    hits = (
        with_words.select("row", F.explode("found").alias("o"))
        .select("row", "o.at", "o.word")
        .join(postings, "word")
        .join(anchors, ["row", "template"])
        .groupBy("row", "template", (F.col("at") - F.col("place")).alias("start"))
        .agg(
            F.first("label").alias("label"),
            F.max((F.col("word") == F.col("first")).cast("int")).alias("has_first"),
            F.max(F.coalesce(F.col("word") == F.col("second"), F.lit(True)).cast("int")).alias("has_second"),
            F.sum(F.col("mandatory").cast("int")).alias("n_must"),
            F.first("n_mandatory").alias("n_mandatory"),
            (F.count(F.lit(1)) / F.first("n_words")).alias("share"),
        )
        .where((F.col("has_first") == 1) & (F.col("has_second") == 1) & (F.col("n_must") == F.col("n_mandatory")))
    )
    # at most one label for each template
    found = hits.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    own = F.col("base.label")
    return rows.join(found, "row", "left").select(
        F.col("__key").alias(key),
        F.col("n").alias("n_words"),
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.at").cast("bigint").alias("first_word"),
        F.array_max("base.at").cast("bigint").alias("last_word"),
        _joined(own).alias("base_labels"),
        _joined(F.concat(own, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )
