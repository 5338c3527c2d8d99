import re

from tests.llm.helpers import ascii_lower, no_documents, odd_documents, small
from tidewell.llm import licences


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))

    def places(phrase):
        p = phrase.split()
        return [k for k in range(len(w)) if w[k : k + len(p)] == p]

    base = [(k, label) for phrase, label in licences.BASE for k in places(phrase)]
    own = {label for _, label in base}
    labels = own | {label for label, _, phrase in licences.TEMPLATES if places(phrase)}
    share = 0.0
    for _, wording, phrase in licences.TEMPLATES:
        body, must = wording.split(), phrase.split()
        ahead = next(i for i in range(len(body)) if body[i : i + len(must)] == must)
        for k in places(phrase):
            share = max(share, sum(0 <= k - ahead + i < len(w) and w[k - ahead + i] == x for i, x in enumerate(body)) / len(body))
    at = [k for k, _ in base]
    return (
        len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(labels)),
        round(share, 9),
    )


def check(spark, docs):
    got = licences.scan(docs).collect()
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    assert sorted(((*r[:-1], round(r[-1], 9)) for r in got), key=str) == want


def test_documents(spark):
    check(spark, small(spark, "documents", "doc_id", "text"))


def test_templates_and_awkward_texts(spark):
    texts = [w for _, w, _ in licences.TEMPLATES] + [p.upper() + "!" for _, _, p in licences.TEMPLATES]
    texts += [
        "CC BY cc by", "mit license " * 300, "the apache mit license version 2 0 apache license", "license apache",
        "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "gnu general public licence gnu general", "cc", "by cc by by", "version 2 0 apache license version 2 0",
    ]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    check(spark, docs.unionByName(odd_documents(spark).select("doc_id", "text")))


def test_function_words_are_near_looked_up_words():
    for _, wording, _ in licences.TEMPLATES:
        w = wording.split()
        rare = [i for i, x in enumerate(w) if x not in licences.FUNCTION_WORDS]
        assert all(min(abs(i - r) for r in rare) <= licences.REACH for i in range(len(w)))


def test_no_documents(spark):
    assert licences.scan(no_documents(spark)).count() == 0
