from collections import Counter

from tests.llm.helpers import no_documents, odd_documents, small, words
from tidewell.llm import rules


def brute(text):
    w, text = words(text), text or ""
    count = Counter(zip(w, w[1:], w[2:], strict=False))
    at = {i + k for i in range(len(w) - 2) if count[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(at),
    )


def test_counts_match_brute_force(spark):
    docs = odd_documents(spark).select("doc_id", "text").unionByName(small(spark, "documents", "doc_id", "text"))
    got = rules.statistics(docs, "doc_id", "text").collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)


def test_rules_find_junk_and_keep_good_documents(spark):
    docs, labels = small(spark, "documents", "doc_id", "text"), small(spark, "labels", "doc_id", "quality")
    out = rules.quality_rules(docs, labels)
    assert out.count() == docs.count()
    met = out.join(labels, "doc_id").where("not base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in met)
    assert right >= 0.97 * len(met)
    assert all(not r.kept for r in out.where("base_failed").collect())
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in out.collect())


def test_list_is_ordered_and_grown_by_gain(spark):
    rows = [(i, 100, 500, 200 if i % 4 == 0 else 0, 0, 60 if i % 4 == 1 else 0) for i in range(200)]
    stats = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long").selectExpr(
        "*", "600L as n_chars", "5L as n_lines", "0L as n_capitals", "0L as n_marks"
    )
    labels = spark.createDataFrame([(i, int(i % 4 > 1)) for i in range(200)], "doc_id long, quality int")
    learned = rules.learn(stats, labels)
    assert {r.conditions[0].feature for r in learned} == {"symbol_share", "repeat_share"}
    judged = rules.judge(stats, learned).collect()
    assert all((r.rule is not None) == (r.doc_id % 4 < 2) for r in judged)
    # clean rows are never covered, whichever order the rules are in
    assert all(r.kept for r in judged if r.doc_id % 4 > 1)


def test_awkward_input(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    docs = odd_documents(spark)
    out = rules.quality_rules(docs, labels)
    assert out.count() == docs.count()
    assert rules.quality_rules(no_documents(spark), labels).count() == 0
    kept = rules.keep_documents(docs, docs, labels)
    assert kept.columns == docs.columns
    assert kept.where("text like 'ab ab%'").count() == 0  # repeats all over
    assert rules.keep_documents(docs, docs, labels.limit(0)).count() == sum(
        len(words(r.text)) >= 50 and 2 * brute(r.text)[4] <= len(words(r.text)) for r in docs.collect()
    )
