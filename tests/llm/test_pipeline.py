import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import SMALL, no_documents, odd_documents
from tidewell.llm import queries

NATIVE = ("op1_quality_rules", "op7_chat_windows", "op9_source_mix", "op10_licence_scan")


def test_registered():
    names = entry.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_stages_by_themselves(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SMALL)
        if name == "sentencepiece":
            assert after.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            assert after.count() == before.count()
        else:
            assert after.columns == docs.columns
            if name != "source_mix":
                assert after.subtract(before).count() == 0 and 0 < after.count() <= before.count()
            before = after.checkpoint()


@pytest.mark.parametrize("make", [odd_documents, no_documents])
def test_stages_on_awkward_documents(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        assert out.count() <= 2 * docs.count()


def test_run_is_its_stages(spark):
    got = sorted(map(str, corpus_pipeline.run(spark, SMALL).select("doc_id", "ids_sha256").collect()))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL).checkpoint()
    assert sorted(map(str, docs.select("doc_id", "ids_sha256").collect())) == got and got
