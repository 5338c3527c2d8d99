"""Steps that must not grow faster than their input: what is sorted, stored and shuffled."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidewell import operators as O
from tidewell import plans
from tidewell.queries import core_storage
from tidewell.queries.registry import REGISTRY, Tables


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def ran(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0].splitlines()


def test_ranked_or_null_shuffles_one_claim_row_per_policy(spark):
    policies = [1, 1, 2, 2, 3, 4, None]
    claims = [(1, 12), (1, 11), (1, 11), (2, None), (2, None), (2, 20), (4, None), (5, 50), (None, 60)]
    t = SimpleNamespace(
        e_policy=spark.createDataFrame([(p,) for p in policies], "pol_num bigint"),
        e_pack_claim=spark.createDataFrame(claims, "pol_num bigint, clm_id bigint"),
    )
    got = REGISTRY["p21_ranked_or_null"].build(t)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [(1, 11), (2, None), (2, None), (2, 20), (3, None), (4, None), (None, None)])
    )
    keys = [line for line in ran(got) if "Aggregate(keys=" in line]
    assert keys and not any("clm_id" in line.split("functions=")[0] for line in keys)


def test_bitmaps_are_no_larger_than_their_ids(spark):
    rows = spark.range(2000).select((F.col("id") % 500).alias("k"), (F.col("id") * 97 - 90_000).alias("item"))
    state = O.distinct_state(rows, ["k"], "item")
    assert state.count() <= 2000 and state.schema["bits"].dataType.simpleString() == "bigint"
    edges = [-65, -64, -1, 0, 0, 63, 64, 2**63 - 1, -(2**63), None]
    both = O.distinct_state(spark.createDataFrame([("a", i) for i in edges], "k string, item bigint"), ["k"], "item")
    assert O.distinct_count(both, []).first().n == len(set(edges) - {None})
    assert [tuple(r) for r in O.distinct_count(O.merge_states(both, both), ["k"]).collect()] == [("a", 8)]


def test_balance_is_shuffled_by_policy_only(spark, no_broadcast):
    """After the ledgers are netted, terms are joined and balances summed where a policy's rows lie."""
    lines = ran(REGISTRY["d04_balance_on_buckets"].run(spark, SMALL))
    exchanges = [line for line in lines if "Exchange hashpartitioning" in line]
    assert len(exchanges) <= 2 and not any("plan_code" in line for line in exchanges)


def test_stored_tables_have_buckets_for_their_rows_and_the_session(spark, no_broadcast, monkeypatch):
    t = Tables(spark, SMALL)
    rows = t.e_coverage.count()
    monkeypatch.setattr(core_storage, "BUCKET_ROWS", rows // 30)
    assert core_storage.bucket_count(t) >= 30
    monkeypatch.undo()
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        assert core_storage.bucket_count(t) == 24
        lines = ran(REGISTRY["d53_fact_on_buckets"].run(spark, SMALL))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "cvg_prem" in line)
    met = next(line for line in reversed(lines[:at]) if "Exchange" in line or "Join" in line)
    assert "Join" in met, met


def test_lookup_of_the_greatest_value_sorts_nothing(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    ref = spark.createDataFrame([(1, 5), (1, 7), (1, None), (2, None), (None, 9)], "key int, v int")
    got = O.lookup(df, ref, "k", "key", "v", "found", default=0)
    assert {tuple(r) for r in got.collect()} == {(1, 7), (2, 0), (3, 0), (None, 0)}
    assert not any("Window" in line for line in ran(got))


def test_pack_works_shared_results_out_once(spark, monkeypatch):
    counts = {}
    for name in ("agent_kpis", "retention", "lapse_risks", "next_leads", "qualification", "agent_list"):
        def counted(*args, _name=name, _real=getattr(plans, name), **more):
            counts[_name] = counts.get(_name, 0) + 1
            return _real(*args, **more)

        monkeypatch.setattr(plans, name, counted)
    REGISTRY["s14_pack_exports"].build(Tables(spark, SMALL))
    assert counts == dict.fromkeys(counts, 1) and len(counts) == 6
