"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare, duck, norm
from tidewell.queries import REGISTRY
from tidewell.queries.plain_forms import PAIRS
from tidewell.queries.registry import Tables


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, con, name):
    _, problems, _, _ = compare(REGISTRY[name], spark, con, SMALL)
    assert not problems


@pytest.mark.parametrize("name", list(PAIRS))
def test_rewrite_matches_plain_form(spark, name):
    query = REGISTRY[name]
    columns = [c for c, _ in query.columns]
    plain = PAIRS[name](Tables(spark, SMALL)).select(*columns)

    def rows(df):
        return sorted([tuple(norm(x) for x in r) for r in df.collect()], key=str)

    casted = query.run(spark, SMALL)
    assert rows(plain.select(*[plain[c].cast(casted.schema[c].dataType) for c in columns])) == rows(casted)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 14


def test_movement_reconciles(spark):
    """Opening, less exits, plus entries is closing, up to moves between statuses no bucket lists."""
    got = {}
    for r in entry.entry(spark).collect():
        got[r["type"][:2]] = got.get(r["type"][:2], 0) + r["count_num"]
    exits = sum(got[k] for k in ("03", "04", "05", "06", "07", "08", "09"))
    assert got["00"] - exits + got["01"] + got["02"] == got["10"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark):
    text = plan(REGISTRY["s15_run_sql"].run(spark, SMALL))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_totalprice", text)
    assert "o_orderdate" not in re.search(r"ReadSchema: \S+", text).group(0)


@pytest.mark.parametrize(
    "name", ["d24_status_movement", "d11_attribute_leads", "d13_ecommerce_sales", "d35_company_kpis", "d53_coverage_fact", "j13_interval_join"]
)
def test_no_cross_joins_or_python(spark, name):
    text = plan(REGISTRY[name].run(spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "SinglePartition" not in text


@pytest.mark.parametrize("name", ["d42_sales_by_month", "d50_agent_overview"])
def test_stored_fact_is_read_by_columns(spark, name):
    text = plan(REGISTRY[name].run(spark, SMALL))
    schemas = re.findall(r"tidewell-fact.*?ReadSchema: struct<(.*?)>", text)
    assert schemas and all(s.count(":") < 20 for s in schemas)
