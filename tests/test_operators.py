"""Operators on edge rows and against brute force."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidewell import operators as op
from tidewell.session import shared_dir


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hot_rows(n=600, seed=7):
    """Rows of which one key holds a third."""
    rng = random.Random(seed)
    day0 = date(2024, 1, 1)
    return [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", i, day0 + timedelta(days=rng.randrange(400)))
        for i in range(n)
    ]


def test_latest_by_ties_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("b", None, 1), (None, 5, 9), (None, 6, 8)], "k string, t int, id int")
    got = rows_of(op.latest_by(df, ["k"], [F.col("t").desc_nulls_last(), F.col("id").desc()]))
    assert got == sorted([("a", 1, 3), ("b", None, 1), (None, 6, 8)], key=str)


def test_first_ties_by_keeps_all_first_rows(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 3)], "k string, t int, id int")
    assert rows_of(op.first_ties_by(df, ["k"], [F.col("t")])) == [("a", 1, 1), ("a", 1, 2)]


def test_top_n_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(), "k string, id int, d date")
    top = op.top_n_by(df, ["k"], [F.col("d").desc(), F.col("id")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    want = []
    groups = defaultdict(list)
    for k, i, d in hot_rows():
        groups[k].append((-d.toordinal(), i, d))
    for k, items in groups.items():
        want += [(k, i, d) for _, i, d in sorted(items)[:3]]
    assert rows_of(top) == sorted(want, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(("low", "high"), [(2, 30), (0, 0), (-10, 10), (1, 366)])
def test_interval_join_against_brute_force(spark, how, low, high):
    left, right = hot_rows(240, 1), hot_rows(200, 2)
    left += [(None, 900, date(2024, 1, 1)), ("none", 901, date(2024, 1, 1)), ("hot", 902, None)]
    right += [(None, 900, date(2024, 1, 5)), ("hot", 903, None)]
    a = spark.createDataFrame(left, "k string, id int, d date")
    b = spark.createDataFrame(right, "k2 string, id2 int, d2 date")
    got = rows_of(op.interval_join(a, b, [("k", "k2")], "d", "d2", low, high, how=how).select("id", "id2"))
    want = []
    for k, i, d in left:
        hits = [j for k2, j, d2 in right if k is not None and k == k2 and d and d2 and low <= (d2 - d).days <= high]
        want += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    assert got == sorted(want, key=str)


def test_month_range_join_against_brute_force(spark):
    rng = random.Random(3)
    day0 = date(2023, 1, 31)
    pol = [(i, f"p{i % 3}", day0 + timedelta(days=rng.randrange(420))) for i in range(150)]
    pol += [(900, None, day0), (901, "p0", None)]
    rates = [(f"p{i % 3}", day0 + timedelta(days=rng.randrange(-60, 400)), i) for i in range(60)]
    a = spark.createDataFrame(pol, "id int, plan string, d date")
    b = spark.createDataFrame(rates, "plan_r string, start date, rate int")
    got = rows_of(op.month_range_join(a, b, ("plan", "plan_r"), "d", "start").select("id", "rate"))
    pairs = a.crossJoin(b).where("plan = plan_r and floor(months_between(d, start)) between 0 and 2").select("id", "rate")
    hits = [tuple(r) for r in pairs.collect()]
    missing = [(i, None) for i, *_ in pol if i not in {h[0] for h in hits}]
    assert got == sorted(hits + missing, key=str)


def test_semi_or_and_lookup(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 5), (None, 60), (None, 1)], "k int, v int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows_of(op.semi_or(df, keys, "k", F.col("v") > 40)) == sorted([(1, 5), (2, 50), (None, 60)], key=str)
    ref = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "key int, name string")
    got = op.lookup(df, ref, "k", "key", "name", "found", default="-").select("k", "found")
    assert rows_of(got) == sorted([(1, "b"), (2, "-"), (3, "-"), (None, "-"), (None, "-")], key=str)


def test_with_top_row_of_nothing(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    none = spark.createDataFrame([], "rate int, d date")
    assert rows_of(op.with_top_row(df, none, [F.col("d").desc()], ["rate"])) == [(1, None), (2, None)]


def test_group_extremes_with_null_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 2), (None, 7), ("b", None)], "k string, v int")
    got = rows_of(op.with_group_extremes(df, ["k"], "v", "lo", "hi"))
    assert got == sorted([("a", 1, 1, 5), ("a", 5, 1, 5), (None, 2, 2, 7), (None, 7, 2, 7), ("b", None, None, None)], key=str)


@pytest.mark.parametrize("distinct", [3, 60, 100_000])
def test_ranks_against_brute_force(spark, distinct):
    rng = random.Random(5)
    data = [(i, 0 if i % 3 == 0 else rng.randrange(1, distinct)) for i in range(500)] + [(999, None)]
    df = spark.createDataFrame(data, "id int, v int")
    counts = Counter(v for _, v in data if v is not None)

    def above(v):
        return sum(n for x, n in counts.items() if x > v)

    got = {r["id"]: r["rank"] for r in op.with_rank(df, "v").collect()}
    assert got == {i: None if v is None else above(v) + 1 for i, v in data}
    got = {r["id"]: r["rank"] for r in op.with_mean_rank(df, "v").collect()}
    assert got == {i: None if v is None else int(above(v) + 1 + (counts[v] - 1) / 2) for i, v in data}


def test_standing_caps_and_floors(spark):
    df = spark.createDataFrame([(i, i) for i in range(200)], "id int, v int")
    got = {r["id"]: r["standing"] for r in op.with_standing(df, "v").collect()}
    assert got[199] == 0.99 and got[0] == 0.0 and got[100] == 100 / 200


def test_tied_ranks(spark):
    df = spark.createDataFrame([("a", 9), ("b", 9), ("c", 5), ("d", 5), ("e", 5), ("f", 1)], "id string, v int")
    low = {r["id"]: r["rank"] for r in op.with_rank(df, "v").collect()}
    mean = {r["id"]: r["rank"] for r in op.with_mean_rank(df, "v").collect()}
    assert low == dict(a=1, b=1, c=3, d=3, e=3, f=6) and mean == dict(a=1, b=1, c=4, d=4, e=4, f=6)


def test_rolling_kpis_windows_nest(spark):
    rng = random.Random(11)
    data = [(f"a{rng.randrange(4)}", -rng.randrange(1, 15), rng.choice([None, 1, 2, 3, 4]), rng.randrange(50)) for _ in range(400)]
    df = spark.createDataFrame(data, "agt string, m int, item int, amt int")
    metrics = [op.Metric("amt", "sum", "amt"), op.Metric("items", "distinct", "item"),
               op.Metric("big", "sum", "amt", F.col("amt") > 40)]
    got = {r["agt"]: r.asDict() for r in op.rolling_kpis(df, "agt", "m", metrics).collect()}
    for agt, row in got.items():
        for label, n in op.WINDOWS.items():
            mine = [d for d in data if d[0] == agt and -n <= d[1] <= -1]
            big = [d[3] for d in mine if d[3] > 40]
            assert row[f"{label}_amt"] == (sum(d[3] for d in mine) if mine else None)
            assert row[f"{label}_items"] == (len({d[2] for d in mine} - {None}) if mine else None)
            assert row[f"{label}_big"] == (sum(big) if big else None)
        assert row["last_yr_amt"] >= row["last_6m_amt"] >= (row["last_3m_amt"] or 0) >= (row["last_mth_amt"] or 0)


def test_densify_fills_gaps(spark):
    df = spark.createDataFrame([("a", "01", 5), ("a", "02", 1), ("b", "03", 2), (None, "04", 9)], "e string, m string, v int")
    got = rows_of(op.densify(df, "e", "m", "v", 0))
    assert got == [("a", "01", 5), ("a", "02", 1), ("a", "03", 0), ("b", "01", 0), ("b", "02", 0), ("b", "03", 2)]


def test_any_value_and_text_list_of_nulls(spark):
    df = spark.createDataFrame([("a", None), ("b", "y"), ("b", "x"), ("b", "x")], "k string, v string")
    got = rows_of(df.groupBy("k").agg(op.any_value_of("v"), op.text_list("v")))
    assert got == [("a", None, ""), ("b", "x", "x,y")]


def test_debits_and_credits_add_up(spark):
    df = spark.createDataFrame([("C", 5), ("D", 3), ("D", 4), ("X", 2), (None, 1)], "f string, amt int")
    debit, credit, net = df.agg(*op.debit_credit_net("amt", "f", 1000)).collect()[0]
    assert (debit, credit, net) == (7000, 5000, 2000)
    assert df.agg(op.signed_sum("amt", "f")).collect()[0][0] == 5 - 3 - 4 - 2 - 1


def test_top_list_keeps_order(spark):
    df = spark.createDataFrame([("a", i, i * 7 % 10) for i in range(10)], "k string, id int, s int")
    got = op.top_list_by(df, ["k"], [F.col("s").desc(), F.col("id")], "id", 3, "ids").collect()
    assert got[0]["ids"] == [7, 4, 1]


def test_kpi_block_ratio_and_zero(spark):
    df = spark.createDataFrame([("x", 1, 0), ("x", 3, 0), ("y", 4, 2)], "ch string, a int, b int")
    kpis = [op.Kpi("n", F.lit(1)), op.Kpi("r", F.col("a"), None, F.col("b")), op.Kpi("big", F.when(F.col("a") > 3, 1).otherwise(0))]
    got = {(r["kpi"], r["ch"]): r["kpi_val"] for r in op.kpi_block(df, kpis, ["ch"]).collect()}
    assert got == {("n", "x"): 2, ("n", "y"): 1, ("r", "x"): None, ("r", "y"): 2, ("big", "x"): 0, ("big", "y"): 1}


@pytest.mark.parametrize("values", [[], [None], [4], [1, 2], [5, 1, 3], [7] * 90 + [1, 2, 9], [*range(200), 3, 3, None]])
def test_median_against_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    known = [v for v in values if v is not None]
    got = spark.range(1).select(op.median_of(df, "v").alias("m")).first()["m"]
    assert got == (statistics.median(known) if known else None)


def test_densify_refuses_a_long_list(spark):
    df = spark.createDataFrame([(1, f"d{i}", 1) for i in range(6)], "e int, d string, v int")
    assert op.densify(df, "e", "d", "v", most=6).count() == 6
    with pytest.raises(Exception, match="more than 5 values of d"):
        op.densify(df, "e", "d", "v", most=5).collect()


def test_settling_needs_a_shared_folder():
    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
