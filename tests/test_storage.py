"""Stored forms: buckets, partials, bitmaps, histories, schemas, lines; and the joins that came with them."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidewell import operators as O
from tidewell import plans, sources
from tidewell.queries import core_storage as Q
from tidewell.queries.registry import REGISTRY, Tables


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def tree(text):
    """(depth, line) of the plan that ran."""
    out = []
    for line in text.split("+- == Initial Plan ==")[0].splitlines():
        bare = re.sub(r"^[\s:+\-*|]*(\(\d+\)\s*)?", "", line)
        if bare:
            out.append((len(line) - len(line.lstrip(" :+-")), bare))
    return out


def above(nodes, i):
    """Nodes over node ``i``, nearest first."""
    depth = nodes[i][0]
    for d, line in reversed(nodes[:i]):
        if d < depth:
            depth = d
            yield line


def first_of(nodes, i, *names):
    return next((line for line in above(nodes, i) if line.startswith(names)), None)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, column", [("d53_fact_on_buckets", "cvg_prem"), ("d04_balance_on_buckets", "acct_gen_amt")])
def test_largest_table_is_not_shuffled(spark, no_broadcast, name, column):
    """Between its scan and the join or aggregate it enters there is no exchange."""
    nodes = tree(final_plan(REGISTRY[name].run(spark, SMALL)))
    scans = [i for i, (_, line) in enumerate(nodes) if line.startswith("FileScan") and column in line]
    assert scans
    for i in scans:
        assert "Bucketed: true" in nodes[i][1]
        met = first_of(nodes, i, "Exchange", "SortMergeJoin", "ShuffledHashJoin", "HashAggregate", "SortAggregate", "BroadcastHashJoin")
        assert not met.startswith("Exchange"), met


def test_buckets_are_files_of_whole_keys(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 97).alias("k"), "id")
    made = sources.write_buckets(rows, "tidewell_bucket_test", str(tmp_path / "b"), "k", 8, sort=["k", "id"])
    files = made.select("k", F.input_file_name().alias("f")).distinct().collect()
    assert len({r.k for r in files}) == len(files) and len({r.f for r in files}) <= 8
    again = sources.write_buckets(rows.where("id < 10"), "tidewell_bucket_test", str(tmp_path / "b"), "k", 8)
    assert again.count() == 10
    sources.drop_buckets(spark, "tidewell_bucket_test")


# -- partials ------------------------------------------------------------------------------------


def test_partials_merge_and_window(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randint(90, 104), rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 5, 7])) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, m int, item int, amt int")
    metrics = [O.Metric("amt", "sum", "amt"), O.Metric("items", "distinct", "item"), O.Metric("some", "distinct", "item", F.col("amt") == 5)]
    whole = O.monthly_partials(df, "k", "m", metrics)
    half = O.monthly_partials(df.where("amt is null"), "k", "m", metrics).unionByName(O.monthly_partials(df.where("amt is not null"), "k", "m", metrics))
    merged = O.merge_partials(half, "k")
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))
    for last in (95, 104, 120):
        got = O.rolling_from_partials(merged, "k", last, metrics, {"one": 1, "six": 6})
        want = O.rolling_kpis(df.withColumn("o", F.col("m") - last - 1), "k", "o", metrics, {"one": 1, "six": 6})
        def shown(x):
            return {tuple(None if v is None else str(float(v)) if not isinstance(v, str) else v for v in r) for r in x.collect()}
        # a key without any row in the windows has no row here; there it has one of nulls if it has none at all
        assert shown(got) == shown(want)


def test_store_keeps_twelve_months(spark, tmp_path):
    path, metrics = str(tmp_path / "p"), [O.Metric("n", "sum", "v")]
    df = spark.createDataFrame([("a", m, m) for m in range(1, 21)], "k string, m int, v int")
    for month in range(1, 21):
        O.advance(O.monthly_partials(df, "k", "m", metrics), path, month)
    months = sorted(r.month for r in spark.read.parquet(path).select("month").distinct().collect())
    assert months == list(range(9, 21))
    O.advance(O.monthly_partials(df, "k", "m", metrics), path, 20)  # a rerun changes nothing
    assert spark.read.parquet(path).count() == 12
    assert O.rolling_from_partials(spark.read.parquet(path), "k", 20, metrics, {"y": 12}).first().y_n == sum(range(9, 21))


# -- bitmaps -------------------------------------------------------------------------------------


def test_bitmaps_count_exactly(spark):
    ids = [0, 1, 32767, 32768, 32769, -1, -32768, -32769, 1 << 40, (1 << 62), None]
    rows = [(i % 3, i % 2, x) for i, x in enumerate(ids * 3)]
    df = spark.createDataFrame(rows, "a int, b int, id long")
    state = O.merge_states(O.distinct_state(df.where("a = 0"), ["a", "b"], "id"), O.distinct_state(df.where("a <> 0"), ["a", "b"], "id"))
    for dims in ([], ["a"], ["b"], ["a", "b"]):
        got = {tuple(r) for r in O.distinct_count(state, dims).collect()}
        want = {tuple(r) for r in df.groupBy(*dims).agg(F.countDistinct("id")).collect()}
        assert got == want
    assert O.distinct_count(O.distinct_state(df.limit(0), ["a"], "id"), []).first().n == 0
    with pytest.raises(TypeError):
        O.distinct_state(df.withColumn("id", F.col("id").cast("string")), ["a"], "id")


# -- joins ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_matches_plain_join(spark, how):
    many = spark.createDataFrame([("hot" if i % 3 == 0 else None if i % 31 == 0 else f"k{i % 40}", i) for i in range(600)], "a string, i int")
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("k3", 5), ("k3", 5), ("zz", 6)], "b string, v int")
    want = many.join(few, F.col("a") == F.col("b"), how)
    got = O.split_join(many, few, ("a", "b"), how=how, target=20)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert O.split_join(many.limit(0), few, ("a", "b"), how=how, target=20).count() == 0


def test_heavy_key_is_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        many = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), "id")
        few = spark.createDataFrame([("hot", 1), ("5", 2)], "b string, v int")
        parts = O.split_join(many, few, ("a", "b"), target=500).groupBy(F.spark_partition_id()).count().collect()
        plain = many.join(few, F.col("a") == F.col("b")).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = sum(r["count"] for r in parts)
    assert total == sum(r["count"] for r in plain)
    assert max(r["count"] for r in plain) >= total - 1 and max(r["count"] for r in parts) < 0.6 * total


def rows_made(df, node):
    """Rows that the nodes of a kind made, in the plan as it ran."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        children = plan.children()
        below = sum(walk(children.apply(i)) for i in range(children.size()))
        return below + (plan.metrics().apply("numOutputRows").value() if name == node else 0)

    df.collect()
    return walk(df._jdf.queryExecution().executedPlan())


def test_split_join_repeats_the_few_no_more_with_more_rows(spark, no_broadcast):
    few = spark.range(100).select(F.lit("hot").alias("b"), F.col("id").alias("v"))
    made = []
    for n in (10_000, 40_000):
        many = spark.range(n).select(F.lit("hot").alias("a"), "id")
        made.append(rows_made(O.split_join(many, few, ("a", "b"), how="left_semi", target=20), "GenerateExec"))
    assert 0 < made[1] <= made[0] <= 100 * 64


def test_few_bytes_of_many_pairs_stay_in_many_tasks(spark, no_broadcast):
    many = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), "id")
    few = spark.range(500).select(F.when(F.col("id") % 10 == 0, "hot").otherwise(F.col("id").cast("string")).alias("b"), F.col("id").alias("v"))
    parts = O.split_join(many, few, ("a", "b"), target=100).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 0.6 * 150_000


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_of_copies_and_nulls_in_blocks(spark, how, monkeypatch):
    monkeypatch.setattr("tidewell.operators.skew.BLOCK_ROWS", 3)
    rows = [("hot", 7, 1.5)] * 40 + [(None, i % 4, None) for i in range(30)] + [("hot", i, -0.0) for i in range(30)] + [("k", None, 0.0)] * 5
    many = spark.createDataFrame(rows, "a string, i int, x double")
    few = spark.createDataFrame([("hot", 1), ("hot", 1), ("hot", None), ("k", 3), (None, 4)], "b string, v int")
    for some in (few, few.limit(0)):
        want = many.join(some, F.col("a") == F.col("b"), how)
        got = O.split_join(many, some, ("a", "b"), how=how, target=10)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_split_join_is_stored_in_less(spark, tmp_path, no_broadcast):
    many = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), "id")
    few = spark.range(12_000).select(F.lit("hot").alias("b"), F.col("id").alias("v"))
    joins = {"split": O.split_join(many, few, ("a", "b"), target=100), "plain": many.join(few, F.col("a") == F.col("b"))}
    size = {}
    for name, df in joins.items():
        df.select("id", "v").write.parquet(f"{tmp_path}/{name}")
        size[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet"))
    assert spark.read.parquet(f"{tmp_path}/split").count() == spark.read.parquet(f"{tmp_path}/plain").count() == 300 * 12_000
    assert size["split"] < 0.5 * size["plain"], size


def plain_as_of(rows, rates, within=None):
    out = []
    for i, k, d in rows:
        found = [(s, -v, v) for rk, s, v in rates if k is not None and d is not None and s is not None and rk == k and s <= d]
        best = max(found, default=None)
        ok = best and (within is None or (d - best[0]).days <= within)
        out.append((i, k, d, best[0] if ok else None, best[2] if ok else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("slot, within", [(366, None), (7, None), (30, 40)])
def test_as_of_join_matches_search(spark, slot, within):
    rng, day = random.Random(2), datetime.date(2020, 1, 1)
    dates = [day + datetime.timedelta(days=i) for i in range(0, 900)]
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([*dates, None])) for i in range(400)]
    rates = [(rng.choice(["a", "b", None, "c"]), rng.choice([*dates[200:700:9], None]), rng.randint(1, 5)) for _ in range(60)]
    df = spark.createDataFrame(rows + rows[:5], "i int, k string, d date")
    ref = spark.createDataFrame(rates, "plan string, s date, v int").withColumn("since", F.col("s"))
    got = O.as_of_join(df, ref, [("k", "plan")], "d", "s", ["since", "v"], order=[F.col("v")], slot_days=slot, within_days=within)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_as_of(rows + rows[:5], rates, within)
    assert O.as_of_join(df, ref.limit(0), [("k", "plan")], "d", "s", ["since", "v"]).where("v is not null").count() == 0
    assert O.as_of_join(df.limit(0), ref, [("k", "plan")], "d", "s", ["v"]).count() == 0


def test_spines_hold_no_list_of_all_values(spark):
    df = spark.createDataFrame([("g", "a", 1, 5), ("g", "b", 2, 7), ("h", "c", 3, None), (None, "d", 4, 1)], "g string, e string, x int, v int")
    got = {tuple(r) for r in O.densify_within(df, "g", "e", "x", "v").collect()}
    assert got == {("g", "a", 1, 5), ("g", "a", 2, 0), ("g", "b", 1, 0), ("g", "b", 2, 7), ("h", "c", 3, 0)}
    text = final_plan(REGISTRY["a26_densify_months"].run(spark, SMALL)) + final_plan(REGISTRY["a26_densify_within"].run(spark, SMALL))
    assert "collect_" not in text and "map_from" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    with pytest.raises(ValueError):
        O.month_calendar(spark, datetime.date(2020, 2, 1), datetime.date(2020, 1, 1))


# -- history -------------------------------------------------------------------------------------


def rows_of(history):
    return sorted(tuple(r) for r in history.read().select("k", "v", "p").collect())


def test_history_survives_a_run_that_stops(spark, tmp_path):
    def frame(rows):
        return spark.createDataFrame(rows, "k int, v string, p string")

    history = sources.History(spark, str(tmp_path / "h"), "p", ["k"])
    with pytest.raises(FileNotFoundError):
        history.read()
    history.replace(frame([(1, "a", "x"), (2, "b", "x"), (1, "c", "y")]))
    before = rows_of(history)
    staged = history.stage(frame([(2, "B", "x"), (3, "d", "z")]))  # the run stops here
    assert rows_of(history) == before
    other = history.stage(frame([(9, "n", "y")]))
    history.publish(staged)
    assert rows_of(history) == [(1, "a", "x"), (1, "c", "y"), (2, "B", "x"), (3, "d", "z")]
    with pytest.raises(RuntimeError):
        history.publish(other)  # staged from a history that is no longer the newest
    for bad in ([(1, "a", "x"), (1, "b", "x")], [(None, "a", "x")], [(1, "a", None)]):
        with pytest.raises(ValueError):
            history.stage(frame(bad))
    history.replace(frame([]))
    assert len(rows_of(history)) == 4
    (tmp_path / "h" / "manifest" / "_left").write_text("{")  # what a run leaves that stops while publishing
    assert len(rows_of(history)) == 4


# -- schemas and lines ---------------------------------------------------------------------------


def test_types_widen(spark):
    def wide(a, b):
        found = sources.wider(*[spark.createDataFrame([], f"x {t}").schema["x"].dataType for t in (a, b)])
        return found and found.simpleString()

    assert wide("int", "bigint") == wide("bigint", "tinyint") == "bigint"
    assert wide("int", "decimal(8,2)") == "decimal(12,2)" and wide("decimal(8,2)", "decimal(5,4)") == "decimal(10,4)"
    assert wide("decimal(8,2)", "float") == "double" and wide("date", "timestamp") == "timestamp"
    assert wide("string", "int") is None and wide("decimal(38,0)", "decimal(38,10)") is None


def test_columns_that_changed_are_one_table(spark, tmp_path):
    frames = [
        spark.createDataFrame([(1, 2)], "ID int, Amt int"), spark.createDataFrame([("x", 3.5, 2)], "new string, amt double, id bigint"),
        spark.createDataFrame([], "id int"),
    ]
    paths = []
    for i, df in enumerate(frames):
        paths.append(str(tmp_path / str(i)))
        df.write.parquet(paths[-1])
    got = sources.read_reconciled(spark, paths)
    assert got.dtypes == [("id", "bigint"), ("amt", "double"), ("new", "string")]
    assert {tuple(r) for r in got.collect()} == {(1, 2.0, None), (2, 3.5, "x")}
    assert sources.read_reconciled(spark, paths, columns=["new"]).columns == ["new"]
    spark.createDataFrame([("a",)], "amt string").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="amt is .* in .* and string"):
        sources.read_reconciled(spark, [*paths, str(tmp_path / "bad")])
    with pytest.raises(ValueError):
        sources.read_reconciled(spark, paths, columns=["none"])


def test_bad_lines_are_kept_and_counted(spark, tmp_path):
    text = "id,day,tags\n1,2020-01-31,3;4\n2,2020-02-30,5\n3,2020-03-01\n4,2020-03-02,,7\nx,2020-03-03,8\n5,2020-03-04,9;a\n6,2020-03-05,\n"
    (tmp_path / "f.csv").write_text(text)
    schema = "id int, day date, tags array<int>"
    good, bad = sources.read_checked(spark, str(tmp_path / "f.csv"), schema)
    assert sorted((r.id, r.tags) for r in good.collect()) == [(1, [3, 4]), (6, None)]
    assert {r.line for r in bad.collect()} == {"2,2020-02-30,5", "3,2020-03-01", "4,2020-03-02,,7", "x,2020-03-03,8", "5,2020-03-04,9;a"}
    assert good.select("id").count() == 2 and good.select("tags").where("tags is null").count() == 1
    assert tuple(sources.line_counts(spark, str(tmp_path / "f.csv"), schema).first()) == (2, 5, 7)
    for _ in range(2):
        sources.quarantine(bad, str(tmp_path / "q"), source="f")
    sources.quarantine(bad.limit(1), str(tmp_path / "q"), source="g")
    assert spark.read.parquet(str(tmp_path / "q")).count() == 6


def test_step_by_step_store_reads_only_its_months(spark):
    t = Tables(spark, SMALL)
    facts = plans.agent_partials(Q.pack.fact(t), Q.pack.agents(t))
    assert {"agt_cd", "month", "metric", "item", "amount"} == set(facts.columns)
