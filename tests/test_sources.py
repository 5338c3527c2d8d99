"""Reading and writing."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidewell import sources
from tidewell.checks import require
from tidewell.sources import sinks


def table(spark, *rows):
    return spark.createDataFrame(rows, "id int, dt string")


def test_partition_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_partitions(table(spark, (1, "a"), (2, "b")), path, "dt")
    sources.write_partitions(table(spark, (3, "b")), path, "dt")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]
    # A result may read the folder it overwrites by partition.
    old = spark.read.parquet(path).where("dt = 'b'")
    sources.write_partitions(old.withColumn("id", F.col("id") + 1).select("id", "dt"), path, "dt")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (4, "b")]


def test_partition_read_is_pruned_and_keeps_the_column(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_partitions(table(spark, (1, "a"), (2, "b")), path, "dt")
    one = sources.read_partition(spark, path, "dt", "b")
    assert [tuple(r) for r in one.collect()] == [(2, "b")]
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_static_overwrite_of_an_input_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_table(table(spark, (1, "a")), path)
    with pytest.raises(ValueError, match="is read by this result"):
        sources.write_table(spark.read.parquet(path), path)
    assert spark.read.parquet(path).count() == 1


def test_write_table_replaces_even_under_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_table(table(spark, (1, "a"), (2, "b")), path)
    sources.write_table(table(spark, (3, "c")), path)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, "c")]


def test_csv_single_file_with_header(spark, tmp_path):
    path = str(tmp_path / "c")
    df = table(spark, (1, "a"), (2, "b")).withColumn("l", F.array(F.lit("x"), F.lit("y")))
    sources.write_csv(df, path, single=True)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    assert open(os.path.join(path, files[0])).read().splitlines()[0] == "id,dt,l"
    back = sources.read_csv(spark, path, "id int, dt string, l string")
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", "x;y"), (2, "b", "x;y")]


def test_exports_list_every_agent(spark, tmp_path):
    agents = spark.createDataFrame([(1,), (2,)], "agt_cd int")
    report = spark.createDataFrame([(1, 5)], "agt_cd int, n int")
    done = sources.export_reports({"r": report}, agents, str(tmp_path))
    back = sources.read_csv(spark, done["r"], "agt_cd int, n int")
    assert sorted((tuple(r) for r in back.collect()), key=str) == [(1, 5), (2, None)]


def test_load_tables_takes_the_first_root(spark, tmp_path):
    for root, value in (("one", 1), ("two", 2)):
        sources.write_table(table(spark, (value, "a")), str(tmp_path / root / "TPOL"))
    sources.write_table(table(spark, (9, "z")), str(tmp_path / "two" / "TCVG"))
    got = sources.load_tables(spark, [str(tmp_path / "one"), str(tmp_path / "two")], ["TPOL/", "TCVG"])
    assert {k: d.collect()[0]["id"] for k, d in got.items()} == {"tpol": 1, "tcvg": 9}
    with pytest.raises(FileNotFoundError):
        sources.load_tables(spark, [str(tmp_path)], ["NOPE"])


def test_names_are_cleaned(spark):
    df = spark.createDataFrame([(1, 2)], "` Ranking ` int, `rep_a_PREDICTION` int")
    assert sources.clean_columns(df, drop=["rep_", "_PREDICTION"]).columns == ["Ranking", "a"]
    assert sources.lower_columns(df).columns == [" ranking ", "rep_a_prediction"]
    with pytest.raises(ValueError, match="collide"):
        sources.clean_columns(spark.createDataFrame([(1, 2)], "` a` int, a int"))


def test_sql_parameters_are_values(spark):
    df = table(spark, (1, "a"), (2, "x' or '1'='1"))
    got = sources.run_sql(spark, "select id from {t} where dt = :v", {"v": "x' or '1'='1"}, {"t": df})
    assert [r["id"] for r in got.collect()] == [2]


def test_calendar():
    cal = sources.report_calendar("2024-03-31")
    assert (cal.report_date, cal.month_start, cal.previous_report_date) == (
        date(2024, 2, 29), date(2024, 3, 1), date(2024, 1, 31),
    )
    assert cal.token == "2402"
    assert sources.report_calendar("2024-01-15", 2).report_date == date(2023, 10, 31)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="'nope'"):
        require(table(spark, (1, "a")), "t", "id", "nope")


@pytest.mark.parametrize(
    "a, b, meet",
    [
        ("hdfs://nn:8020/data/x", "/data/x", True),
        ("hdfs:///data/x", "hdfs://nn:8020/data/x/y", True),
        ("hdfs://nn:8020/data/x", "/data/xy", False),
        ("hdfs://other:8020/data/x", "/data/x", False),
        ("file:/data/x", "/data/x", False),
        ("s3a://bucket/a", "s3a://bucket/a/b", True),
        ("s3a://bucket/a", "s3a://bucket2/a", False),
        ("data/x", "hdfs://nn:8020/user/me/data/x", True),
        ("/data/../data//x/", "/data/x", True),
    ],
)
def test_locations_are_compared_whole(a, b, meet):
    def located(path):
        return sinks.absolute(path, "hdfs://nn:8020", "/user/me")

    assert sinks.overlap(located(a), located(b)) is meet


def test_overwrite_is_refused_under_another_spelling(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_table(table(spark, (1, "a")), path)
    for read, write in ((f"file:{path}", path), (path, f"file://{path}"), (path, f"{path}/../t/")):
        with pytest.raises(ValueError, match="is read by this result"):
            sources.write_table(spark.read.parquet(read), write)
    assert spark.read.parquet(path).count() == 1
