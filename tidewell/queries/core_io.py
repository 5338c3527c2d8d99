"""Sources and sinks as queries: what is written is read back.

Written results go to the shared folder the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sources
from ..session import shared_dir
from .entities import ORDERS_AS_OF
from .registry import Tables, query


def fresh(t: Tables, name: str) -> str:
    """A new folder of its own in the shared folder."""
    return f"{shared_dir(t.spark)}/tidewell-{name}-{uuid.uuid4().hex}"


@query("s01_s09_read_columns", "o_orderkey:l o_totalprice:d", "select o_orderkey, o_totalprice from orders")
def read_columns(t: Tables):
    return sources.read_table(t.spark, f"{t.dir}/orders.parquet", columns=["o_orderkey", "o_totalprice"])


MONTH_TOTALS = """select l_returnflag, cast(date_trunc('month', l_shipdate) as date) as month, count(*) as n,
  sum(cast(l_extendedprice as decimal(18,2))) as amt from lineitem group by 1, 2"""


def month_totals(t: Tables):
    return t.lineitem.groupBy("l_returnflag", F.trunc("l_shipdate", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amt")
    )


@query("s02_s12_partitions", "l_returnflag:s month:D n:l amt:d", f"select * from ({MONTH_TOTALS}) where l_returnflag = 'R'")
def partitions(t: Tables):
    path = fresh(t, "partitions")
    sources.write_partitions(month_totals(t), path, "l_returnflag")
    # Writing one partition again leaves the others as they are.
    sources.write_partitions(month_totals(t).where("l_returnflag = 'A'"), path, "l_returnflag")
    return sources.read_partition(t.spark, path, "l_returnflag", "R")


@query("s12_history_append", "l_returnflag:s month:D n:l amt:d", MONTH_TOTALS)
def history_append(t: Tables):
    """A history folder that is read to find what it lacks and written to by partition."""
    path = fresh(t, "history")
    known = month_totals(t)
    sources.write_partitions(known.where("l_returnflag <> 'R' and month(month) < 7"), path, "l_returnflag")
    history = sources.read_table(t.spark, path)
    new = known.join(history.select("l_returnflag", "month"), ["l_returnflag", "month"], "left_anti")
    sources.write_partitions(history.unionByName(new), path, "l_returnflag")
    return sources.read_table(t.spark, path)


@query("s03_read_format", "n_nationkey:l n_name:s n:l",
       "select n.n_nationkey, n.n_name, count(*) as n from nation n join customer c on n.n_nationkey = c.c_nationkey group by 1, 2")
def read_format(t: Tables):
    path = fresh(t, "format")
    sources.write_table(t.customer.select("c_custkey", "c_nationkey"), path, fmt="orc")
    customers = sources.read_table(t.spark, path, fmt="orc", columns=["c_nationkey"])
    named = t.nation.join(customers, F.col("n_nationkey") == F.col("c_nationkey"))
    return named.groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).alias("n"))


@query("s04_s07_views_and_catalog", "user_id:l n:l", "select user_id, count(*) as n from events group by 1")
def views(t: Tables):
    sources.register_views({"tidewell_events": t.events})
    return sources.read_catalog(t.spark, "tidewell_events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("s05_s13_csv", "l_returnflag:s month:D n:l amt:d", MONTH_TOTALS)
def csv(t: Tables):
    path = fresh(t, "csv")
    sources.write_csv(month_totals(t), path, single=True)
    return sources.read_csv(t.spark, path, "l_returnflag string, month date, n bigint, amt decimal(28,2)")


@query("s06_load_tables", "o_custkey:l n:l", "select o_custkey, count(*) as n from orders join customer on o_custkey = c_custkey group by 1")
def load(t: Tables):
    tables = sources.load_tables(t.spark, ["/nowhere", t.dir], ["orders.parquet", "CUSTOMER.parquet".lower()])
    joined = tables["orders"].join(tables["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("s08_s10_column_names", "o_orderkey:l total:d", "select o_orderkey, o_totalprice as total from orders")
def column_names(t: Tables):
    raw = t.orders.select(F.col("o_orderkey").alias("O_ORDERKEY"), F.col("o_totalprice").alias(" rep_Total_PREDICTION "))
    return sources.lower_columns(sources.clean_columns(raw, drop=["rep_", "_PREDICTION"]))


@query("s11_write_table", "l_returnflag:s month:D n:l amt:d", MONTH_TOTALS)
def write(t: Tables):
    path = fresh(t, "table")
    sources.write_table(month_totals(t), path)
    return sources.read_table(t.spark, path)


@query("s14_export_reports", "agt_cd:l n:l",
       "select s_suppkey as agt_cd, n from supplier left join (select agt_code, count(*) as n from e_policy where pol_stat_cd = '1' group by 1) on s_suppkey = agt_code")
def export(t: Tables):
    agents = t.supplier.select(F.col("s_suppkey").alias("agt_cd"))
    active = t.e_policy.where("pol_stat_cd = '1'").groupBy(F.col("agt_code").alias("agt_cd")).agg(F.count(F.lit(1)).alias("n"))
    written = sources.export_reports({"active": active}, agents, fresh(t, "export"))
    return sources.read_csv(t.spark, written["active"], "agt_cd bigint, n bigint")


@query("s15_run_sql", "o_custkey:l n:l",
       "select o_custkey, count(*) as n from orders where o_totalprice > 50000 and o_orderpriority = '5-LOW' group by 1")
def run_sql(t: Tables):
    return sources.run_sql(
        t.spark,
        "select o_custkey, count(*) as n from {orders} where o_totalprice > :floor and o_orderpriority = :priority group by o_custkey",
        {"floor": 50000, "priority": "5-LOW"},
        {"orders": t.orders},
    )


@query("s16_report_calendar", "pol_num:l in_month:s token:s",
       """select pol_num, case when last_day(pol_iss_dt) = date '2000-04-30' then 'Y' else 'N' end as in_month, '0004' as token from e_policy""")  # fmt: skip
def calendar(t: Tables):
    cal = sources.report_calendar(ORDERS_AS_OF, 1)
    in_month = F.when(F.last_day("pol_iss_dt") == F.lit(cal.report_date), "Y").otherwise("N")
    return t.e_policy.select("pol_num", in_month.alias("in_month"), F.lit(cal.token).alias("token"))
