"""Aggregates as queries, one per operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import mean_of, ratio
from ..operators import (
    median_of,
    Metric,
    any_value_of,
    best_by_distinct_count,
    count_if,
    debit_credit_net,
    densify,
    kpi_block,
    Kpi,
    rolling_kpis,
    settle,
    signed_sum,
    sum_if,
    text_list,
    top_list_by,
    value_set,
    weighted_sum,
)
from .entities import money
from .registry import Tables, query


@query("a01_group_count", "event_type:s n:l", "select event_type, count(*) as n from events group by 1")
def a01(t: Tables):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a02_distinct_count", "event_type:s users:l", "select event_type, count(distinct user_id) as users from events group by 1")
def a02(t: Tables):
    return t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@query("a03_sum", "l_returnflag:s l_linestatus:s amt:d",
       f"select l_returnflag, l_linestatus, sum({money('l_extendedprice')}) as amt from lineitem group by 1, 2")
def a03(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amt")
    )


@query("a04_conditional_aggregates", "pol_num:l base:d riders:l kept:l",
       """select pol_num, sum(case when cvg_typ = 'B' then cvg_prem else 0 end) as base, count(case when cvg_typ = 'R' then cli_num end) as riders,
  sum(case when cvg_del_dt is null then 1 else 0 end) as kept from e_coverage group by 1""")  # fmt: skip
def a04(t: Tables):
    return t.e_coverage.groupBy("pol_num").agg(
        sum_if(F.col("cvg_typ") == "B", "cvg_prem").alias("base"),
        count_if(F.col("cvg_typ") == "R", "cli_num").alias("riders"),
        sum_if(F.col("cvg_del_dt").isNull(), F.lit(1)).alias("kept"),
    )


@query("a05_conditional_distinct", "plan_code:s base_clients:l late_clients:l",
       """select plan_code, count(distinct case when cvg_typ = 'B' then cli_num end) as base_clients,
  count(distinct case when cvg_eff_dt >= date '2000-01-01' then cli_num end) as late_clients from e_coverage group by 1""")  # fmt: skip
def a05(t: Tables):
    """Per plan and client once; the distinct counts are then plain counts."""
    once = t.e_coverage.groupBy("plan_code", "cli_num").agg(
        F.max(F.col("cvg_typ") == "B").alias("base"), F.max(F.col("cvg_eff_dt") >= "2000-01-01").alias("late")
    )
    return once.groupBy("plan_code").agg(
        count_if(F.col("base"), "cli_num").alias("base_clients"), count_if(F.col("late"), "cli_num").alias("late_clients")
    )


@query("a06_signed_sum", "acct_num:s balance:d",
       "select acct_num, sum(case when cr_or_dr = 'C' then 1 else -1 end * acct_gen_amt) as balance from e_ledger group by 1")
def a06(t: Tables):
    return t.e_ledger.groupBy("acct_num").agg(signed_sum("acct_gen_amt", "cr_or_dr").alias("balance"))


@query("a07_debit_credit_net", "acct_num:s debit:d credit:d net:d",
       """select acct_num, sum(case when cr_or_dr = 'D' then acct_gen_amt * 1000 else 0 end) as debit,
  sum(case when cr_or_dr = 'C' then acct_gen_amt * 1000 else 0 end) as credit,
  sum(case when cr_or_dr = 'D' then acct_gen_amt * 1000 else -acct_gen_amt * 1000 end) as net from e_ledger group by 1""")  # fmt: skip
def a07(t: Tables):
    return t.e_ledger.groupBy("acct_num").agg(*debit_credit_net("acct_gen_amt", "cr_or_dr", 1000))


@query("a08_weighted_sum", "agt_code:l fyp:d",
       """select agt_code, sum(case when typ = 'FYP' then amt when typ in ('FYP-TOPUP', 'SP') then cast(0.06 as decimal(5,4)) * amt else 0 end) as fyp
  from e_work group by 1""")  # fmt: skip
def a08(t: Tables):
    weights = {"FYP": "1", "FYP-TOPUP": "0.06", "SP": "0.06"}
    return t.e_work.groupBy("agt_code").agg(weighted_sum("amt", "typ", weights).alias("fyp"))


@query("a09_min_max", "pol_num:l first:D last:D",
       """select pol_num, min(d) as first, max(d) as last from (select pol_num, trxn_dt as d from e_batch_detail union all
  select pol_num, input_dt from e_outstanding union all select pol_num, sbmt_date from e_change_ctl) group by 1""")  # fmt: skip
def a09(t: Tables):
    dates = (
        t.e_batch_detail.select("pol_num", F.col("trxn_dt").alias("d"))
        .unionByName(t.e_outstanding.select("pol_num", F.col("input_dt").alias("d")))
        .unionByName(t.e_change_ctl.select("pol_num", F.col("sbmt_date").alias("d")))
    )
    return dates.groupBy("pol_num").agg(F.min("d").alias("first"), F.max("d").alias("last"))


@query("a10_sum_null_as_zero", "agt_cd:l amt:d", "select agt_cd, sum(coalesce(crr_valu, 0)) as amt from e_commission group by 1")
def a10(t: Tables):
    return t.e_commission.groupBy("agt_cd").agg(F.sum(F.coalesce("crr_valu", F.lit(0))).alias("amt"))


@query("a11_ratio", "event_type:s share:d mean:d",
       """select event_type, cast(count(case when value > 50 then 1 end) as double) / nullif(count(case when value > 10 then 1 end), 0) as share,
  cast(sum(cast(value as decimal(18,2))) as double) / count(*) as mean from events group by 1""")  # fmt: skip
def a11(t: Tables):
    return t.events.groupBy("event_type").agg(
        ratio(count_if(F.col("value") > 50), count_if(F.col("value") > 10)).alias("share"),
        ratio(F.sum(F.col("value").cast("decimal(18,2)")), F.count(F.lit(1))).alias("mean"),
    )


@query("a12_divided_by_key", "plan_code:s prem_dur:l per_year:d",
       "select plan_code, prem_dur, cast(sum(cvg_prem) as double) / prem_dur as per_year from e_coverage group by 1, 2")
def a12(t: Tables):
    return t.e_coverage.groupBy("plan_code", "prem_dur").agg(ratio(F.sum("cvg_prem"), F.col("prem_dur")).alias("per_year"))


@query("a13_value_set", "user_id:l types:s",
       "select user_id, string_agg(distinct event_type, '|' order by event_type) as types from events group by 1")
def a13(t: Tables):
    sets = t.events.groupBy("user_id").agg(value_set("event_type").alias("types"))
    return sets.withColumn("types", F.concat_ws("|", "types"))


@query("a14_any_value", "pol_num:l par_code:s", "select pol_num, min(par_code) as par_code from e_coverage group by 1")
def a14(t: Tables):
    return t.e_coverage.groupBy("pol_num").agg(any_value_of("par_code").alias("par_code"))


@query("a15_text_list", "pol_num:l codes:s",
       "select pol_num, coalesce(string_agg(distinct par_code, ',' order by par_code), '') as codes from e_coverage group by 1")
def a15(t: Tables):
    return t.e_coverage.groupBy("pol_num").agg(text_list("par_code").alias("codes"))


@query("a16_ordered_list", "agt_code:l pol_num:s",
       """select agt_code, string_agg(cast(pol_num as varchar), ',' order by rn) as pol_num from (select *, row_number() over (partition by agt_code
  order by mode_prem desc, pol_num) as rn from e_policy) where rn <= 3 group by 1""")  # fmt: skip
def a16(t: Tables):
    best = top_list_by(t.e_policy, ["agt_code"], [F.col("mode_prem").desc(), F.col("pol_num")], "pol_num", 3, "pol_num")
    return best.withColumn("pol_num", F.concat_ws(",", F.col("pol_num").cast("array<string>")))


@query("a17_having", "acct_num:s pol_num:l balance:d",
       """select acct_num, pol_num, sum(case when cr_or_dr = 'C' then acct_gen_amt else -acct_gen_amt end) as balance from e_ledger
  group by 1, 2 having sum(case when cr_or_dr = 'C' then acct_gen_amt else -acct_gen_amt end) < 0""")  # fmt: skip
def a17(t: Tables):
    sums = t.e_ledger.groupBy("acct_num", "pol_num").agg(signed_sum("acct_gen_amt", "cr_or_dr").alias("balance"))
    return sums.where(F.col("balance") < 0)


@query("a18_having_on_key", "par_code:s n:l", "select par_code, count(*) as n from e_coverage group by 1 having par_code is not null")
def a18(t: Tables):
    return t.e_coverage.where(F.col("par_code").isNotNull()).groupBy("par_code").agg(F.count(F.lit(1)).alias("n"))


@query("a19_group_by_expression", "type:s event_month:D n:l",
       "select 'issued' as type, last_day(pol_iss_dt) as event_month, count(*) as n from e_policy group by 'issued', 2")
def a19(t: Tables):
    by_month = t.e_policy.groupBy(F.lit("issued").alias("type"), F.last_day("pol_iss_dt").alias("event_month"))
    return by_month.agg(F.count(F.lit(1)).alias("n"))


@query("a20_global_aggregate", "n:l none:l total:d",
       "select count(*) as n, count(case when pol_stat_cd = '?' then 1 end) as none, sum(mode_prem) as total from e_policy")
def a20(t: Tables):
    return t.e_policy.agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("pol_stat_cd") == "?").alias("none"), F.sum("mode_prem").alias("total")
    )


@query("a21_best_flag", "pol_num:l has_base:s",
       "select pol_num, max(case when cvg_typ = 'B' then 'Y' else 'N' end) as has_base from e_coverage group by 1")
def a21(t: Tables):
    return t.e_coverage.groupBy("pol_num").agg(F.max(F.when(F.col("cvg_typ") == "B", "Y").otherwise("N")).alias("has_base"))


@query("a22_group_to_deduplicate", "pol_num:l plan_code:s cvg_typ:s first:D",
       "select pol_num, plan_code, cvg_typ, min(cvg_eff_dt) as first from e_coverage group by 1, 2, 3")
def a22(t: Tables):
    return t.e_coverage.groupBy("pol_num", "plan_code", "cvg_typ").agg(F.min("cvg_eff_dt").alias("first"))


@query("a23_mean", "plan_code:s mean:d",
       "select plan_code, cast(sum(cvg_prem) as double) / count(cvg_prem) as mean from e_coverage group by 1")
def a23(t: Tables):
    return t.e_coverage.groupBy("plan_code").agg(mean_of("cvg_prem").alias("mean"))


@query("a24_benchmarks", "agt_code:l premium:d n:l median_n:d share:d above:s",
       """with a as (select agt_code, sum(mode_prem) as premium, count(*) as n from e_policy group by 1),
b as (select median(n) as median_n, cast(sum(premium) as double) / sum(n) as share from a)
select a.*, b.*, case when n > median_n then 'Y' else 'N' end as above from a cross join b""")  # fmt: skip
def a24(t: Tables):
    """The one-row benchmark is a scalar of the settled per-agent table."""
    own = settle(t.e_policy.groupBy("agt_code").agg(F.sum("mode_prem").alias("premium"), F.count(F.lit(1)).alias("n")))
    bench = own.agg(ratio(F.sum("premium"), F.sum("n")).alias("share")).withColumn("median_n", median_of(own, "n"))
    wide = own.withColumn("b", bench.select(F.struct("*")).scalar())
    return wide.select(
        "agt_code", "premium", "n", "b.median_n", "b.share",
        F.when(F.col("n") > F.col("b.median_n"), "Y").otherwise("N").alias("above"),
    )


@query("a25_two_level", "agt_code:l best:d mean:d",
       """select agt_code, max(s) as best, cast(sum(s) as double) / count(*) as mean from (select agt_code, last_day(pol_iss_dt) as m, sum(mode_prem) as s
  from e_policy group by 1, 2) group by 1""")  # fmt: skip
def a25(t: Tables):
    monthly = t.e_policy.groupBy("agt_code", F.last_day("pol_iss_dt").alias("m")).agg(F.sum("mode_prem").alias("s"))
    return monthly.groupBy("agt_code").agg(F.max("s").alias("best"), mean_of("s").alias("mean"))


@query("a26_densify", "agt_code:l m:s premium:d",
       """with s as (select agt_code, strftime(pol_iss_dt, '%Y-%m') as m, sum(mode_prem) as premium from e_policy where year(pol_iss_dt) = 1999 group by 1, 2)
select x.agt_code, d.m, coalesce(s.premium, 0) as premium from (select distinct agt_code from s) x cross join (select distinct m from s) d
left join s on s.agt_code = x.agt_code and s.m = d.m""")  # fmt: skip
def a26(t: Tables):
    year = t.e_policy.where("pol_iss_dt between date '1999-01-01' and date '1999-12-31'")
    rows = year.select("agt_code", F.date_format("pol_iss_dt", "yyyy-MM").alias("m"), F.col("mode_prem").alias("premium"))
    return densify(rows, "agt_code", "m", "premium", 0)


@query("a27_best_by_distinct_dates", "plan_code:s type:s times:l",
       """select plan_code, customer_needs as type, n as times from (select plan_code, customer_needs, count(distinct effective_date) as n,
  row_number() over (partition by plan_code order by count(distinct effective_date) desc, customer_needs) as rn from e_rate_quarter group by 1, 2)
  where rn = 1""")  # fmt: skip
def a27(t: Tables):
    return best_by_distinct_count(t.e_rate_quarter, "plan_code", "customer_needs", "effective_date", "type")


_WINDOWS = (("last_mth", 1), ("last_yr", 12), ("last_3m", 3), ("last_6m", 6))


@query(
    "a28_rolling_kpis",
    "agt_code:l " + " ".join(f"{w}_ape:d {w}_cus:l" for w, _ in _WINDOWS),
    "select agt_code, "
    + ", ".join(
        f"""sum(case when m between -{n} and -1 then mode_prem end) as {w}_ape,
  case when count(case when m between -{n} and -1 then 1 end) > 0 then count(distinct case when m between -{n} and -1 then po_num end) end as {w}_cus"""
        for w, n in _WINDOWS
    )
    + """ from (select p.*, o.po_num, year(p.pol_iss_dt) * 12 + month(p.pol_iss_dt) - (2000 * 12 + 5) - 1 as m from e_policy p
  join e_policy_mart o on p.pol_num = o.pol_num) where m between -12 and -1 group by 1""",
)
def a28(t: Tables):
    rows = t.e_policy.join(t.e_policy_mart.select("pol_num", "po_num"), "pol_num").withColumn(
        "m", F.year("pol_iss_dt") * 12 + F.month("pol_iss_dt") - (2000 * 12 + 5) - 1
    )
    return rolling_kpis(rows, "agt_code", "m", [Metric("ape", "sum", "mode_prem"), Metric("cus", "distinct", "po_num")])


@query("a28_kpi_block", "kpi:s kpi_sub:s channel:s kpi_val:d",
       """select 'customers' as kpi, gender as kpi_sub, channel, count(*) as kpi_val from e_customer_month group by 2, 3 union all
  select 'held', null, channel, cast(sum(tot_ape) as double) / sum(prod_cnt) from e_customer_month group by 3""")  # fmt: skip
def kpi_lines(t: Tables):
    lines = [Kpi("customers", F.lit(1), F.col("gender")), Kpi("held", F.col("tot_ape"), None, F.col("prod_cnt"))]
    return kpi_block(t.e_customer_month, lines, ["channel"])
