"""Projections, filters and column functions as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import first_by
from .entities import EVENTS_AS_OF, ORDERS_AS_OF, REPORT_DATE
from .registry import Tables, query
from .reports_ledger import norm_phone, whole_months_sql

RPT = f"date '{REPORT_DATE}'"


@query("p01_project_rename", "policy_number:l premium:d status:s",
       "select pol_num as policy_number, mode_prem as premium, pol_stat_cd as status from e_policy")
def p01(t: Tables):
    return t.e_policy.select(
        F.col("pol_num").alias("policy_number"), F.col("mode_prem").alias("premium"), F.col("pol_stat_cd").alias("status")
    )


@query("p02_constant_column", "pol_num:l rowtype:s", "select pol_num, '1' as rowtype from e_policy")
def p02(t: Tables):
    return t.e_policy.select("pol_num", F.lit("1").alias("rowtype"))


@query("p03_comparison", "pol_num:l", f"select pol_num from e_policy where pol_iss_dt <= {RPT} and mode_prem > 100000")
def p03(t: Tables):
    return t.e_policy.where((F.col("pol_iss_dt") <= REPORT_DATE) & (F.col("mode_prem") > 100000)).select("pol_num")


@query("p04_in_list", "pol_num:l pol_stat_cd:s",
       "select pol_num, pol_stat_cd from e_policy where pol_stat_cd in ('1','2','3','5') and plan_code_base not in ('MI007', 'CA360')")
def p04(t: Tables):
    keep = F.col("pol_stat_cd").isin("1", "2", "3", "5") & ~F.col("plan_code_base").isin("MI007", "CA360")
    return t.e_policy.where(keep).select("pol_num", "pol_stat_cd")


@query("p05_like_any", "page_id:l",
       "select page_id from pages where lower(url) like '%/en/%' or lower(url) like 'https://m.%' or lower(url) like '%.org/%'")
def p05(t: Tables):
    return t.pages.where(fx.like_any("url", ["%/en/%", "https://m.%", "%.org/%"])).select("page_id")


@query("p06_between", "pol_num:l",
       f"select pol_num from e_policy where pol_iss_dt between date '1999-06-01' and {RPT} and mode_prem between 5000 and 90000")
def p06(t: Tables):
    return t.e_policy.where(
        F.col("pol_iss_dt").between("1999-06-01", REPORT_DATE) & F.col("mode_prem").between(5000, 90000)
    ).select("pol_num")


@query("p07_null_tests", "pol_num:l",
       "select pol_num from e_policy where pol_trmn_dt is null and nb_user_id is not null")
def p07(t: Tables):
    return t.e_policy.where(F.col("pol_trmn_dt").isNull() & F.col("nb_user_id").isNotNull()).select("pol_num")


@query("p08_value_or_null", "pol_num:l nb_user_id:s",
       "select pol_num, nb_user_id from e_policy where nb_user_id = 'EPOS' or nb_user_id is null")
def p08(t: Tables):
    return t.e_policy.where(fx.is_or_null("nb_user_id", "EPOS")).select("pol_num", "nb_user_id")


@query("p09_any_not_null", "id:s",
       "select id from e_lead where website is not null or utmcampaignsource__c is not null or utmcampaignmedium__c is not null")
def p09(t: Tables):
    return t.e_lead.where(fx.any_not_null(["website", "utmcampaignsource__c", "utmcampaignmedium__c"])).select("id")


@query("p10_case_dependent_date", "pol_num:l chg_typ:s",
       """select c.pol_num, k.chg_typ from e_check k join e_change_ctl c on k.pol_num = c.pol_num left join e_termination x on c.pol_num = x.pol_num
  where (k.chg_typ = '37' and greatest(c.comp_date, coalesce(x.trmn_actv_dt, c.comp_date)) >= date '2000-02-29')
    or (k.chg_typ <> '37' and c.comp_date >= date '2000-02-29')""")  # fmt: skip
def p10(t: Tables):
    rows = t.e_check.join(t.e_change_ctl, "pol_num").join(t.e_termination, "pol_num", "left")
    ended = F.greatest("comp_date", F.coalesce("trmn_actv_dt", "comp_date"))
    relevant = F.when(F.col("chg_typ") == "37", ended).otherwise(F.col("comp_date"))
    return rows.where(fx.since(relevant, ORDERS_AS_OF, months=4)).select("pol_num", "chg_typ")


@query("p12_distinct", "plan_code:s cvg_typ:s par_code:s", "select distinct plan_code, cvg_typ, par_code from e_coverage")
def p12(t: Tables):
    return t.e_coverage.select("plan_code", "cvg_typ", "par_code").distinct()


@query("p13_keep_first", "pol_num:l cvg_eff_dt:D cvg_prem:d",
       """select * from (select distinct pol_num, cvg_eff_dt, cvg_prem, row_number() over (partition by pol_num order by cvg_eff_dt, cvg_prem)
  as rn from e_coverage) where rn = 1""")  # fmt: skip
def p13(t: Tables):
    return first_by(t.e_coverage, ["pol_num"], [F.col("cvg_eff_dt"), F.col("cvg_prem")])


@query("p14_value_map", "pol_num:l text:s",
       "select pol_num, case pmt_mode when '12' then 'yearly' when '06' then 'half-yearly' else 'other' end as text from e_policy")
def p14(t: Tables):
    return t.e_policy.select("pol_num", fx.value_map("pmt_mode", {"12": "yearly", "06": "half-yearly"}, "other").alias("text"))


@query("p15_searched_case", "pol_num:l kind:s",
       """select pol_num, case when pol_stat_cd in ('1','2') then case when pmt_mode = '12' then 'paying yearly' else 'paying' end
  when pol_trmn_dt is not null then 'ended' else 'other' end as kind from e_policy""")  # fmt: skip
def p15(t: Tables):
    paying = F.when(F.col("pmt_mode") == "12", "paying yearly").otherwise("paying")
    kind = F.when(F.col("pol_stat_cd").isin("1", "2"), paying).when(F.col("pol_trmn_dt").isNotNull(), "ended").otherwise("other")
    return t.e_policy.select("pol_num", kind.alias("kind"))


@query("p16_band", "po_num:l band:s",
       """select po_num, case when tot_ape < 20000 then 'low' when tot_ape >= 20000 and tot_ape < 65000 then 'mid' when tot_ape >= 65000
  and tot_ape < 200000 then 'high' else 'top' end as band from e_customer_month""")  # fmt: skip
def p16(t: Tables):
    return t.e_customer_month.select(
        "po_num", fx.band("tot_ape", [None, 20000, 65000, 200000], ["low", "mid", "high"], "top").alias("band")
    )


@query("p17_since", "event_id:l kind:s",
       """select event_id, 'days' as kind from events where cast(ts as date) >= date '2024-01-31' - 7 union all
  select o_orderkey, 'months' from orders where cast(o_orderdate as date) >= date '2000-02-29'""")  # fmt: skip
def p17(t: Tables):
    recent = t.events.where(fx.since(F.col("ts").cast("date"), EVENTS_AS_OF, days=7)).select("event_id", F.lit("days").alias("kind"))
    late = t.orders.where(fx.since(F.col("o_orderdate").cast("date"), ORDERS_AS_OF, months=4))
    return recent.unionByName(late.select(F.col("o_orderkey").alias("event_id"), F.lit("months").alias("kind")))


@query("p18_flags", "pol_num:l lapsed:l ended:l",
       """select pol_num, case when pol_stat_cd = 'B' then 1 else 0 end as lapsed, case when pol_trmn_dt <= date '2000-05-31' then 1 else 0 end as ended
  from e_policy""")  # fmt: skip
def p18(t: Tables):
    return t.e_policy.select(
        "pol_num", fx.flag(F.col("pol_stat_cd") == "B").alias("lapsed"), fx.flag(F.col("pol_trmn_dt") <= REPORT_DATE).alias("ended")
    )


@query("p19_yes_no", "pol_num:l by_user:s late:s",
       """select pol_num, case when nb_user_id = 'EPOS' then 'Y' else 'N' end as by_user, case when pol_trmn_dt > date '2000-05-31' then 'Y'
  else 'N' end as late from e_policy""")  # fmt: skip
def p19(t: Tables):
    return t.e_policy.select(
        "pol_num", fx.yn(F.col("nb_user_id") == "EPOS").alias("by_user"), fx.yn(F.col("pol_trmn_dt") > REPORT_DATE).alias("late")
    )


@query("p20_blank_columns", "pol_num:l plan_code_base:s wa_cd_1:l mode_prem:d",
       """select pol_num, case when pol_stat_cd = 'X' then null else plan_code_base end as plan_code_base,
  case when pol_stat_cd = 'X' then null else wa_cd_1 end as wa_cd_1, case when pol_stat_cd = 'X' then 0 else mode_prem end as mode_prem
  from e_policy""")  # fmt: skip
def p20(t: Tables):
    return fx.null_when(t.e_policy, F.col("pol_stat_cd") == "X", ["plan_code_base", "wa_cd_1"], ["mode_prem"])


@query("p21_ranked_or_null", "pol_num:l clm_id:l",
       """select pol_num, clm_id from (select p.pol_num, c.clm_id, row_number() over (partition by p.pol_num order by c.clm_id) as rn
  from e_policy p left join (select distinct pol_num, clm_id from e_pack_claim) c on p.pol_num = c.pol_num) where clm_id is null or rn = 1""")  # fmt: skip
def p21(t: Tables):
    # No claim but a policy's least one can be picked, so the others go before the shuffle; a claim without a number stays a row.
    claims = t.e_pack_claim.groupBy("pol_num").agg(
        F.min("clm_id").alias("clm_id"), F.bool_or(F.col("clm_id").isNull()).alias("unnumbered")
    )
    rows = t.e_policy.select("pol_num").join(claims, "pol_num", "left")
    with_claim = first_by(rows.where(F.col("clm_id").isNotNull()), ["pol_num"], [F.col("clm_id")]).drop("unnumbered")
    without = rows.where(F.col("clm_id").isNull() | F.col("unnumbered"))
    return without.select("pol_num", F.lit(None).cast(rows.schema["clm_id"].dataType).alias("clm_id")).unionByName(with_claim)


@query("p22_named_steps", "agt_code:l n:l share:d",
       """with paying as (select * from e_policy where pol_stat_cd in ('1','2','3','5')), per as (select agt_code, count(*) as n from paying group by 1)
select agt_code, n, cast(n as double) / (select sum(n) from per) as share from per""")  # fmt: skip
def p22(t: Tables):
    paying = t.e_policy.where(F.col("pol_stat_cd").isin("1", "2", "3", "5"))
    per = paying.groupBy("agt_code").agg(F.count(F.lit(1)).alias("n"))
    total = paying.agg(F.count(F.lit(1))).scalar()
    return per.select("agt_code", "n", fx.ratio(F.col("n"), total).alias("share"))


# Text functions.
@query("f01_f04_substrings", "c_custkey:l head:s tail:s no_first:s no_last:s",
       """select c_custkey, substr(c_name, 1, 3) as head, right(c_name, 9) as tail, substr(c_name, 2) as no_first,
  substr(c_name, 1, length(c_name) - 3) as no_last from customer""")  # fmt: skip
def substrings(t: Tables):
    return t.customer.select(
        "c_custkey", F.substring("c_name", 1, 3).alias("head"), fx.last_chars("c_name", 9).alias("tail"),
        fx.drop_first("c_name").alias("no_first"), fx.drop_last("c_name", 3).alias("no_last"),
    )


@query("f05_f06_concat", "cli_num:l strict:s skipping:s",
       """select cli_num, mobl_phon_num || '/' || cli_num as strict, concat_ws('-', cli_nm, mobl_phon_num, prim_phon_num) as skipping from e_client""")  # fmt: skip
def concats(t: Tables):
    return t.e_client.select(
        "cli_num", F.concat("mobl_phon_num", F.lit("/"), F.col("cli_num").cast("string")).alias("strict"),
        F.concat_ws("-", "cli_nm", "mobl_phon_num", "prim_phon_num").alias("skipping"),
    )


@query("f07_case_trim_length", "id:s u:s l:s n:l",
       "select id, upper(trim(lastname)) as u, lower(status) as l, length(trim(email)) as n from e_lead")
def case_trim(t: Tables):
    return t.e_lead.select(
        "id", fx.fold("lastname").alias("u"), F.lower("status").alias("l"), F.length(F.trim("email")).alias("n")
    )


@query("f08_f09_phone", "cli_num:l clean:s phone:s",
       f"""select cli_num, regexp_replace(trim(mobl_phon_num), '[^0-9A-Za-z]', '', 'g') as clean, {norm_phone("mobl_phon_num")} as phone
  from e_client""")  # fmt: skip
def phones(t: Tables):
    return t.e_client.select("cli_num", fx.keep_alnum("mobl_phon_num").alias("clean"), fx.normalize_phone("mobl_phon_num").alias("phone"))


@query("f08_alnum_of_documents", "doc_id:l clean:s",
       "select doc_id, sha256(regexp_replace(trim(text), '[^0-9A-Za-z]', '', 'g')) as clean from documents")
def document_alnum(t: Tables):
    return t.documents.select("doc_id", fx.sha256_text(fx.keep_alnum("text")).alias("clean"))


@query("f10_f11_contains", "doc_id:l has_the:s in_list:s starts:s",
       """select doc_id, case when instr(text, ' the ') > 0 then 'Y' else 'N' end as has_the, case when source in ('src1','src2') then 'Y' else 'N' end
  as in_list, case when lang like 'e%' then 'Y' else 'N' end as starts from documents""")  # fmt: skip
def contains(t: Tables):
    return t.documents.select(
        "doc_id", fx.yn(fx.contains("text", " the ")).alias("has_the"), fx.yn(F.col("source").isin("src1", "src2")).alias("in_list"),
        fx.yn(F.col("lang").like("e%")).alias("starts"),
    )


# Date functions.
@query("f12_f14_date_steps", "pol_num:l age_days:l later:D earlier:D added:D month_end:D back:D",
       f"""select pol_num, date '{ORDERS_AS_OF}' - pol_iss_dt as age_days, pol_iss_dt + 10 as later, pol_iss_dt - 10 as earlier,
  cast(pol_iss_dt + interval 3 month as date) as added, last_day(pol_iss_dt) as month_end, last_day(pol_iss_dt - interval 4 month) as back
  from e_policy""")  # fmt: skip
def date_steps(t: Tables):
    return t.e_policy.select(
        "pol_num", F.datediff(F.lit(fx.day(ORDERS_AS_OF)), "pol_iss_dt").alias("age_days"), F.date_add("pol_iss_dt", 10).alias("later"),
        F.date_sub("pol_iss_dt", 10).alias("earlier"), F.add_months("pol_iss_dt", 3).alias("added"),
        F.last_day("pol_iss_dt").alias("month_end"), fx.month_end_of("pol_iss_dt", -4).alias("back"),
    )


@query("f15_whole_months", "pol_num:l months:l years:l",
       f"""select pol_num, {whole_months_sql(RPT, "pol_eff_dt")} as months, cast(floor({whole_months_sql(RPT, "pol_eff_dt")} / 12) as int) as years
  from e_policy""")  # fmt: skip
def whole(t: Tables):
    end = F.lit(fx.day(REPORT_DATE))
    return t.e_policy.select("pol_num", fx.whole_months(end, "pol_eff_dt").alias("months"), fx.whole_years(end, "pol_eff_dt").alias("years"))


@query("f16_datediff", "pol_num:l days:l years:d",
       "select pol_num, abs(cnfrm_acpt_dt - pol_eff_dt) as days, (pol_eff_dt - sbmt_dt) / 365.25 as years from e_policy")
def days_between(t: Tables):
    return t.e_policy.select(
        "pol_num", F.abs(F.datediff("cnfrm_acpt_dt", "pol_eff_dt")).alias("days"),
        (F.datediff("pol_eff_dt", "sbmt_dt").cast("double") / F.lit(365.25).cast("double")).alias("years"),
    )


@query("f17_f18_calendar_parts", "pol_num:l y:l m:l q:l same_m:s same_q:s same_y:s",
       """select pol_num, year(pol_iss_dt) as y, month(pol_iss_dt) as m, quarter(pol_iss_dt) as q,
  case when last_day(pol_iss_dt) = last_day(pol_eff_dt) then 'Y' else 'N' end as same_m,
  case when year(pol_iss_dt) = year(sbmt_dt) and quarter(pol_iss_dt) = quarter(sbmt_dt) then 'Y' else 'N' end as same_q,
  case when year(pol_iss_dt) = year(sbmt_dt) then 'Y' else 'N' end as same_y from e_policy""")  # fmt: skip
def calendar_parts(t: Tables):
    return t.e_policy.select(
        "pol_num", F.year("pol_iss_dt").alias("y"), F.month("pol_iss_dt").alias("m"), F.quarter("pol_iss_dt").alias("q"),
        fx.yn(fx.same_month("pol_iss_dt", "pol_eff_dt")).alias("same_m"), fx.yn(fx.same_quarter("pol_iss_dt", "sbmt_dt")).alias("same_q"),
        fx.yn(fx.same_year("pol_iss_dt", "sbmt_dt")).alias("same_y"),
    )


@query("f19_months_apart", "pol_num:l m:l",
       "select pol_num, 12 * (year(pd_to_dt) - year(pol_iss_dt)) + month(pd_to_dt) - month(pol_iss_dt) as m from e_policy")
def months(t: Tables):
    return t.e_policy.select("pol_num", fx.months_apart("pd_to_dt", "pol_iss_dt").alias("m"))


@query("f20_f21_to_date_and_text", "agt_cd:l first:D ym:s cut:D",
       """select agt_cd, cast(try_strptime(qualify_date, '%Y%m') as date) as first, strftime(try_strptime(qualify_date, '%Y%m'), '%Y-%m') as ym,
  cast(substr(strftime(try_strptime(qualify_date, '%Y%m'), '%Y-%m-%d') || ' 10:00:00', 1, 10) as date) as cut from e_allowance""")  # fmt: skip
def to_date(t: Tables):
    first = fx.first_day_from_yyyymm("qualify_date")
    stamp = F.concat(F.date_format(first, "yyyy-MM-dd"), F.lit(" 10:00:00"))
    return t.e_allowance.select(
        "agt_cd", first.alias("first"), fx.year_month(first).alias("ym"), F.try_to_date(F.substring(stamp, 1, 10)).alias("cut")
    )


@query("f22_mixed_timestamp", "_id:l d:D",
       """select _id, case when instr(created, '-') > 0 then try_cast(substr(created, 1, 10) as date)
  else cast(make_timestamp(try_cast(created as bigint) // 1000 * 1000000) as date) end as d from e_user""")  # fmt: skip
def mixed(t: Tables):
    return t.e_user.select("_id", fx.parse_mixed_ts("created").alias("d"))


@query("f23_lagged_quarter", "pol_num:l q:s",
       """select pol_num, cast(year(pol_iss_dt) + case when floor(month(pol_iss_dt) / 3.1) <= 1 then -1 else 0 end as varchar) || ' Q' ||
  cast(case floor(month(pol_iss_dt) / 3.1) when 0 then 3 when 1 then 4 when 2 then 1 else 2 end as varchar) as q from e_policy""")  # fmt: skip
def lagged(t: Tables):
    return t.e_policy.select("pol_num", fx.quarter_label("pol_iss_dt").alias("q"))


@query("f24_offsets", "pol_num:l y3:D m11:D d15:D",
       """select pol_num, cast(pol_iss_dt - interval 36 month as date) as y3, cast(pol_iss_dt + interval 11 month as date) as m11, pol_iss_dt + 15 as d15
  from e_policy""")  # fmt: skip
def offsets(t: Tables):
    return t.e_policy.select(
        "pol_num", F.add_months("pol_iss_dt", -36).alias("y3"), F.add_months("pol_iss_dt", 11).alias("m11"), F.date_add("pol_iss_dt", 15).alias("d15")
    )


@query("f25_f26_week_and_tenure", "agt_code:l week:l tenure:s",
       f"""select agt_code, cast(trunc(({RPT} - agt_join_dt) / 7) as int) + 1 as week, (m // 12) || ' y ' || (m % 12) || ' m' as tenure
  from (select *, 12 * (2002 - year(agt_join_dt)) + 5 - month(agt_join_dt) as m from e_agent)""")  # fmt: skip
def week_and_tenure(t: Tables):
    end = F.lit(fx.day(REPORT_DATE))
    months = F.lit(12 * 2002 + 5) - fx.month_index("agt_join_dt")
    return t.e_agent.select("agt_code", fx.week_number(end, "agt_join_dt").alias("week"), fx.tenure_text(months).alias("tenure"))


# Numbers and the rest.
@query("f27_f29_rounding_and_extremes", "pol_num:l r:d f:l a:l hi:D lo:D",
       """select pol_num, round(mode_prem * 0.37, 1) as r, cast(floor(mode_prem / 1000) as bigint) as f, abs(agt_code - wa_cd_1) as a,
  greatest(pol_trmn_dt, pd_to_dt) as hi, least(pol_trmn_dt, pd_to_dt) as lo from e_policy""")  # fmt: skip
def rounding(t: Tables):
    return t.e_policy.select(
        "pol_num", F.round(F.col("mode_prem") * F.lit("0.37").cast("decimal(4,2)"), 1).alias("r"), F.floor(F.col("mode_prem") / 1000).alias("f"),
        F.abs(F.col("agt_code") - F.col("wa_cd_1")).alias("a"), F.greatest("pol_trmn_dt", "pd_to_dt").alias("hi"),
        F.least("pol_trmn_dt", "pd_to_dt").alias("lo"),
    )


@query("f30_argmax_name", "po_num:l best:s",
       """select po_num, case when health_base = g then 'health_base' when inv_base = g then 'inv_base' when health_rider = g then 'health_rider'
  when riders = g then 'riders' end as best from (select *, greatest(health_base, inv_base, health_rider, riders) as g from e_product_score)""")  # fmt: skip
def argmax(t: Tables):
    return t.e_product_score.select("po_num", fx.argmax_name(["health_base", "inv_base", "health_rider", "riders"]).alias("best"))


@query("f31_f33_null_if_cast", "pol_num:l user:s kind:s mode:l num:l",
       """select pol_num, coalesce(nb_user_id, 'none') as user, case when crcy_code = '78' then 'local' else 'foreign' end as kind,
  cast(pmt_mode as int) as mode, try_cast(pol_stat_cd as int) as num from e_policy""")  # fmt: skip
def null_if_cast(t: Tables):
    return t.e_policy.select(
        "pol_num", F.coalesce("nb_user_id", F.lit("none")).alias("user"), F.when(F.col("crcy_code") == "78", "local").otherwise("foreign").alias("kind"),
        F.col("pmt_mode").cast("int").alias("mode"), F.col("pol_stat_cd").try_cast("int").alias("num"),
    )


@query("f34_f38_annual_premium", "pol_num:l ape:d ape_thousand:d negative:d",
       """select pol_num, mode_prem * (12 // cast(pmt_mode as int)) as ape, case pmt_mode when '12' then 1 when '06' then 2 when '03' then 4 else 12 end
  * mode_prem * 1000 as ape_thousand, -mode_prem as negative from e_policy""")  # fmt: skip
def annual(t: Tables):
    return t.e_policy.select(
        "pol_num", fx.ape("mode_prem", "pmt_mode").alias("ape"),
        (fx.payments_per_year("pmt_mode") * F.col("mode_prem") * 1000).alias("ape_thousand"), (-F.col("mode_prem")).alias("negative"),
    )


@query("f35_f36_arrays", "user_id:l first:s item:s",
       """with s as (select user_id, list_sort(list(distinct event_type)) as l from events group by 1)
select user_id, l[1] as first, unnest(l) as item from s""")  # fmt: skip
def arrays(t: Tables):
    sets = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("l"))
    return sets.select("user_id", F.get("l", F.lit(0)).alias("first"), F.explode("l").alias("item"))


@query("f37_sha256", "doc_id:l h:s", "select doc_id, sha256(text) as h from documents")
def hashes(t: Tables):
    return t.documents.select("doc_id", fx.sha256_text("text").alias("h"))


@query("f39_cut_percent_text", "po_num:l text:s",
       "select po_num, 'scored ' || cast(trunc(riders * 100) as int) || '% on riders' as text from e_product_score")
def percent_text(t: Tables):
    return t.e_product_score.select("po_num", F.concat(F.lit("scored "), fx.cut_percent("riders"), F.lit(" on riders")).alias("text"))
