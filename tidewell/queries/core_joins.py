"""Joins, unions, sorting and windows as queries, one per operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fold, normalize_phone, quarter_label
from ..operators import (
    decode,
    first_by,
    interval_join,
    latest_by,
    lookup,
    lookup_first,
    month_range_join,
    net_of,
    semi_or,
    side_by_side,
    snapshot_join,
    stack,
    stack_distinct,
    stack_tagged,
    top_n_by,
    unfold_distinct,
    with_first_flag,
    with_group_extremes,
    with_mean_rank,
    with_rank,
    with_rank_share,
    with_standing,
    with_top_row,
)
from .entities import PREVIOUS_DATE, REPORT_DATE
from .registry import Tables, query
from .reports_ledger import norm_phone, snapshots, whole_months_sql

RPT = f"date '{REPORT_DATE}'"


# Joins.
@query("j01_inner_join", "pol_num:l agt_code:l agt_nm:s",
       "select pol_num, p.agt_code, agt_nm from e_policy p join e_agent a on p.agt_code = a.agt_code where rank_cd <> 'R0'")
def j01(t: Tables):
    ranked = t.e_agent.where("rank_cd <> 'R0'").select("agt_code", "agt_nm")
    return t.e_policy.join(ranked, "agt_code", "inner")


@query("j02_multi_key_join", "trxn_dt:D btch_num:l user_id:s n:l amt:d",
       """select h.trxn_dt, h.btch_num, h.user_id, count(*) as n, sum(d.trxn_amt) as amt from e_batch_header h join e_batch_detail d
  on h.trxn_dt = d.trxn_dt and h.btch_num = d.btch_num and h.btch_role = d.btch_role group by 1, 2, 3""")  # fmt: skip
def j02(t: Tables):
    batch = ["trxn_dt", "btch_num", "btch_role"]
    # Details are summed per batch before they meet the header.
    sums = t.e_batch_detail.groupBy(*batch).agg(F.count(F.lit(1)).alias("n"), F.sum("trxn_amt").alias("amt"))
    return t.e_batch_header.join(sums, batch)


@query("j03_left_join", "pol_num:l pol_stat_cd:s ended:D",
       "select p.pol_num, pol_stat_cd, x.trmn_actv_dt as ended from e_policy p left join e_termination x on p.pol_num = x.pol_num")
def j03(t: Tables):
    return t.e_policy.join(t.e_termination.withColumnRenamed("trmn_actv_dt", "ended"), "pol_num", "left")


@query("j04_left_join_literal", "pol_num:l plan_code:s",
       """select p.pol_num, c.plan_code from e_policy p left join e_coverage c on p.pol_num = c.pol_num and c.cvg_typ = 'B'
  and c.cvg_reasn = 'O'""")  # fmt: skip
def j04(t: Tables):
    base = t.e_coverage.where((F.col("cvg_typ") == "B") & (F.col("cvg_reasn") == "O")).select("pol_num", "plan_code")
    return t.e_policy.select("pol_num").join(base, "pol_num", "left")


@query("j05_outer_made_inner", "pol_num:l hospital:s",
       """select m.pol_num, f.fld_valu_desc as hospital from e_med m left join e_codes f on f.fld_valu = m.med_hosp
  where f.fld_nm = 'med_hosp'""")  # fmt: skip
def j05(t: Tables):
    return decode(t.e_med, t.e_codes, "med_hosp", "med_hosp", "hospital")


@query("j06_roles", "pol_num:l servicing:s writing:s",
       """select p.pol_num, s.agt_nm as servicing, w.agt_nm as writing from e_policy p join e_agent s on p.agt_code = s.agt_code
  join e_agent w on p.wa_cd_1 = w.agt_code""")  # fmt: skip
def j06(t: Tables):
    names = t.e_agent.select("agt_code", "agt_nm")
    writing = names.toDF("wa_cd_1", "writing")
    return t.e_policy.join(names.toDF("agt_code", "servicing"), "agt_code").join(writing, "wa_cd_1")


@query("j07_decode", "pol_num:l pmt_mode:s mode_text:s stat_text:s",
       """select p.pol_num, p.pmt_mode, m.fld_valu_desc as mode_text, s.fld_valu_desc as stat_text from e_policy p
  join e_codes m on p.pmt_mode = m.fld_valu and m.fld_nm = 'PMT_MODE'
  left join e_codes s on p.pol_stat_cd = s.fld_valu and s.fld_nm = 'STAT_CODE'""")  # fmt: skip
def j07(t: Tables):
    named = decode(t.e_policy, t.e_codes, "PMT_MODE", "pmt_mode", "mode_text")
    return decode(named, t.e_codes, "STAT_CODE", "pol_stat_cd", "stat_text", how="left")


@query("j08_lookup_first", "pol_num:l found:s",
       """select p.pol_num, coalesce(a.agt_nm, b.agt_nm) as found from e_policy p left join e_agent a on p.wa_cd_2 = a.agt_code
  left join e_agent b on p.agt_code = b.agt_code""")  # fmt: skip
def j08(t: Tables):
    return lookup_first(t.e_policy, t.e_agent, ["wa_cd_2", "agt_code"], "agt_code", "agt_nm", "found")


@query("j09_anti_join", "pol_num:l",
       "select p.pol_num from e_policy p left join e_termination x on p.pol_num = x.pol_num where x.pol_num is null")
def j09(t: Tables):
    return t.e_policy.join(t.e_termination, "pol_num", "left_anti").select("pol_num")


@query("j10_semi_join", "cli_num:l n:l",
       """select cli_num, count(*) as n from e_link where pol_num in (select pol_num from e_coverage where plan_code in
  (select plan_code from e_plan)) group by 1""")  # fmt: skip
def j10(t: Tables):
    listed = t.e_coverage.join(t.e_plan, "plan_code", "left_semi")
    return t.e_link.join(listed, "pol_num", "left_semi").groupBy("cli_num").agg(F.count(F.lit(1)).alias("n"))


@query("j11_key_intersection", "pol_num:l",
       "select pol_num from e_policy where pol_num in (select pol_num from e_coverage) and pol_num in (select pol_num from e_termination)")
def j11(t: Tables):
    keys = t.e_coverage.select("pol_num").intersect(t.e_termination.select("pol_num"))
    return t.e_policy.join(keys, "pol_num", "left_semi").select("pol_num")


@query("j12_month_range_join", "pol_num:l effective_date:D nbv_factor_group:s",
       f"""select p.pol_num, r.effective_date, r.nbv_factor_group from e_policy p left join e_rate_quarter r on r.plan_code = p.plan_code_base
  and {whole_months_sql("p.pol_iss_dt", "r.effective_date")} between 0 and 2""")  # fmt: skip
def j12(t: Tables):
    rates = t.e_rate_quarter.select("plan_code", "effective_date", "nbv_factor_group")
    return month_range_join(t.e_policy, rates, ("plan_code_base", "plan_code"), "pol_iss_dt", "effective_date")


@query("j13_interval_join", "a:l b:l gap:l",
       """select p.pol_num as a, q.pol_num as b, q.d - p.d as gap from
  (select o_orderkey as pol_num, o_custkey as c, cast(o_orderdate as date) as d from orders) p join
  (select o_orderkey as pol_num, o_custkey as c, cast(o_orderdate as date) as d from orders) q
  on p.c = q.c and q.d - p.d between 2 and 180""")  # fmt: skip
def j13(t: Tables):
    left = t.orders.select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("ca"), F.col("o_orderdate").cast("date").alias("da"))
    right = left.toDF("b", "cb", "db")
    return interval_join(left, right, [("ca", "cb")], "da", "db", 2, 180).withColumn("gap", F.datediff("db", "da"))


@query("j13_interval_left_join", "pol_num:l clm_id:l",
       """select p.pol_num, c.clm_id from e_policy p left join e_pack_claim c on p.pol_num = c.pol_num
  and c.clm_recv_dt - p.pol_iss_dt between 0 and 365""")  # fmt: skip
def j13_left(t: Tables):
    claims = t.e_pack_claim.select("clm_id", F.col("pol_num").alias("claimed"), "clm_recv_dt")
    return interval_join(
        t.e_policy.select("pol_num", "pol_iss_dt"), claims, [("pol_num", "claimed")], "pol_iss_dt", "clm_recv_dt",
        0, 365, how="left",
    )


@query("j14_inequality_join", "pol_num:l first_issue:D",
       """select p.pol_num, g.d as first_issue from e_policy_mart p left join (select po_num, min(pol_iss_dt) as d from e_policy_mart
  where pol_stat_cd in ('1','2','3') group by 1) g on p.po_num = g.po_num and p.pol_iss_dt > g.d""")  # fmt: skip
def j14(t: Tables):
    firsts = t.e_policy_mart.where(F.col("pol_stat_cd").isin("1", "2", "3")).groupBy("po_num").agg(F.min("pol_iss_dt").alias("first_issue"))
    p = t.e_policy_mart.alias("p")
    return p.join(firsts.alias("g"), (F.col("p.po_num") == F.col("g.po_num")) & (F.col("p.pol_iss_dt") > F.col("g.first_issue")), "left")


@query("j15_text_key_join", "id:s cli_num:l",
       """select l.id, c.cli_num from e_lead l join e_client c on trim(upper(l.email)) = trim(upper(c.email_addr))""")  # fmt: skip
def j15(t: Tables):
    left = t.e_lead.select("id", fold("email").alias("k"))
    right = t.e_client.select("cli_num", fold("email_addr").alias("k"))
    return left.join(right, "k")


@query("j16_computed_key_join", "pol_num:l prov_nm:s qtr:s n_rates:l",
       """select p.pol_num, v.prov_nm, q.qtr, q.n as n_rates from e_policy p join e_link l on p.pol_num = l.pol_num and l.link_typ = 'O'
  join e_address a on l.cli_num = a.cli_num join e_province v on substr(a.zip_code, 1, 2) = v.prov_id
  left join (select effective_qtr as qtr, count(*) as n from e_rate_quarter group by 1) q on q.qtr =
    year(p.pol_iss_dt - interval 6 month) || ' Q' || quarter(p.pol_iss_dt - interval 6 month)""")  # fmt: skip
def j16(t: Tables):
    rates = t.e_rate_quarter.groupBy(F.col("effective_qtr").alias("qtr")).agg(F.count(F.lit(1)).alias("n_rates"))
    place = t.e_address.select("cli_num", F.substring("zip_code", 1, 2).alias("prov_id"))
    return (
        t.e_policy.select("pol_num", quarter_label("pol_iss_dt").alias("k"))
        .join(t.e_link.where("link_typ = 'O'").select("pol_num", "cli_num"), "pol_num")
        .join(place, "cli_num")
        .join(t.e_province, "prov_id")
        .join(rates, F.col("k") == F.col("qtr"), "left")
    )


@query("j17_newest_instead_of_join_back", "po_num:l pol_num:l pol_iss_dt:D",
       """select p.po_num, max(p.pol_num) as pol_num, p.pol_iss_dt from e_policy_mart p join (select po_num, max(pol_iss_dt) as d from e_policy_mart
  group by 1) m on p.po_num = m.po_num and p.pol_iss_dt = m.d group by 1, 3""")  # fmt: skip
def j17(t: Tables):
    return latest_by(t.e_policy_mart, ["po_num"], [F.col("pol_iss_dt").desc(), F.col("pol_num").desc()])


@query("j18_snapshot_join", "pol_num:l cli_num:l image_date:D",
       """select p.pol_num, l.cli_num, p.image_date from e_policy p join e_link l on p.image_date = l.image_date and p.pol_num = l.pol_num
  where l.link_typ = 'O'""")  # fmt: skip
def j18(t: Tables):
    return snapshot_join(t.e_policy, t.e_link.where("link_typ = 'O'"), ["pol_num"])


TOP_RATE = "select xchng_rate from e_exchange where fr_crcy_code = '78' and xchng_rate_typ = 'U' order by to_eff_dt desc, xchng_rate limit 1"


@query("j19_top_row_join", "pol_num:l crcy_code:s rate:d",
       f"select pol_num, crcy_code, case when crcy_code = '78' then ({TOP_RATE}) end as rate from e_policy")
def j19(t: Tables):
    rates = t.e_exchange.where("fr_crcy_code = '78' and xchng_rate_typ = 'U'").withColumnRenamed("xchng_rate", "rate")
    return with_top_row(
        t.e_policy, rates, [F.col("to_eff_dt").desc(), F.col("rate")], ["rate"], lambda top: F.col("crcy_code") == "78"
    )


@query("j20_snapshot_movement", "was:s now:s n:l",
       f"""select p.pol_stat_cd as was, c.pol_stat_cd as now, count(*) as n from
  (select pol_num, substr('123456789ABCDEFHLMNRTX', cast(cast(floor(pol_num / 22) as bigint) % 22 + 1 as int), 1) as pol_stat_cd
    from e_policy where pol_iss_dt <= date '{PREVIOUS_DATE}') p
  full outer join (select pol_num, pol_stat_cd from e_policy where pol_iss_dt <= {RPT}) c on p.pol_num = c.pol_num group by 1, 2""")  # fmt: skip
def j20(t: Tables):
    prev, curr = snapshots(t)
    both = prev.select("pol_num", F.col("pol_stat_cd").alias("was")).join(
        curr.select("pol_num", F.col("pol_stat_cd").alias("now")), "pol_num", "full_outer"
    )
    return both.groupBy("was", "now").agg(F.count(F.lit(1)).alias("n"))


@query("j21_side_by_side", "pol_num:l base:d rider:d claims:l",
       f"""select coalesce(b.pol_num, r.pol_num, c.pol_num) as pol_num, base, rider, claims
  from (select pol_num, sum(cvg_prem) as base from e_coverage where cvg_typ = 'B' group by 1) b
  full outer join (select pol_num, sum(cvg_prem) as rider from e_coverage where cvg_typ = 'R' group by 1) r on b.pol_num = r.pol_num
  full outer join (select pol_num, count(*) as claims from e_pack_claim group by 1) c on coalesce(b.pol_num, r.pol_num) = c.pol_num""")  # fmt: skip
def j21(t: Tables):
    def total(kind, name):
        return t.e_coverage.where(F.col("cvg_typ") == kind).groupBy("pol_num").agg(F.sum("cvg_prem").alias(name))

    claims = t.e_pack_claim.groupBy("pol_num").agg(F.count(F.lit(1)).alias("claims"))
    return side_by_side([total("B", "base"), total("R", "rider"), claims], "pol_num")


@query("j22_merge_left", "pol_num:l wa_cd_1:l tier:s",
       "select p.pol_num, p.wa_cd_1, t.tier from e_policy p left join e_tier t on p.wa_cd_1 = t.agt_code")
def j22(t: Tables):
    return t.e_policy.join(t.e_tier.withColumnRenamed("agt_code", "wa_cd_1"), "wa_cd_1", "left")


@query("j23_lookup", "pol_num:l tier:s insured:l",
       """select p.pol_num, coalesce(t.tier, 'Platinum') as tier, m.c as insured from e_policy p left join e_tier t on p.agt_code = t.agt_code
  left join (select pol_num, max(cli_num) as c from e_coverage group by 1) m on p.pol_num = m.pol_num""")  # fmt: skip
def j23(t: Tables):
    tiered = lookup(t.e_policy, t.e_tier, "agt_code", "agt_code", "tier", "tier", default="Platinum")
    return lookup(tiered, t.e_coverage, "pol_num", "pol_num", "cli_num", "insured")


@query("j24_filtered_snapshot_join", "cli_num:l bank:s",
       f"""select distinct l.cli_num, substr(a.loc_code, 1, 3) as bank from e_policy p join e_link l on p.pol_num = l.pol_num and l.link_typ = 'O'
  join e_agent a on p.agt_code = a.agt_code where p.image_date = {RPT} and l.image_date = {RPT}""")  # fmt: skip
def j24(t: Tables):
    here = F.col("image_date") == REPORT_DATE
    owners = t.e_link.where(here & (F.col("link_typ") == "O")).select("pol_num", "cli_num")
    banks = t.e_agent.select("agt_code", F.substring("loc_code", 1, 3).alias("bank"))
    return t.e_policy.where(here).join(owners, "pol_num").join(banks, "agt_code").select("cli_num", "bank").distinct()


@query("p11_semi_or", "pol_num:l cvg_eff_dt:D n:l",
       f"""select pol_num, cvg_eff_dt, count(*) as n from e_coverage where pol_num in (select pol_num from e_policy where wa_cd_1 in
  (select agt_code from e_tier)) or cvg_eff_dt > {RPT} group by 1, 2""")  # fmt: skip
def p11(t: Tables):
    keys = t.e_policy.join(t.e_tier.withColumnRenamed("agt_code", "wa_cd_1"), "wa_cd_1", "left_semi")
    rows = semi_or(t.e_coverage, keys, "pol_num", F.col("cvg_eff_dt") > REPORT_DATE)
    return rows.groupBy("pol_num", "cvg_eff_dt").agg(F.count(F.lit(1)).alias("n"))


# Windows.
@query("w01_latest_row", "claim_id:s policy_number:l reporting_date:D claim_status:s",
       """select * from (select *, row_number() over (partition by claim_id, policy_number order by reporting_date desc,
  claim_approved_date desc, claim_received_date desc, claim_status) as rn from e_claim) where rn = 1""")  # fmt: skip
def w01(t: Tables):
    newest_first = [F.col(c).desc() for c in ("reporting_date", "claim_approved_date", "claim_received_date")]
    return latest_by(t.e_claim, ["claim_id", "policy_number"], [*newest_first, F.col("claim_status")])


@query("w02_first_row", "po_num:l pol_num:l pol_iss_dt:D",
       "select * from (select *, row_number() over (partition by po_num order by pol_iss_dt, pol_num) as rn from e_policy_mart) where rn = 1")
def w02(t: Tables):
    return first_by(t.e_policy_mart, ["po_num"], [F.col("pol_iss_dt"), F.col("pol_num")])


@query("w03_first_row_with_ties", "btch_num:l trxn_dt:D rep_num:s pol_num:l trxn_amt:d",
       """select * from (select distinct btch_num, trxn_dt, rep_num, pol_num, trxn_amt, row_number() over (partition by btch_num order by trxn_dt,
  rep_num, pol_num, trxn_amt) as rn from e_batch_detail) where rn = 1""")  # fmt: skip
def w03(t: Tables):
    tie_break = [F.col(c) for c in ("trxn_dt", "rep_num", "pol_num", "trxn_amt")]
    return first_by(t.e_batch_detail, ["btch_num"], tie_break)


@query("w04_group_extremes", "sub_agt_cd:l agt_cd:l rpt_level:l low:l high:l edge:s",
       """select sub_agt_cd, agt_cd, rpt_level, low, high, case when rpt_level = low then 'low' when rpt_level = high then 'high' end as edge
  from (select *, min(rpt_level) over (partition by agt_cd) as low, max(rpt_level) over (partition by agt_cd) as high from e_rpt)""")  # fmt: skip
def w04(t: Tables):
    level = F.col("rpt_level")
    edge = F.when(level == F.col("low"), "low").when(level == F.col("high"), "high")
    return with_group_extremes(t.e_rpt, ["agt_cd"], "rpt_level", "low", "high").withColumn("edge", edge)


AGENT_PREMIUM = "select agt_code, sum(mode_prem) as premium from e_policy group by 1"


def premiums(t: Tables):
    return t.e_policy.groupBy("agt_code").agg(F.sum("mode_prem").alias("premium"))


@query("w05_rank", "agt_code:l premium:d rank:l",
       f"select *, rank() over (order by premium desc) as rank from ({AGENT_PREMIUM})")
def w05(t: Tables):
    return with_rank(premiums(t), "premium")


@query("w05_rank_rows", "l_quantity:d n:l rank:l",
       "select l_quantity, rank, count(*) as n from (select l_quantity, rank() over (order by l_quantity desc) as rank from lineitem) group by 1, 2")
def w05_rows(t: Tables):
    """Every line item is ranked by quantity; each quantity is shared by a fiftieth of the rows."""
    ranked = with_rank(t.lineitem.select("l_quantity"), "l_quantity")
    return ranked.groupBy("l_quantity", "rank").agg(F.count(F.lit(1)).alias("n"))


@query("w06_mean_rank", "pol_num:l dur:l rank:l",
       """select pol_num, dur, cast(floor(rank() over (order by dur desc) + (count(*) over (partition by dur) - 1) / 2) as bigint) as rank
  from (select pol_num, count(*) as dur from e_coverage group by 1)""")  # fmt: skip
def w06(t: Tables):
    return with_mean_rank(t.e_coverage.groupBy("pol_num").agg(F.count(F.lit(1)).alias("dur")), "dur")


@query("w07_standing", "pol_num:l n_cvg:l standing:d",
       """with c as (select pol_num, count(*) as n_cvg from e_coverage group by 1),
r as (select *, least(cast((select count(*) from c) - floor(rank() over (order by n_cvg desc) + (count(*) over (partition by n_cvg) - 1) / 2)
  as double) / (select count(*) from c), 0.99) as s from c)
select pol_num, n_cvg, case when s = (select min(s) from r) then 0 else s end as standing from r""")  # fmt: skip
def w07(t: Tables):
    return with_standing(t.e_coverage.groupBy("pol_num").agg(F.count(F.lit(1)).alias("n_cvg")), "n_cvg")


@query("w08_top_n_per_group", "agt_code:l pol_num:l mode_prem:d",
       "select * from (select *, row_number() over (partition by agt_code order by mode_prem desc, pol_num) as rn from e_policy) where rn <= 10")
def w08(t: Tables):
    return top_n_by(t.e_policy, ["agt_code"], [F.col("mode_prem").desc(), F.col("pol_num")], 10)


@query("w09_first_flag", "pol_num:l po_num:l if_first:l repeat_sales:l",
       """select pol_num, po_num, case when rn = 1 then 1 else 0 end as if_first, case when rn = 1 then 0 else 1 end as repeat_sales
  from (select *, row_number() over (partition by po_num order by pol_iss_dt, pol_num) as rn from e_policy_mart)""")  # fmt: skip
def w09(t: Tables):
    return with_first_flag(t.e_policy_mart, "po_num", [F.col("pol_iss_dt"), F.col("pol_num")], "pol_num")


@query("w10_rank_share", "agt_code:l rank:l rank_share:d",
       f"""select agt_code, rank() over (order by premium desc) as rank, cast(rank() over (order by premium desc) as double) / (select count(*)
  from e_agent) as rank_share from ({AGENT_PREMIUM})""")  # fmt: skip
def w10(t: Tables):
    total = t.e_agent.agg(F.count(F.lit(1))).scalar()
    return with_rank_share(premiums(t), "premium", total)


# Sorting and limits.
@query("o01_order_by", "acct_num:s trxn_dt:D n:l",
       "select acct_num, trxn_dt, count(*) as n from e_ledger group by 1, 2 order by 1, 2")
def o01(t: Tables):
    return t.e_ledger.groupBy("acct_num", "trxn_dt").agg(F.count(F.lit(1)).alias("n")).orderBy("acct_num", "trxn_dt")


@query("o02_top_50", "pol_num:l mode_prem:d",
       "select pol_num, mode_prem from e_policy order by mode_prem desc, pol_num limit 50")
def o02(t: Tables):
    return t.e_policy.select("pol_num", "mode_prem").orderBy(F.col("mode_prem").desc(), "pol_num").limit(50)


@query("o03_newest_row", "xchng_rate:d to_eff_dt:D",
       "select xchng_rate, to_eff_dt from e_exchange order by to_eff_dt desc, xchng_rate limit 1")
def o03(t: Tables):
    return t.e_exchange.orderBy(F.col("to_eff_dt").desc(), "xchng_rate").limit(1)


@query("o04_sort_then_first", "plan_code:s customer_needs:s n:l",
       """select * from (select plan_code, customer_needs, count(distinct effective_date) as n, row_number() over (partition by plan_code
  order by count(distinct effective_date) desc, customer_needs) as rn from e_rate_quarter group by 1, 2) where rn = 1""")  # fmt: skip
def o04(t: Tables):
    counts = t.e_rate_quarter.groupBy("plan_code", "customer_needs").agg(F.countDistinct("effective_date").alias("n"))
    return first_by(counts, ["plan_code"], [F.col("n").desc(), F.col("customer_needs")])


# Unions.
@query("u01_union_distinct", "type:s n:l",
       """select 'in force' as type, count(*) as n from e_policy where pol_stat_cd in ('1','2','3') union
  select 'pending', count(*) from e_policy where pol_stat_cd in ('6','8')""")  # fmt: skip
def u01(t: Tables):
    def count(name, *codes):
        rows = t.e_policy.where(F.col("pol_stat_cd").isin(*codes))
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("type"), "n")

    return stack_distinct([count("in force", "1", "2", "3"), count("pending", "6", "8")])


@query("u02_unfold_phones", "cli_num:l phone:s",
       " union ".join(f"select cli_num, {norm_phone(c)} as phone from e_client where {c} is not null"
                      for c in ("mobl_phon_num", "prim_phon_num", "othr_phon_num")))
def u02(t: Tables):
    phones = [normalize_phone(c) for c in ("mobl_phon_num", "prim_phon_num", "othr_phon_num")]
    return unfold_distinct(t.e_client, phones, "phone").select("cli_num", "phone").distinct()


@query("u03_union_all", "pol_num:l n:l",
       "select pol_num, count(*) as n from (select pol_num from e_ledger union all select pol_num from e_pack_claim) group by 1")
def u03(t: Tables):
    both = stack([t.e_ledger.select("pol_num"), t.e_pack_claim.select("pol_num")])
    return both.groupBy("pol_num").agg(F.count(F.lit(1)).alias("n"))


@query("u04_union_by_name", "pol_num:l d:D",
       "select pol_num, trxn_dt as d from e_history union all select pol_num, comp_date as d from e_change_ctl")
def u04(t: Tables):
    later = t.e_change_ctl.select(F.col("comp_date").alias("d"), "pol_num")
    return t.e_history.select("pol_num", F.col("trxn_dt").alias("d")).unionByName(later)


@query("u05_union_of_blocks", "kpi:s dim:s val:l",
       """select 'gender' as kpi, gender as dim, count(*) as val from e_customer_month group by 2 union all
  select 'city', city, count(*) from e_customer_month group by 2 union all select 'channel', channel, count(*) from e_customer_month group by 2""")  # fmt: skip
def u05(t: Tables):
    def block(name):
        rows = t.e_customer_month.groupBy(F.col(name).alias("dim")).agg(F.count(F.lit(1)).alias("val"))
        return rows.withColumn("kpi", F.lit(name))

    return stack([block("gender"), block("city"), block("channel")])


@query("u06_mixed_union", "v:s",
       """select pmt_mode as v from e_policy union all select pol_stat_cd from e_policy union select dist_chnl_cd from e_policy
  union all select crcy_code from (select distinct crcy_code from e_policy)""")  # fmt: skip
def u06(t: Tables):
    """A distinct union makes everything above it distinct; what follows keeps its rows."""
    def one(c):
        return t.e_policy.select(F.col(c).alias("v"))

    above = stack_distinct([one("pmt_mode"), one("pol_stat_cd"), one("dist_chnl_cd")])
    return stack([above, one("crcy_code").distinct()])


@query("u07_net_of_returns", "br_code:s net:d",
       "select br_code, sum(a) as net from (select br_code, trxn_amt as a from e_pickup union all select br_code, -trxn_amt from e_return) group by 1")
def u07(t: Tables):
    entry = ["br_code", "trxn_amt"]
    return net_of(t.e_pickup.select(*entry), t.e_return.select(*entry), "trxn_amt").groupBy("br_code").agg(
        F.sum("trxn_amt").alias("net")
    )


@query("u08_tagged_union", "rowtype:s n:l first:D",
       """select rowtype, count(*) as n, min(d) as first from (select '1' as rowtype, trxn_dt as d from e_batch_detail union all
  select '2', sbmt_date from e_change_ctl union all select '3', input_dt from e_outstanding) group by 1""")  # fmt: skip
def u08(t: Tables):
    sources = {
        "1": t.e_batch_detail.select(F.col("trxn_dt").alias("d")),
        "2": t.e_change_ctl.select(F.col("sbmt_date").alias("d")),
        "3": t.e_outstanding.select(F.col("input_dt").alias("d")),
    }
    return stack_tagged(sources, "rowtype").groupBy("rowtype").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("first"))
