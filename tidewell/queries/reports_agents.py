"""The agent pack as queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import plans, sources
from ..functions import adjusted_premium, ape, owner_relation
from ..operators import settle
from ..plans.agent_pack import ADVICE_TEXT
from ..session import shared_dir
from .entities import REPORT_DATE
from .registry import REGISTRY, Tables, query

RPT = f"date '{REPORT_DATE}'"
SINGLE = ("UL035", "R07", "R21")
STAFF = """channel = 'Agency' and comp_prvd_num in ('01','98') and agt_stat_code = '1' and agt_term_dt is null"""
M = "cast(pmt_mode as int)"
ADJUSTED = f"""case when plan_code in ('UL035','R07','R21') then case when days <= 21 then 0 else cvg_prem * 0.1 end
  else case when days <= 21 then 0 when days is null or days >= 365 or {M} = 12 then cvg_prem * (12 // {M})
    when {M} = 3 then cvg_prem * (days // 92 + 1) when {M} = 6 then cvg_prem * (days // 183 + 1)
    when {M} = 1 then cvg_prem * (days // 31 + 1) end end"""


def idx(c: str) -> str:
    return f"(year({c}) * 12 + month({c}))"


RELATION = """case when po_num = cli_num then 'self' when gap between 18 and 40 then 'child' when gap > 40 then 'others'
  when gap < -17 then 'parent' when coalesce(g1 = g2, false) then 'others' else 'spouse' end"""

FACT_SQL = f"""
with staff as (select a.agt_code as wa_cd_1, a.agt_join_dt, c.id_num as agt_id_num from e_agent a
  left join e_candidate c on a.can_num = c.can_num where {STAFF}),
own as (select pol_num, max(cli_num) as po_num from e_link where link_typ = 'O' and rec_status = 'A' group by 1),
base as (select c.pol_num, c.cli_num, c.plan_code, c.cvg_prem, c.cvg_typ, c.cvg_eff_dt, c.cvg_del_dt, c.cvg_stat_cd, c.rel_to_insrd,
    p.wa_cd_1, p.pol_eff_dt, p.pol_trmn_dt, p.pmt_mode, p.pol_stat_cd, p.pd_to_dt, s.agt_join_dt, s.agt_id_num, own.po_num
  from e_coverage c join e_policy p on c.pol_num = p.pol_num join staff s on p.wa_cd_1 = s.wa_cd_1 join own on c.pol_num = own.pol_num),
firsts as (select distinct pol_num from (select pol_num, row_number() over (partition by po_num order by pol_eff_dt, pol_num) as rn from base)
  where rn = 1),
kinds as (select plan_code, customer_needs as type from (select plan_code, customer_needs, row_number() over (partition by plan_code
    order by count(distinct effective_date) desc, customer_needs) as rn from e_rate_quarter group by 1, 2) where rn = 1),
means as (select plan_code, cast(sum(nbv_margin_agency) as double) / count(nbv_margin_agency) as margin_nbv
  from (select distinct * from e_rate_quarter) where substr(effective_qtr, 1, 4) = '1999' group by 1),
person as (select cli_num, 2000 - year(birth_dt) as age, sex_code as sex from e_client),
ids as (select k.cli_num, k.id_num from e_client k where k.id_num in (select id_num from e_candidate)),
j as (select b.*, case when f.pol_num is null then 0 else 1 end as if_first_pol, o.age as po_age, o.sex as g1, i.age as in_age, i.sex as g2,
    ids.id_num as cli_id_num_agt_buy, kinds.type, means.margin_nbv, coalesce(t.tier, 'Platinum') as tier,
    least(b.pol_trmn_dt, b.cvg_del_dt) - b.pol_eff_dt as days
  from base b left join firsts f on b.pol_num = f.pol_num left join person o on b.po_num = o.cli_num
  left join person i on b.cli_num = i.cli_num left join ids on b.cli_num = ids.cli_num left join kinds on b.plan_code = kinds.plan_code
  left join means on b.plan_code = means.plan_code left join e_tier t on b.wa_cd_1 = t.agt_code
  where b.cvg_eff_dt <= {RPT} and b.pol_eff_dt <= {RPT}),
x as (select *, case when po_num <> cli_num then po_age - in_age end as gap, cast(({ADJUSTED}) * 1000 as bigint) as adjust_ape from j)
select x.* exclude (gap, g1, g2, days), days as pol_eff_days, 1 - if_first_pol as repeat_sales, adjust_ape * margin_nbv as nbv,
  cvg_prem * (12 // {M}) as ape, {idx("cvg_eff_dt")} - (2000 * 12 + 5) - 1 as last_n_month_eff_cvg,
  {idx("pol_trmn_dt")} - (2000 * 12 + 5) - 1 as last_n_month_end, {idx("cvg_eff_dt")} as cvg_month, {idx("pol_eff_dt")} as pol_month,
  {idx("pol_trmn_dt")} as end_month, {idx("cvg_eff_dt")} - {idx("pol_eff_dt")} + 1 as cvg_eff_mth_from_pol_eff,
  {idx("cvg_eff_dt")} - {idx("agt_join_dt")} + 1 as cvg_eff_mth_from_agt_join,
  {idx("pol_eff_dt")} - {idx("agt_join_dt")} + 1 as pol_eff_mth_from_agt_join, pol_eff_dt - agt_join_dt as pol_eff_days_from_agt_join,
  cast(trunc((cvg_eff_dt - agt_join_dt) / 7) as int) + 1 as cvg_eff_week_from_agt_join, pol_trmn_dt - pol_eff_dt as term_pol_last_days,
  case pol_stat_cd when '1' then 'Premium Paying' when '2' then 'Premium Waiver' when '3' then 'Fully Paid' when '4' then 'Extended Term Ins.'
    when '5' then 'Reduced Paid-Up' when '6' then 'Pending for premium' when '7' then 'Support premium' when '8' then 'NB Pending'
    when '9' then 'Support premium' when 'A' then 'Not taken' when 'B' then 'Lapsed' when 'C' then 'Converted' when 'D' then 'Death Claimed'
    when 'E' then 'Surrendered' when 'F' then 'Matured' when 'H' then 'Expired' when 'L' then 'Deleted' when 'M' then 'MDR Claim'
    when 'N' then 'Not taken' when 'R' then 'Rejected' when 'T' then 'TPD Claim' when 'X' then 'Closed' end as status,
  case when cvg_stat_cd in ('1','2','3','5','7') then 1 else 0 end as cvg_active,
  case when pol_stat_cd in ('1','2','3','5','7') then 1 else 0 end as pol_active,
  case when pol_stat_cd in ('A','N') then 1 else 0 end as is_non_taken, case when pol_stat_cd = 'B' then 1 else 0 end as lapsed,
  case when pol_stat_cd = 'R' then 1 else 0 end as rejected,
  case cast(rel_to_insrd as int) when 1 then 'Self' when 2 then 'Spouse' when 3 then 'Child' when 51 then 'Parent' else 'Others' end as insrd,
  case when po_num = cli_num then 1 else 0 end as po_is_cli, gap as po_cli_age_gap, {RELATION} as po_ins_rela,
  type || '_' || {RELATION} as prd_cus_mix,
  case {M} when 1 then 'monthly' when 3 then 'quarterly' when 6 then 'half-yearly' else 'yearly' end as pmt_mode_map
from x"""


STORED = "stored coverage fact"


def fact(t: Tables):
    """The coverage fact; the stored one, once :func:`stored_fact` has written it for these tables."""
    if STORED in t._seen:
        return t._seen[STORED]
    return plans.coverage_fact(
        t.e_coverage, t.e_policy, t.e_agent, t.e_link, t.e_client, t.e_candidate, t.e_rate_quarter, t.e_tier,
        REPORT_DATE, single_plans=SINGLE,
    )


query(
    "d53_coverage_fact",
    "pol_num:l cli_num:l po_num:l wa_cd_1:l plan_code:s cvg_typ:s cvg_prem:d cvg_eff_dt:D pol_eff_dt:D pol_trmn_dt:D "
    "pol_stat_cd:s agt_id_num:s cli_id_num_agt_buy:s if_first_pol:l repeat_sales:l type:s margin_nbv:d tier:s pol_eff_days:l "
    "ape:d adjust_ape:l nbv:d last_n_month_eff_cvg:l last_n_month_end:l cvg_month:l pol_month:l end_month:l "
    "cvg_eff_mth_from_pol_eff:l cvg_eff_mth_from_agt_join:l pol_eff_mth_from_agt_join:l pol_eff_days_from_agt_join:l "
    "cvg_eff_week_from_agt_join:l term_pol_last_days:l status:s cvg_active:l pol_active:l is_non_taken:l lapsed:l rejected:l "
    "insrd:s po_is_cli:l po_cli_age_gap:l po_ins_rela:s prd_cus_mix:s pmt_mode_map:s",
    FACT_SQL,
)(fact)


def stored_fact(t: Tables):
    """The fact as the reports find it in production: written once, read back by columns."""
    if STORED not in t._seen:
        path = f"{shared_dir(t.spark)}/tidewell-fact-{uuid.uuid4().hex}"
        sources.write_table(fact(t), path)
        t._seen[STORED] = sources.read_table(t.spark, path)
    return t._seen[STORED]


SHARED = "results several outputs share"


def shared(t: Tables, name: str, build):
    """The result of ``build``; where the whole pack is made of these tables, settled the first time and kept."""
    known = t._seen.get(SHARED)
    if known is None:
        return build()
    if name not in known:
        known[name] = settle(build())
    return known[name]


def agents(t: Tables):
    return shared(t, "agents", lambda: plans.agent_list(t.e_agent, t.e_programme, t.e_tier, REPORT_DATE))


AGENTS_SQL = f"""
select a.agt_code as agt_cd, a.agt_nm, a.rank_code, a.br_code, (2000 * 12 + 5) - {idx("a.agt_join_dt")} as tenure_mth, a.agt_join_dt,
  coalesce(t.tier, 'Platinum') as tier
from e_agent a left join e_tier t on a.agt_code = t.agt_code
where {STAFF} and a.agt_code in (select agt_cd from e_programme)"""
query(
    "d53_agent_list",
    "agt_cd:l agt_nm:s rank_code:s br_code:s tenure_mth:l agt_join_dt:D tier:s",
    AGENTS_SQL,
)(agents)

WINDOWS = {"last_mth": 1, "last_yr": 12, "last_3m": 3, "last_6m": 6}
TAKEN = "pol_stat_cd not in ('A','N','R')"
METRICS = {
    "ape": ("sum", "adjust_ape", TAKEN),
    "nbv": ("sum", "cast(nbv as decimal(28,6))", TAKEN),
    "po": ("count", "po_num", TAKEN),
    "cus": ("count", "cli_num", TAKEN),
    "pol": ("count", "pol_num", f"cvg_typ = 'B' and {TAKEN}"),
    "NT": ("count", "pol_num", "cvg_typ = 'B' and is_non_taken = 1"),
    "rej": ("count", "pol_num", "cvg_typ = 'B' and rejected = 1"),
    "lap": ("count", "pol_num", "cvg_typ = 'B' and lapsed = 1"),
    "prd": ("count", "type", TAKEN),
    "fam": ("count", "po_ins_rela", TAKEN),
    "rid": ("sum", "adjust_ape", f"{TAKEN} and cvg_typ = 'R'"),
    "rep": ("sum", "adjust_ape", f"{TAKEN} and repeat_sales = 1"),
}


def metric_sql(name: str, label: str) -> str:
    kind, value, where = METRICS[name]
    month = "last_n_month_end" if name == "lap" else "last_n_month_eff_cvg"
    cond = f"{where} and {month} between -{WINDOWS[label]} and -1"
    if kind == "sum":
        body = f"sum(case when {cond} then coalesce({value}, 0) end)"
    else:
        body = f"case when count(case when {cond} then 1 end) > 0 then count(distinct case when {cond} then {value} end) end"
    return f'{body} as "{label}_{name}"'


ALL_METRICS = [(m, w) for m in METRICS for w in WINDOWS]
F_CTE = f"f0 as materialized ({FACT_SQL}), ag as ({AGENTS_SQL}), f as (select f0.*, f0.wa_cd_1 as agt_cd from f0 where f0.wa_cd_1 in (select agt_cd from ag))"
KPI_CTE = f"""{F_CTE}, k0 as (select agt_cd, {", ".join(metric_sql(m, w) for m, w in ALL_METRICS)} from f group by 1),
k as (select * from k0 where coalesce({", ".join(f'"{w}_{m}"' for m, w in ALL_METRICS)}) is not null)"""
KPI_COLUMNS = "agt_cd:l " + " ".join(
    f"{w}_{m}:{'d' if m == 'nbv' else 'l'}" for m, w in ALL_METRICS
)


def kpis(t: Tables, rows=None):
    return shared(t, "kpis", lambda: plans.agent_kpis(fact(t) if rows is None else rows, agents(t)))


query("d40_agent_kpis", KPI_COLUMNS, f"with {KPI_CTE} select * from k")(lambda t: kpis(t))

RATIO_SQL = []
for _w in WINDOWS:
    RATIO_SQL.append(f'cast("{_w}_ape" as double) / "{_w}_pol" as "{_w}_pol_size"')
    RATIO_SQL.append(f'cast("{_w}_ape" as double) / "{_w}_po" as "{_w}_po_size"')
for _m in ("NT", "rej", "lap"):
    for _w in WINDOWS:
        RATIO_SQL.append(f'coalesce(1 - cast("{_w}_{_m}" as double) / "last_3m_pol", 1) as "{_w}_{_m}_per"')
R_CTE = f"{KPI_CTE}, r as (select k.*, {', '.join(RATIO_SQL)} from k)"
RATIO_COLUMNS = "agt_cd:l " + " ".join(
    [f"{w}_{s}_size:d" for w in WINDOWS for s in ("pol", "po")]
    + [f"{w}_{m}_per:d" for m in ("NT", "rej", "lap") for w in WINDOWS]
)


def ratios(t: Tables, rows=None):
    return plans.agent_ratios(kpis(t, rows))


query("d41_agent_ratios", RATIO_COLUMNS, f"with {R_CTE} select * from r")(lambda t: ratios(t))

query(
    "d42_sales_by_month",
    "agt_cd:l date:s avg_ape_agt:l avg_ape_tier:l current_tier:s",
    f"""with {F_CTE}, s as (select agt_cd, strftime(cvg_eff_dt, '%Y-%m') as date, sum(adjust_ape) as a from f
  where last_n_month_eff_cvg between -12 and -1 and {TAKEN} group by 1, 2),
g as (select x.agt_cd, d.date, coalesce(s.a, 0) as a from (select distinct agt_cd from s) x cross join (select distinct date from s) d
  left join s on s.agt_cd = x.agt_cd and s.date = d.date)
select agt_cd, date, a as avg_ape_agt, cast(trunc(cast(sum(a) over (partition by date) as double) / count(*) over (partition by date)) as bigint)
  as avg_ape_tier, 'Platinum' as current_tier from g""",
)(lambda t: plans.sales_mix(stored_fact(t), agents(t), by="month"))

query(
    "d42_sales_by_type",
    "agt_cd:l prd_type:s sum_ape_agt:l sum_ape_tier:l current_tier:s",
    f"""with {F_CTE}, s as (select agt_cd, type as prd_type, sum(adjust_ape) as a from f
  where last_n_month_eff_cvg between -12 and -1 and {TAKEN} and type is not null group by 1, 2)
select x.agt_cd, d.prd_type, coalesce(s.a, 0) as sum_ape_agt, d.a as sum_ape_tier, 'Platinum' as current_tier
from (select distinct agt_cd from s) x cross join (select prd_type, sum(a) as a from s group by 1) d
left join s on s.agt_cd = x.agt_cd and s.prd_type = d.prd_type""",
)(lambda t: plans.sales_mix(stored_fact(t), agents(t), by="type"))

query(
    "d43_claim_kpis",
    "agt_cd:l claim_cnt_last_3_yr:l claim_amt_last_3_yr:l claim_appr_cnt_last_3_yr:l claim_appr_amt_last_3_yr:l "
    "claim_wip_last_1_yr:l claim_appr_rate_last_3_yr:d chart:s chart_kpi:s",
    f"""with f0 as ({FACT_SQL}), c as (select q.*, s.agt_cd from e_pack_claim q join (select distinct pol_num, wa_cd_1 as agt_cd from f0) s
  on q.pol_num = s.pol_num where q.clm_recv_dt between date '1997-05-31' and {RPT})
select *, cast(claim_appr_cnt_last_3_yr as double) / claim_cnt_last_3_yr as claim_appr_rate_last_3_yr, '3yr_claim' as chart,
  'pol_cnt_or_amt' as chart_kpi
from (select agt_cd, count(distinct clm_id) as claim_cnt_last_3_yr, sum(clm_prvd_amt * 1000) as claim_amt_last_3_yr,
    count(distinct case when clm_stat_code = 'A' then clm_id end) as claim_appr_cnt_last_3_yr,
    coalesce(sum(case when clm_stat_code = 'A' then clm_aprov_amt * 1000 end), 0) as claim_appr_amt_last_3_yr,
    count(distinct case when clm_stat_code = 'I' and clm_recv_dt >= date '1999-05-31' then clm_id end) as claim_wip_last_1_yr
  from c group by 1)""",
)(lambda t: plans.claim_kpis(t.e_pack_claim, fact(t), REPORT_DATE))

PER_CTE = f"""{F_CTE}, per as (select *, 1 - cast(lap_14m_pol as double) / nullif(all_pol_cnt, 0) as per_14m,
  1 - cast(lap_20m_pol as double) / nullif(all_pol_cnt, 0) as per_20m, 1 - cast(lap_26m_pol as double) / nullif(all_pol_cnt, 0) as per_26m,
  coalesce(cast(refused as double) / nullif(year_pol, 0), 0) as nt_rate_12m
from (select agt_cd, count(distinct case when {TAKEN} then pol_num end) as all_pol_cnt,
    count(distinct case when lapsed = 1 and end_month between pol_month and pol_month + 14 then pol_num end) as lap_14m_pol,
    count(distinct case when lapsed = 1 and end_month between pol_month and pol_month + 20 then pol_num end) as lap_20m_pol,
    count(distinct case when lapsed = 1 and end_month between pol_month and pol_month + 26 then pol_num end) as lap_26m_pol,
    count(distinct case when last_n_month_eff_cvg between -12 and -1 then pol_num end) as year_pol,
    count(distinct case when last_n_month_eff_cvg between -12 and -1 and is_non_taken = 1 then pol_num end) as refused
  from f where cvg_typ = 'B' group by 1))"""


def kept(t: Tables, rows=None):
    return shared(t, "retention", lambda: plans.retention(fact(t) if rows is None else rows, agents(t), t.e_programme))


query(
    "d44_retention",
    "agt_cd:l all_pol_cnt:l lap_14m_pol:l lap_20m_pol:l lap_26m_pol:l per_14m:d per_20m:d per_26m:d nt_rate_12m:d "
    "per_19m_external:d chart:s chart_kpi:s",
    f"""with {PER_CTE} select per.*, cast(p.m19_per as double) / 100 as per_19m_external, 'lapse_kpi' as chart, 'pol_cnt' as chart_kpi
from per left join e_programme p on per.agt_cd = p.agt_cd""",
)(lambda t: kept(t))

RISK_SQL = f"""with f0 as ({FACT_SQL}), p as (select pol_num, max(wa_cd_1) as agt_cd, max(po_num) as po_num, max(pol_eff_dt) as pol_eff_dt,
    max(pd_to_dt) as pd_to_dt, max(pmt_mode_map) as pmt_mode from f0 group by 1)
select * from (select p.agt_cd, p.pol_num, p.po_num, k.cli_nm, p.pmt_mode, s.lapse_score, p.pol_eff_dt, p.pd_to_dt,
    row_number() over (partition by p.agt_cd order by s.lapse_score desc, p.pol_num) as rn
  from e_lapse_score s join p on s.pol_num = p.pol_num left join e_client k on p.po_num = k.cli_num
  where s.lapse_score >= 0.05 and year(p.pd_to_dt) >= 2000)"""


def risks(t: Tables):
    return shared(t, "risks", lambda: plans.lapse_risks(t.e_lapse_score, fact(t), t.e_client, REPORT_DATE, "202005"))


query(
    "d45_lapse_risks",
    "agt_cd:l pol_num:l po_num:l cli_nm:s pmt_mode:s lapse_score:d pol_eff_dt:D pd_to_dt:D",
    RISK_SQL + " where rn <= 10",
)(risks)
query(
    "d45_lapse_risk_lists",
    "agt_cd:l pol_num:s",
    f"select agt_cd, string_agg(cast(pol_num as varchar), ',' order by rn) as pol_num from ({RISK_SQL}) where rn <= 3 group by 1",
)(lambda t: plans.top_policies(risks(t), "lapse_score").withColumn("pol_num", F.concat_ws(",", F.col("pol_num").cast("array<string>"))))

LEADS_SQL = f"""with {F_CTE}, sell as (select po_num, max(wa_cd_1) as agt_cd from f0 group by 1),
c1 as (select * from (select l.po_num, l.p_1, s.agt_cd, row_number() over (partition by s.agt_cd order by l.p_1 desc, l.po_num) as rn
  from e_lead_score l join sell s on l.po_num = s.po_num where s.agt_cd in (select agt_cd from ag)) where rn <= 10),
m as (select po_num, case when health_base > 0.1 then '*' else '' end as health_base,
    case when inv_base = top and not coalesce(health_base = top, false) then '*' else '' end as inv_base,
    case when health_rider > 0.1 then '*' else '' end as health_rider, case when riders > 0.1 then '*' else '' end as riders
  from (select *, greatest(health_base, inv_base, health_rider, riders) as top from e_product_score where deployment_approval_status = 'APPROVED')),
o as (select cli_num as po_num, max(pol_num) as pol_num from e_link where link_typ = 'O' and rec_status = 'A' group by 1)
select c1.agt_cd, c1.po_num, o.pol_num, m.* exclude (po_num), c1.p_1, row_number() over (partition by c1.agt_cd order by c1.p_1 desc, c1.po_num) as rn2
from c1 join m on c1.po_num = m.po_num join o on c1.po_num = o.po_num"""


def next_leads(t: Tables):
    return shared(
        t, "leads", lambda: plans.next_leads(t.e_lead_score, t.e_product_score, fact(t), agents(t), t.e_link, REPORT_DATE)
    )


query(
    "d46_next_leads",
    "agt_cd:l po_num:l pol_num:l health_base:s inv_base:s health_rider:s riders:s p_1:d",
    LEADS_SQL,
)(next_leads)

query(
    "d46_lead_lists",
    "agt_cd:l pol_num:s",
    f"select agt_cd, string_agg(cast(pol_num as varchar), ',' order by rn2) as pol_num from ({LEADS_SQL}) where rn2 <= 3 group by 1",
)(lambda t: plans.top_policies(next_leads(t), "p_1").withColumn("pol_num", F.concat_ws(",", F.col("pol_num").cast("array<string>"))))

query("d47_title_dates", "agt:l title_month:D", "select agt_cd as agt, date '2000-06-15' as title_month from e_programme")(
    lambda t: plans.title_dates(t.e_programme, REPORT_DATE)
)

QUALIFIED_CTE = f"""al as (select agt_cd, coalesce(monthly_allowance, 0) * 1000 as monthly_allowance,
    try_strptime(qualify_date, '%Y%m')::date as q from e_allowance),
q0 as (select ag.*, coalesce(al.monthly_allowance, 0) as monthly_allowance, al.q from ag left join al on ag.agt_cd = al.agt_cd),
qa as (select * exclude (q), coalesce(q, (select max(q) from q0)) as qualified from q0)"""
NEXT = "case tier when 'Platinum' then 'MDRT' when 'MDRT' then 'COT' else 'TOT' end"
TARGET = f"case {NEXT} when 'MDRT' then 721626600 when 'COT' then 2164879800 else 4329759600 end"


def qualified(t: Tables):
    return shared(t, "qualification", lambda: plans.qualification(agents(t), t.e_allowance))


query(
    "d47_agent_page1",
    "agt_cd:l agt_nm:s tier:s tenure_mth:l monthly_allowance:l qualify_date:s next_qualify_check:s report_month:s qualify_tenure:l "
    "last_mth_ape:l rank_of_last_mth_ape:l next_tier:s next_tier_benchmark:l tenure_ym:s monthly_allowance_rank:d",
    f"""with {F_CTE}, {QUALIFIED_CTE}, m as (select wa_cd_1 as agt_cd, sum(adjust_ape) as a from f0 where last_n_month_eff_cvg = -1 group by 1),
rk as (select *, cast(floor(rank() over (order by a desc) + (count(*) over (partition by a) - 1) / 2) as bigint) as rnk from m),
s0 as (select *, (select count(*) from qa) as n, floor(rank() over (order by monthly_allowance desc)
    + (count(*) over (partition by monthly_allowance) - 1) / 2) as ar from qa),
s1 as (select *, least(cast(n - ar as double) / n, 0.99) as st from s0)
select s1.*, strftime(qualified, '%Y-%m') as qualify_date, strftime(qualified + interval 11 month, '%Y-%m') as next_qualify_check,
  '2000-05' as report_month, (2000 * 12 + 5) - {idx("qualified")} + 1 as qualify_tenure, coalesce(rk.a, 0) as last_mth_ape,
  rk.rnk as rank_of_last_mth_ape, {NEXT} as next_tier, {TARGET} as next_tier_benchmark,
  cast(floor(tenure_mth / 12) as int) || ' y ' || (tenure_mth % 12 + 12) % 12 || ' m' as tenure_ym,
  case when st = (select min(st) from s1) then 0 else st end as monthly_allowance_rank
from s1 left join rk on s1.agt_cd = rk.agt_cd""",
)(lambda t: plans.agent_page1(qualified(t), fact(t), REPORT_DATE))

P2 = ("last_3m_pol", "last_3m_ape", "last_3m_lap", "last_3m_rep", "last_3m_rid", "last_3m_po")


def means_sql(prefix: str) -> str:
    return ", ".join(
        [f"cast(sum({c}) as double) / count({c}) as {prefix}_{c}" for c in P2]
        + [
            f"cast(sum(last_3m_ape) - sum(last_3m_rid) as double) / nullif(sum(last_3m_po), 0) as {prefix}_last_3m_pol_size",
            f"cast(sum(last_3m_ape) as double) / nullif(sum(last_3m_po), 0) as {prefix}_last_3m_po_size",
        ]
    )


query(
    "d48_agent_page2",
    "agt_cd:l tier:s current_tier:s next_tier:s last_3m_pol_size:d last_3m_po_size:d "
    + " ".join(f"{c}:l" for c in P2)
    + " "
    + " ".join(f"{p}_{c}:d" for p in ("current", "next", "platinum") for c in (*P2, "last_3m_pol_size", "last_3m_po_size")),
    f"""with {R_CTE}, o as (select r.agt_cd, {", ".join(f"coalesce({c}, 0) as {c}" for c in P2)}, last_3m_pol_size, last_3m_po_size, ag.tier,
  ag.tier as current_tier, {NEXT.replace("tier", "ag.tier", 1)} as next_tier from r join ag on r.agt_cd = ag.agt_cd)
select o.*, c.* exclude (ct), n.* exclude (nt), p.* from o left join (select tier as ct, {means_sql("current")} from o group by 1) c on o.tier = c.ct
left join (select tier as nt, {means_sql("next")} from o group by 1) n on o.next_tier = n.nt cross join (select {means_sql("platinum")} from o) p""",
)(lambda t: plans.agent_page2(ratios(t), agents(t)))


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def say_sql(template: str, *figures: str) -> str:
    out = sql_text(template)
    for i, figure in enumerate(figures):
        out = f"replace({out}, '{{{i}}}', coalesce({figure}, ''))"
    return out


def pct(c: str) -> str:
    return f"(cast(trunc(({c}) * 100) as int) || '%')"


def advice_sql(lang: str) -> str:
    w = ADVICE_TEXT[lang]
    rid, rep = "coalesce(last_3m_rid, 0) / cast(last_3m_ape as double)", "coalesce(last_6m_rep, 0) / cast(last_6m_ape as double)"
    million = "cast(cast(cast(trunc(last_6m_pol_size / 100000) as int) / 10 as decimal(12,1)) as varchar)"
    hints = [
        (f"{rid} <= b_rid - 0.1", say_sql(w["riders"][0], pct(rid), pct("b_rid"))),
        (f"{rep} <= b_rep - 0.1", say_sql(w["repeat"][0], pct(rep), pct("b_rep"))),
        ("last_6m_pol_size <= b_size * 0.7", say_sql(w["size"][0], million, "cast(cast(trunc(b_size / 1000000) as int) as varchar)")),
        ("last_6m_fam < b_fam", say_sql(w["family"][0], "cast(last_6m_fam as varchar)", "cast(cast(trunc(b_fam) as int) as varchar)")),
        ("per_14m <= b_per - 0.1", say_sql(w["quality"][0], pct("1 - per_14m"), pct("1 - b_per"))),
    ]
    ideas = ", ".join([sql_text(w["open"][0])] + [f"case when {c} then {m} end" for c, m in hints] + [sql_text(x) for x in w["fill"]])
    praise = ", ".join(say_sql(x, "next_qualify_check") for x in w["praise"])
    missed = ", ".join(say_sql(x, "agt_nm") for x in w["missed"])
    return f"""with {R_CTE}, {PER_CTE[len(F_CTE) + 2:]}, {QUALIFIED_CTE},
j as (select qa.agt_cd, qa.agt_nm, qa.tier, strftime(qualified + interval 11 month, '%Y-%m') as next_qualify_check, r.* exclude (agt_cd), per.per_14m,
    (select cast(sum(last_3m_rid) as double) / sum(last_3m_ape) from r) as b_rid, (select cast(sum(last_3m_rep) as double) / sum(last_3m_ape) from r) as b_rep,
    (select avg(last_3m_pol_size) from r) as b_size, (select median(last_3m_fam) from r) as b_fam, (select median(per_14m) from per) as b_per
  from qa left join r on qa.agt_cd = r.agt_cd left join per on qa.agt_cd = per.agt_cd),
d as (select agt_cd, tier as level, agt_nm as agt_name, case when coalesce(last_3m_ape, 0) / 3 >= 50000000 then [{praise}]
    when coalesce(last_3m_ape, 0) / 3 > 0 and coalesce(last_3m_pol, 0) > 0 then list_filter([{ideas}], lambda x: x is not null)[1:4]
    else [{missed}] end as l from j)
select *, l[1] as diag_0, l[2] as diag_1, l[3] as diag_2, l[4] as diag_3 from d"""


def advised(t: Tables, lang: str):
    rows = stored_fact(t)
    return plans.advice(ratios(t, rows), kept(t, rows), qualified(t), lang=lang)


for _lang in ("en", "vi"):
    query(
        f"d49_advice_{_lang}",
        "agt_cd:l level:s agt_name:s diag_0:s diag_1:s diag_2:s diag_3:s",
        advice_sql(_lang),
    )(lambda t, lang=_lang: advised(t, lang))

query(
    "d50_agent_overview",
    "agt_cd:l agt_nm:s tier:s ape_since_qualify:l pol_since_qualify:l active_month:l total_custm:l best_month:l best_case:l "
    "active_custm:l total_ape:l which_month_max:s max_mth_ape:l ape_this_year:l next_tier:s next_tier_benchmark:l gap_to_next_tier:l "
    "qualify_ape_target:l qualify_pol_target:l qualify_act_target:l",
    f"""with {F_CTE}, {QUALIFIED_CTE}, g as (select f.*, {idx("qa.qualified")} as qm from f join qa on f.agt_cd = qa.agt_cd),
a as (select agt_cd, sum(case when cvg_month >= qm then adjust_ape end) as ape_since_qualify,
    count(distinct case when cvg_month >= qm and cvg_typ = 'B' then pol_num end) as pol_since_qualify,
    count(distinct case when cvg_month >= qm then last_n_month_eff_cvg end) as active_month, count(distinct po_num) as total_custm,
    sum(adjust_ape) as total_ape, sum(case when year(cvg_eff_dt) = 2000 then adjust_ape end) as ape_this_year from g where {TAKEN} group by 1),
mm as (select agt_cd, cvg_month, sum(adjust_ape) as v from g where {TAKEN} group by 1, 2),
bm as (select agt_cd, v as best_month, cvg_month as mo, row_number() over (partition by agt_cd order by v desc, cvg_month) as rn from mm),
cs as (select agt_cd, max(v) as best_case from (select agt_cd, pol_num, sum(adjust_ape) as v from g where {TAKEN} group by 1, 2) group by 1),
ac as (select agt_cd, count(distinct po_num) as active_custm from g where pol_stat_cd = '1' and pol_trmn_dt is null group by 1)
select qa.agt_cd, qa.agt_nm, qa.tier, coalesce(ape_since_qualify, 0) as ape_since_qualify, coalesce(pol_since_qualify, 0) as pol_since_qualify,
  coalesce(active_month, 0) as active_month, total_custm, best_month, best_case, active_custm, total_ape,
  (mo - 1) // 12 || '-' || lpad(cast((mo - 1) % 12 + 1 as varchar), 2, '0') as which_month_max, best_month as max_mth_ape, ape_this_year,
  {NEXT} as next_tier, {TARGET} as next_tier_benchmark, greatest({TARGET} - coalesce(ape_this_year, 0), 0) as gap_to_next_tier,
  600000000 as qualify_ape_target, 30 as qualify_pol_target, 6 as qualify_act_target
from qa left join a on qa.agt_cd = a.agt_cd left join bm on qa.agt_cd = bm.agt_cd and bm.rn = 1 left join cs on qa.agt_cd = cs.agt_cd
left join ac on qa.agt_cd = ac.agt_cd""",
)(lambda t: plans.agent_overview(stored_fact(t), qualified(t), REPORT_DATE))

query(
    "d51_premium_rank",
    "agt_cd:l rank_fyp_last_mth:l total_inforce_agt:l rank_per_fyp_last_mth:d",
    f"""with f0 as ({FACT_SQL}), m as (select wa_cd_1 as agt_cd, sum(adjust_ape) as a from f0 where last_n_month_eff_cvg = -1 group by 1),
n as (select count(*) as n from e_agent where {STAFF})
select agt_cd, rank() over (order by a desc) as rank_fyp_last_mth, n as total_inforce_agt, cast(rank() over (order by a desc) as double) / n
  as rank_per_fyp_last_mth from m cross join n""",
)(lambda t: plans.premium_rank(fact(t), plans.agency_agents(t.e_agent)))


@query(
    "d38_adjusted_premium",
    "pol_num:l plan_code:s days:l cvg_prem:d adjusted:d",
    f"""select c.pol_num, c.plan_code, least(p.pol_trmn_dt, c.cvg_del_dt) - p.pol_eff_dt as days, c.cvg_prem,
  {ADJUSTED.replace("days", "(least(p.pol_trmn_dt, c.cvg_del_dt) - p.pol_eff_dt)")} as adjusted
from (select pol_num, plan_code, cvg_prem, cvg_del_dt from e_coverage) c join e_policy p on c.pol_num = p.pol_num""",
)
def adjusted(t: Tables):
    rows = t.e_coverage.select("pol_num", "plan_code", "cvg_prem", "cvg_del_dt").join(
        t.e_policy.select("pol_num", "pol_eff_dt", "pol_trmn_dt", "pmt_mode"), "pol_num"
    )
    rows = rows.withColumn("days", F.datediff(F.least("pol_trmn_dt", "cvg_del_dt"), "pol_eff_dt"))
    premium = adjusted_premium(
        "days", "pmt_mode", "cvg_prem", ape("cvg_prem", "pmt_mode"), F.col("plan_code").isin(*SINGLE)
    )
    return rows.select("pol_num", "plan_code", "days", "cvg_prem", premium.alias("adjusted"))


@query(
    "d39_owner_relation",
    "pol_num:l po_num:l cli_num:l gap:l relation:s",
    f"""select pol_num, po_num, cli_num, gap, {RELATION} as relation from (select l.pol_num, l.cli_num as po_num, c.cli_num,
    case when l.cli_num <> c.cli_num then year(i.birth_dt) - year(o.birth_dt) end as gap, o.sex_code as g1, i.sex_code as g2
  from e_link l join e_coverage c on l.pol_num = c.pol_num join e_client o on l.cli_num = o.cli_num join e_client i on c.cli_num = i.cli_num
  where l.link_typ = 'O')""",
)
def relation(t: Tables):
    who = t.e_client.select("cli_num", "birth_dt", "sex_code")
    rows = (
        t.e_link.where("link_typ = 'O'").select("pol_num", F.col("cli_num").alias("po_num"))
        .join(t.e_coverage.select("pol_num", "cli_num"), "pol_num")
        .join(who.toDF("po_num", "b1", "s1"), "po_num")
        .join(who.toDF("cli_num", "b2", "s2"), "cli_num")
    )
    same = F.col("po_num") == F.col("cli_num")
    rows = rows.withColumn("gap", F.when(~same, F.year("b2") - F.year("b1")))
    return rows.withColumn("relation", owner_relation(same, "gap", "s1", "s2"))


PACK = (
    "d40_agent_kpis", "d41_agent_ratios", "d42_sales_by_month", "d42_sales_by_type", "d43_claim_kpis", "d44_retention",
    "d45_lapse_risks", "d45_lapse_risk_lists", "d46_next_leads", "d46_lead_lists", "d47_agent_page1", "d48_agent_page2",
    "d49_advice_en", "d50_agent_overview",
)
PACK_MONTH = "2000-05"


@query(
    "s14_pack_exports",
    "report:s agt_cd:l report_month:s n:l",
    " union all ".join(
        f"select '{name}' as report, m.agt_cd, '{PACK_MONTH}' as report_month, count(*) as n "
        f"from (select distinct agt_cd from e_programme) m left join (select agt_cd from ({REGISTRY[name].sql})) r on m.agt_cd = r.agt_cd group by 2"
        for name in PACK
    ),
)
def pack_exports(t: Tables):
    """All outputs of the pack, from one stored fact, stamped, joined to the programme, and read back.

    What several outputs show of an agent (KPIs, retention, risks, leads) is worked out once.
    """
    stored_fact(t)
    t._seen[SHARED] = {}
    reports = {name: REGISTRY[name].build(t) for name in PACK}
    members = t.e_programme.select("agt_cd").distinct()
    folder = f"{shared_dir(t.spark)}/tidewell-pack-{uuid.uuid4().hex}"
    written = sources.export_reports(reports, members, folder, stamp={"report_month": PACK_MONTH})
    stacked = None
    for name, path in written.items():
        columns = sources.for_all_agents(members, reports[name].drop("report_month")).columns
        schema = ", ".join(f"`{c}` {'bigint' if c == 'agt_cd' else 'string'}" for c in (*columns, "report_month"))
        counted = (
            sources.read_csv(t.spark, path, schema).groupBy("agt_cd", "report_month").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("report"), "agt_cd", "report_month", "n")
        )
        stacked = counted if stacked is None else stacked.unionByName(counted)
    return stacked
