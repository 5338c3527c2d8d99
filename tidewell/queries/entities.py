"""The driver's tables seen as policies, agents, customers, claims and ledgers.

Each entity is one SELECT in the SQL that Spark and DuckDB share, so both sides of a check
start from the same rows. ``{name}`` marks stand for a driver table or another entity.
"""

from __future__ import annotations

ORDERS_AS_OF = "2000-06-15"
REPORT_DATE = "2000-05-31"
PREVIOUS_DATE = "2000-04-30"
EVENTS_AS_OF = "2024-01-31"

_PLAN = """case cast(floor({key} / 22) as bigint) % 16
  when 0 then 'EDB10' when 1 then 'ENC12' when 2 then 'EIC12' when 3 then 'RUV01' when 4 then 'RUV04'
  when 5 then 'UL038' when 6 then 'CA360' when 7 then 'RPA03' when 8 then 'UL035' when 9 then 'UL007'
  when 10 then 'FDB01' when 11 then 'BIC01' when 12 then 'MI007' when 13 then 'END01' when 14 then 'TRM01'
  else 'SAV01' end"""
_LOC = """case {key} % 4 when 0 then 'TCB' when 1 then 'SAG' when 2 then 'VTI' else 'HNO' end
  || lpad(cast({key} as string), 2, '0')"""
_STATUS = "substr('123456789ABCDEFHLMNRTX', cast({key} % 22 + 1 as int), 1)"
_VERSION = "lpad(cast({key} % 10 as string), 2, '0')"
_MONEY = "cast({0} as decimal(18,2))"


def plan(key: str) -> str:
    return _PLAN.replace("{key}", key)


def loc(key: str) -> str:
    return _LOC.replace("{key}", key)


def status(key: str) -> str:
    return _STATUS.replace("{key}", key)


def version(key: str) -> str:
    return _VERSION.replace("{key}", key)


def money(c: str) -> str:
    return _MONEY.replace("{0}", c)


def away(kept: str, key: str) -> str:
    """The key, or in rows of which ``kept`` does not hold, a number that no other table has."""
    return f"case when {kept} then {key} else -1 - ({key}) end"


MARGIN_COLUMNS = """
  cast(0.10 + (p_partkey % 7) / 100.0 as decimal(8,4)) as nbv_margin_banca_other_banks,
  cast(0.12 + (p_partkey % 5) / 100.0 as decimal(8,4)) as nbv_margin_other_channel_affinity,
  cast(0.20 + (p_partkey % 9) / 100.0 as decimal(8,4)) as nbv_margin_agency,
  cast(0.15 + (p_partkey % 4) / 100.0 as decimal(8,4)) as nbv_margin_dmtm,
  cast(0.08 + (p_partkey % 6) / 100.0 as decimal(8,4)) as nbv_margin_other_channel,
  cast(0.11 + (p_partkey % 8) / 100.0 as decimal(8,4)) as nbv_margin_banca_tcb,
  cast(0.13 + (p_partkey % 3) / 100.0 as decimal(8,4)) as nbv_margin_banca_scb,
  cast(0.14 + (p_partkey % 2) / 100.0 as decimal(8,4)) as nbv_margin_banca_vti"""

ENTITIES: dict[str, str] = {}

ENTITIES["e_policy"] = f"""
select o_orderkey as pol_num,
  cast(o_orderdate as date) as pol_iss_dt, cast(o_orderdate as date) as frst_iss_dt,
  cast(o_orderdate as date) + cast(o_orderkey % 7 as int) as pol_eff_dt,
  cast(o_orderdate as date) - cast(o_orderkey % 11 as int) as sbmt_dt,
  case when o_orderkey % 22 >= 9
    then cast(o_orderdate as date) + cast((o_orderkey * 13) % 1200 as int) end as pol_trmn_dt,
  cast(o_orderdate as date) + cast(o_orderkey % 20 as int) as cnfrm_acpt_dt,
  cast(o_orderdate as date) + cast((o_orderkey % 9) * 365 as int) as pd_to_dt,
  cast(o_orderdate as date) + cast((o_orderkey % 9) * 330 as int) as last_pd_to_dt,
  cast(o_orderdate as date) + cast((o_orderkey % 6) * 365 as int) as last_avy_dt,
  {money("o_totalprice")} as mode_prem,
  case cast(floor(o_orderkey / 5) as bigint) % 4
    when 0 then '12' when 1 then '06' when 2 then '03' else '01' end as pmt_mode,
  {status("o_orderkey")} as pol_stat_cd,
  {plan("o_orderkey")} as plan_code_base, {version("o_orderkey")} as vers_num_base,
  case cast(floor(o_orderkey / 3) as bigint) % 8 when 0 then '01' when 1 then '03' when 2 then '48'
    when 3 then '05' when 4 then '09' when 5 then '*' when 6 then '24' else '99' end as dist_chnl_cd,
  case cast(floor(o_orderkey / 4) as bigint) % 5 when 0 then 'EPOS' when 1 then 'SHOPEE'
    when 2 then 'ECOMMERCE' when 3 then 'CLERK' end as nb_user_id,
  case when o_orderkey % 6 = 0 then '82' else '78' end as crcy_code,
  cast(floor(o_custkey / 15) as bigint) as agt_code,
  case when o_orderkey % 3 = 0 then cast(floor(o_custkey / 30) as bigint)
    else cast(floor(o_custkey / 15) as bigint) end as wa_cd_1,
  case when o_orderkey % 10 = 0 then cast(floor(o_custkey / 45) as bigint) end as wa_cd_2,
  o_orderpriority as wrk_area,
  case when cast(o_orderdate as date) <= date '{REPORT_DATE}' then date '{REPORT_DATE}'
    else date '2000-06-30' end as image_date
from {{orders}}"""

ENTITIES["e_policy_mart"] = f"""
select p.pol_num, o.o_custkey as po_num, p.plan_code_base as plan_code, o.o_orderpriority as plan_nm, p.pol_iss_dt,
  p.pol_stat_cd, 'S' || p.pol_stat_cd as pol_stat_desc, p.mode_prem as tot_ape, p.wa_cd_1 as wa_code, p.dist_chnl_cd
from {{e_policy}} p join {{orders}} o on p.pol_num = o.o_orderkey"""

ENTITIES["e_link"] = f"""
select o_orderkey as pol_num, o_custkey as cli_num, 'O' as link_typ,
  case when o_orderkey % 9 = 0 then 'D' else 'A' end as rec_status, 'A1' as addr_typ,
  case when cast(o_orderdate as date) <= date '{REPORT_DATE}' then date '{REPORT_DATE}'
    else date '2000-06-30' end as image_date
from {{orders}}
union all
select o_orderkey, cast(floor(o_custkey / 2) as bigint), 'I', 'A', 'A1',
  case when cast(o_orderdate as date) <= date '{REPORT_DATE}' then date '{REPORT_DATE}'
    else date '2000-06-30' end
from {{orders}}"""

ENTITIES["e_coverage"] = f"""
select l_orderkey as pol_num, l_suppkey * 15 + l_linenumber as cli_num,
  case when l_linenumber = 1 then {plan("l_orderkey")}
    else 'R' || lpad(cast(l_partkey % 50 as string), 2, '0') end as plan_code,
  {version("l_orderkey")} as vers_num,
  case when l_linenumber = 1 then 'B' else 'R' end as cvg_typ,
  case when l_partkey % 13 = 0 then 'C' else 'O' end as cvg_reasn,
  {status("(l_orderkey + l_linenumber)")} as cvg_stat_cd,
  cast(l_shipdate as date) as cvg_eff_dt,
  case when l_returnflag = 'R' then cast(l_shipdate as date) + cast(l_partkey % 700 as int) end as cvg_del_dt,
  {money("l_extendedprice")} as cvg_prem,
  case l_partkey % 5 when 0 then '0' when 1 then '1' when 2 then '3' when 3 then '4' end as par_code,
  cast(l_quantity as bigint) * 1000 as face_amt,
  cast(l_quantity as bigint) % 20 + 1 as prem_dur,
  cast(l_shipdate as date) + cast((l_partkey % 20) * 365 as int) as xpry_dt,
  case l_partkey % 10 when 0 then '0' when 1 then '1' when 2 then '2' when 3 then '3' when 4 then '4'
    when 5 then '5' when 6 then '10' when 7 then '31' when 8 then '51' else '52' end as rel_to_insrd,
  case when cast(l_shipdate as date) <= date '2000-12-31' then date '{REPORT_DATE}'
    else date '2000-06-30' end as image_date
from {{lineitem}}"""

ENTITIES["e_client"] = f"""
select c_custkey as cli_num, c_name as cli_nm,
  case when c_custkey % 11 = 0 then cast(null as string) when c_custkey % 2 = 0 then 'M' else 'F' end as sex_code,
  case when c_custkey % 17 <> 0 then date '1930-01-01' + cast((c_custkey * 37) % 26000 as int) end as birth_dt,
  'ID' || cast(c_custkey as string) as id_num,
  case when c_custkey % 7 <> 0
    then '+84 (9) ' || lpad(cast(c_custkey as string), 8, '0') end as mobl_phon_num,
  case when c_custkey % 3 = 0 then '09' || lpad(cast(cast(floor(c_custkey / 2) as bigint) as string), 8, '0') end as prim_phon_num,
  case when c_custkey % 5 = 0 then '12-' || cast(c_custkey % 90 as string) end as othr_phon_num,
  case when c_custkey % 4 = 0 then '01' else '02' end as sms_stat_cd,
  case when c_custkey % 6 <> 0 then 'user' || cast(c_custkey as string) || '@mail.example' end as email_addr,
  case when c_custkey % 3 = 0 then '2' else '1' end as service_method_recv,
  date '{REPORT_DATE}' as image_date
from {{customer}}"""

ENTITIES["e_address"] = f"""
select c_custkey as cli_num, 'A1' as addr_typ,
  case when c_custkey % 40 <> 0 then lpad(cast(c_nationkey as string), 2, '0') || '00' end as zip_code,
  date '{REPORT_DATE}' as image_date
from {{customer}}"""

ENTITIES["e_province"] = f"""
select lpad(cast(n_nationkey as string), 2, '0') as prov_id,
  case n_nationkey when 0 then 'HN' when 1 then 'HCM' when 2 then 'Đà Nẵng' else n_name end as prov_nm,
  date '{REPORT_DATE}' as image_date
from {{nation}}"""

ENTITIES["e_agent"] = f"""
select s_suppkey as agt_code,
  case when s_suppkey % 20 = 19 then 'Open Location' else s_name end as agt_nm,
  case when s_suppkey % 10 = 3 then cast(null as string) else {loc("s_nationkey")} end as loc_code,
  case when s_suppkey % 10 = 3 then cast(null as string) else {loc("s_nationkey")} end as loc_cd,
  'U' || cast(cast(floor(s_suppkey / 5) as bigint) as string) as unit_code,
  'T' || cast(s_suppkey % 6 as string) as team_code, 'BR' || cast(s_nationkey as string) as br_code,
  'R' || cast(s_suppkey % 4 as string) as rank_cd, 'R' || cast(s_suppkey % 4 as string) as rank_code,
  s_suppkey * 15 as can_num, 'C' || cast(s_suppkey % 12 as string) as class_num,
  case s_suppkey % 5 when 0 then '01' when 1 then '98' when 2 then '01' when 3 then '04' else '02' end as comp_prvd_num,
  case when s_suppkey % 7 = 0 then '99' else '01' end as stat_cd,
  case when s_suppkey % 13 = 0 then '2' else '1' end as agt_stat_code,
  case when s_suppkey % 3 = 0 then '03' else '01' end as chnl_cd,
  case when s_suppkey % 6 = 5 then 'Banca' else 'Agency' end as channel,
  date '1994-01-01' + cast((s_suppkey * 29) % 2400 as int) as agt_join_dt,
  case when s_suppkey % 17 = 16 then date '1999-12-31' end as agt_term_dt,
  date '1994-01-01' + cast((s_suppkey * 31) % 2400 as int) as cntrct_eff_dt,
  '09' || lpad(cast(s_suppkey as string), 8, '0') as mobl_phon_num,
  'SUP' || cast(s_suppkey % 3 as string) as agt_sup,
  case when s_suppkey % 2 = 0 then 'Y' else 'N' end as epos_ind,
  case when s_suppkey % 3 = 0 then 'Y' else 'N' end as dtk_ind,
  case when s_suppkey % 5 = 0 then 'Y' else 'N' end as cmp_ind,
  case when s_suppkey % 8 = 0 then 'Y' else 'N' end as mba_ind,
  date '{REPORT_DATE}' as image_date
from {{supplier}}"""

ENTITIES["e_candidate"] = """
select c_custkey as can_num, 'ID' || cast(c_custkey as string) as id_num,
  date '1930-01-01' + cast((c_custkey * 37) % 26000 as int) as can_dob,
  case when c_custkey % 2 = 0 then 'M' else 'F' end as sex_code,
  'can' || cast(c_custkey as string) || '@mail.example' as email_addr,
  case when c_custkey % 4 = 0 then 'G1' when c_custkey % 4 = 1 then 'G2' else 'G9' end as agent_group
from {customer}"""

ENTITIES["e_unit"] = """
select 'U' || cast(unit as string) as stru_grp_cd, case when unit % 7 = 0 then 'BR' else 'UN' end as stru_grp_typ, mgr_cd
from (select cast(floor(s_suppkey / 5) as bigint) as unit, min(s_suppkey) as mgr_cd from {supplier}
  group by cast(floor(s_suppkey / 5) as bigint)) u"""

ENTITIES["e_line"] = """
select s_suppkey as sub_agt_cd, cast(floor(s_suppkey / 2) as bigint) as agt_cd, 1 as rpt_level from {supplier}
union all
select s_suppkey, cast(floor(s_suppkey / 4) as bigint), 2 from {supplier}"""

ENTITIES["e_rpt"] = """
select s.s_suppkey as sub_agt_cd,
  case when s.s_suppkey % 25 = 24 then cast(null as bigint) else (s.s_suppkey * 7 + lv.level) % 10 end as agt_cd,
  lv.level as rpt_level
from {supplier} s join (values (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2), (2, 3), (2, 4), (2, 5))
  as lv(kind, level) on lv.kind = s.s_suppkey % 3"""

ENTITIES["e_group"] = f"""
select {loc("n_nationkey")} as loc_code, cast(n_nationkey % 10 as bigint) as loc_mrg from {{nation}}"""

ENTITIES["e_mgr_map"] = f"""
select {away("s_acctbal >= 0", "s_suppkey")} as dsr_cd, cast(floor(s_suppkey / 3) as bigint) as mgr_cd from {{supplier}}"""

ENTITIES["e_location"] = f"""
select {loc("n_nationkey")} as loc_cd, n_name as loc_desc,
  case n_nationkey % 6 when 0 then 'AGT' when 1 then 'MGA' when 2 then 'BK' when 3 then 'DR'
    when 4 then 'MI' else 'XX' end as chnl,
  'RH' || cast(n_regionkey as string) as rh_code, n_name as rh_name
from {{nation}}"""

ENTITIES["e_rank"] = """
select distinct 'R' || cast(s_suppkey % 3 as string) as rank_cd from {supplier}"""

ENTITIES["e_channel"] = """
select * from (values ('01', 'AGT'), ('98', 'AGT'), ('02', 'BK'), ('04', 'DR'), ('12', 'XX'))
  as t(comp_prvd_num, chnl_cd)"""

ENTITIES["e_codes"] = f"""
select fld_nm, fld_valu, fld_valu_desc, fld_valu_desc as fld_valu_desc_eng, fld_lkup_valu,
  date '{REPORT_DATE}' as image_date
from (values
  ('AGENT_GROUP', 'G1', 'Full time', ''), ('AGENT_GROUP', 'G2', 'Part time', ''),
  ('POS_CHG_TYP', '10', 'Surrender request', ''), ('POS_CHG_TYP', '12', 'Maturity request', ''),
  ('POS_CHG_TYP', '37', 'Expiry request', ''),
  ('STAT_CODE', '1', 'Paying', ''), ('STAT_CODE', '2', 'Waiver', ''), ('STAT_CODE', '3', 'Paid up', ''),
  ('STAT_CODE', '5', 'Reduced', ''), ('STAT_CODE', '7', 'Support', ''), ('STAT_CODE', 'A', 'Not taken', ''),
  ('STAT_CODE', 'E', 'Surrendered', ''), ('STAT_CODE', 'H', 'Expired', ''),
  ('POS_SRV_CTR', 'BC0', 'Center 0', ''), ('POS_SRV_CTR', 'BC1', 'Center 1', ''),
  ('POS_SRV_CTR', 'BC2', 'Center 2', ''),
  ('PMT_MODE', '12', 'Annual', ''), ('PMT_MODE', '06', 'Semi-annual', ''),
  ('PMT_MODE', '03', 'Quarterly', ''), ('PMT_MODE', '01', 'Monthly', ''),
  ('SMS_STATUS_VENDOR', '0', 'Delivered', ''), ('SMS_STATUS_VENDOR', '1', 'Failed', ''),
  ('SMS_STATUS_VENDOR', '2', 'Pending', ''),
  ('BTCH_TYP', 'B0', 'Cash', 'CS'), ('BTCH_TYP', 'B1', 'Transfer', 'TF'), ('BTCH_TYP', 'B2', 'Auto', 'AUTO'),
  ('med_hosp', 'H0', 'Hospital 0', ''), ('med_hosp', 'H1', 'Hospital 1', ''), ('med_hosp', 'H2', 'Hospital 2', '')
) as t(fld_nm, fld_valu, fld_valu_desc, fld_lkup_valu)"""

ENTITIES["e_plan"] = f"""
select distinct
  case when p_partkey % 2 = 0 then {plan("p_partkey")}
    else 'R' || lpad(cast(p_partkey % 50 as string), 2, '0') end as plan_code,
  {version("p_partkey")} as vers_num,
  'Plan ' || cast(p_partkey % 3 as string) || ' of ' || cast(p_partkey % 2 as string) as plan_lng_desc,
  date '{REPORT_DATE}' as image_date
from {{part}}"""

ENTITIES["e_ledger"] = f"""
select 'AC' || lpad(cast(l_suppkey as string), 4, '0') as acct_num, l_orderkey as pol_num,
  case when l_returnflag = 'R' then 'D' else 'C' end as cr_or_dr,
  {money("l_extendedprice")} as acct_gen_amt,
  case l_partkey % 3 when 0 then '90' when 1 then '78' else 'CNY' end as crcy_code,
  'L' || cast(l_linenumber % 3 as string) as lob, 'W' || cast(l_suppkey % 4 as string) as wrk_area,
  'M' || cast(l_suppkey % 7 as string) as acct_mne_cd,
  cast(l_shipdate as date) as trxn_dt,
  case l_partkey % 5 when 0 then 'N' when 1 then 'X' when 2 then 'A' when 3 then 'N' else 'Z' end as extract_typ
from {{lineitem}}"""

# One rate per plan and quarter of 1995 to 2001, valid from one of the quarter's first days.
ENTITIES["e_rate_quarter"] = f"""
select plan_code, 'G' || cast(p_partkey % 4 as string) as nbv_factor_group,
  cast(cast(1995 + cast(floor(k / 4) as bigint) as string) || '-' || lpad(cast(k % 4 * 3 + 1 as string), 2, '0') || '-01' as date)
    + cast(p_partkey % 9 as int) as effective_date,
  cast(1995 + cast(floor(k / 4) as bigint) as string) || ' Q' || cast(k % 4 + 1 as string) as effective_qtr,
  'Need ' || cast(p_partkey % 5 as string) as customer_needs, {MARGIN_COLUMNS}
from (select {plan("p_partkey")} as plan_code, p_partkey % 28 as k, min(p_partkey) as p_partkey from {{part}}
  group by {plan("p_partkey")}, p_partkey % 28) one_per_quarter"""

ENTITIES["e_plan_rate"] = f"""
select {plan("p_partkey")} as plan_code, 'G' || cast(p_partkey % 4 as string) as nbv_factor_group,
  {MARGIN_COLUMNS}
from (select min(p_partkey) as p_partkey from {{part}} group by cast(floor(p_partkey / 22) as bigint) % 16) one_per_plan"""

ENTITIES["e_customer_month"] = f"""
select c_custkey as po_num,
  case when c_custkey % 11 = 0 then cast(null as string) when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
  c_mktsegment as channel, case when c_nationkey = 7 then cast(null as string)
    else 'City ' || cast(c_nationkey as string) end as city,
  case when c_custkey % 10 = 0 then 'New Customer' else 'Existing Customer' end as customer_type,
  cast((c_custkey * 7) % 80 as int) as age_curr,
  'I' || cast(c_custkey % 6 as string) as age_iss_group, 'A' || cast(c_custkey % 7 as string) as age_curr_group,
  case when c_custkey % 23 <> 0 then cast((c_custkey * 3) % 15 as int) end as tenure,
  case when c_custkey % 19 <> 0 then {money("abs(c_acctbal) * 10")} end as mthly_incm,
  {money("abs(c_acctbal) * 40")} as tot_ape,
  cast(c_custkey % 6 as int) as prod_cnt,
  case when c_custkey % 29 <> 0 then date '1990-01-31' + cast((c_custkey * 17) % 3800 as int) end as pol_iss_dt,
  case when c_custkey % 3 = 0 then 'Y' else 'N' end as cws_reg,
  case when c_custkey % 4 = 0 then 'Y' else 'N' end as digital_reg_ind,
  case when c_custkey % 5 <> 0 then 'Y' else 'N' end as pmt_ind,
  case when c_custkey % 7 = 0 then 'Y' else 'N' end as pmt_onl_ind,
  case when c_custkey % 6 = 0 then 'Y' else 'N' end as clm_ind,
  case when c_custkey % 12 = 0 then 'Y' else 'N' end as clm_cws_ind,
  case when c_custkey % 18 = 0 then 'Y' end as clm_ezc_ind,
  case when c_custkey % 4 = 1 then cast(null as string) when c_custkey % 2 = 0 then 'Y' else 'N' end as email_contact,
  case when c_custkey % 5 = 0 then 'N' else 'Y' end as mobile_contact
from {{customer}}"""

ENTITIES["e_customer_kpi"] = f"""
select c.*, case po_num % 5 when 0 then 'Gold' when 1 then 'Platinum' when 2 then 'Platinum Elite' else 'Not VIP' end as vip_seg, case when po_num % 8 = 0 then 'Y' else 'N' end as cust_new_ytd,
  date '{REPORT_DATE}' as reporting_date
from {{e_customer_month}} c"""

ENTITIES["e_product_need"] = """
select c_custkey as po_num, c_custkey % 2 as need_acc, c_custkey % 3 as need_ci, c_custkey % 4 as need_dis,
  c_custkey % 2 as need_glh, c_custkey % 5 as need_inv, c_custkey % 6 as need_lp, c_custkey % 7 as need_lts,
  c_custkey % 8 as need_med
from {customer}"""

ENTITIES["e_exchange"] = """
select cast(20 + p_size as decimal(10,2)) as xchng_rate,
  case when p_partkey % 3 = 0 then 'S' else 'U' end as xchng_rate_typ,
  case when p_partkey % 5 = 0 then '82' else '78' end as fr_crcy_code, '78' as to_crcy_code,
  date '1999-01-01' + cast(p_partkey % 997 as int) as to_eff_dt
from {part}"""

ENTITIES["e_collector"] = """
select s_suppkey as col_code, case when s_suppkey % 2 = 0 then 'PSA01' else 'COL01' end as col_grp
from {supplier}"""

ENTITIES["e_user"] = f"""
select {away("event_type = 'signup'", "event_id")} as _id, case event_id % 4
  when 0 then cast(cast(ts as date) as string) || 'T08:00:00'
  when 1 then cast(1704067200000 + event_id * 60000 as string)
  when 2 then 'unknown' else cast(null as string) end as created
from {{events}}"""

ENTITIES["e_member"] = f"""
select {away("event_type = 'signup' and value >= 2", "event_id")} as userid, event_id * 2 as keyid,
  case when event_id % 3 = 0 then 'active' else 'idle' end as status
from {{events}}"""

ENTITIES["e_key"] = f"""
select {away("event_type = 'signup' and value < 60", "event_id * 2")} as _id, 'M' || cast(user_id as string) as value, cast(event_id % 2 as int) as activated,
  case when event_id % 7 = 0 then 'n/a' else
    cast(date '2000-04-01' + cast(event_id % 90 as int) as string) || ' 10:00:00' end as activationdate
from {{events}}"""

ENTITIES["e_claim"] = """
select 'C' || cast(event_id % 3000 as string) as claim_id, user_id as policy_number,
  case event_id % 4 when 0 then 'P' when 1 then 'A' when 2 then 'A' else 'I' end as claim_status,
  case event_id % 3 when 0 then 'CWS' when 1 then 'EZC' else 'BR' end as source_code,
  case when event_id % 11 = 0 then 'Y' else 'N' end as direct_billing_ind,
  case when event_id % 5 = 0 then 'K' || cast(event_id as string) end as case_number,
  case event_id % 3 when 0 then 'TCB01' when 1 then 'SAG02' else 'TCB02' end as location_code,
  case event_id % 4 when 0 then 'TF' when 1 then 'PO' else 'CK' end as payout_type,
  cast(ts as date) as claim_received_date,
  case when event_id % 3 <> 0 then cast(ts as date) + cast(event_id % 12 as int) end as completed_doc_date,
  cast(ts as date) + cast(event_id % 9 as int) as claim_approved_date,
  cast(ts as date) as reporting_date
from {events}"""

ENTITIES["e_claim_case"] = f"""
select distinct case when event_type <> 'view' then 'C' else 'V' end || cast(event_id % 3000 as string) as name, 'S' || cast(event_id % 500 as string) as case__c
from {{events}}"""

ENTITIES["e_case"] = """
select 'S' || cast(k as string) as id, case k % 3 when 0 then 'Easy Claims' when 1 then 'Branch Submission' end as origin
from (select distinct event_id % 450 as k from {events}) cases"""

ENTITIES["e_new_business"] = f"""
select pol_num, case when pol_num % 2 = 0 then 'SUBMIT' else 'ISSUE' end as type, sbmt_dt as submit_date,
  pol_iss_dt as issue_date, pol_stat_cd as status_code, cast(pol_num % 15 as bigint) as tat_days,
  plan_code_base as plan_code, nb_user_id as nb_user
from {{e_policy}}"""

ENTITIES["e_weekly_claim"] = """
select l_orderkey * 10 + l_linenumber as claim_id,
  case l_partkey % 3 when 0 then 'P' else 'A' end as claim_status,
  cast(l_shipdate as date) as claim_received_date,
  cast(l_shipdate as date) + cast(l_partkey % 14 as int) as claim_approved_date,
  case when l_partkey % 4 <> 0 then cast(l_shipdate as date) + cast(l_partkey % 9 as int) - 2 end as completed_doc_date,
  case when l_suppkey % 9 = 0 then 'Y' else 'N' end as direct_billing_ind,
  case l_suppkey % 3 when 0 then 'CWS' when 1 then 'EZC' else 'BR' end as source_code,
  case l_linenumber % 3 when 0 then 'TF' when 1 then 'PO' else 'CK' end as payout_type
from {lineitem}"""

ENTITIES["e_collection"] = f"""
select pol_num as policy_number, pol_iss_dt as transaction_date,
  case pol_num % 4 when 0 then 'CASH01' when 1 then 'CARD' when 2 then 'BANK' end as payment_method,
  case when pol_num % 5 = 0 then 'R' else 'I' end as premium_type, plan_code_base as plan_code
from {{e_policy}}"""

ENTITIES["e_lead_user"] = """
select id, 'al' || cast(id as string) as alias, 'User ' || cast(id as string) as name
from (select distinct event_id % 20 as id from {events}) people"""

ENTITIES["e_lead"] = """
select 'LEAD' || lpad(cast(event_id as string), 14, '0') as id,
  date '1999-06-01' + cast(event_id % 400 as int) as createddate,
  case when event_id % 4 = 0 then upper(' customer#' || lpad(cast(user_id * 10 + event_id % 10 as string), 9, '0'))
    else 'Name ' || cast(user_id as string) end as lastname,
  case when event_id % 9 = 0 then cast(null as string)
    else '84 9-' || lpad(cast(user_id * 10 + event_id % 10 as string), 8, '0') end as phone,
  case when event_id % 5 = 0 then ' USER' || cast(user_id * 10 + event_id % 10 as string) || '@Mail.Example ' end as email,
  'ST' || cast(user_id % 5 as string) as state, 'web' as leadsource, props as description,
  case when event_id % 3 = 0 then 'false' else 'true' end as iscustomer__c,
  case event_id % 5 when 0 then 'New' when 1 then ' Duplicate lead' when 2 then 'Open'
    when 3 then cast(null as string) else 'Closed' end as status,
  case event_id % 6 when 0 then 'https://site.example/Promo/x' when 1 then 'https://site.example/a'
    when 2 then cast(null as string) else 'https://site.example/uu-dai/1' end as website,
  cast(user_id as string) as webtrackingid__c,
  case when event_id % 2 = 0 then 'src' end as utmcampaignsource__c,
  case when event_id % 7 = 0 then 'med' end as utmcampaignmedium__c,
  cast(null as string) as utmcampaignname__c, cast(null as string) as utmcampaigncontent__c,
  event_id % 23 as ownerid, event_id % 19 as createdbyid,
  cast(user_id % 10 as string) as agent_account_agent_code__c
from {events}"""

ENTITIES["e_lead_history"] = f"""
select case when leadsource = 'web' and phone is not null then id else 'old' || id end as id, substr(id, 1, 15) as leadid, createddate, case when ownerid % 3 <> 0 then ownerid end as pol_num,
  date '2000-01-31' + cast(ownerid % 5 as int) as image_date
from {{e_lead}}"""

ENTITIES["e_submission"] = f"""
select 'api' as source, {away("o_orderpriority <> '1-URGENT'", "o_orderkey")} as pol_num, {money("floor(o_totalprice / 10)")} as batch_trxn_amt,
  cast(o_orderdate as date) as batch_trxn_dt,
  case when o_orderkey % 5 <> 0 then 'ORD' || lpad(cast(o_orderkey as string), 8, '0') end as shopee_order_id,
  case when o_orderkey % 2 = 0 then 'done' else 'open' end as case_status, 1 + o_orderkey % 2 as case_count,
  cast(o_orderdate as date) + 1 as api_import_time
from {{orders}}
union all
select 'api', {away("o_orderstatus = 'P'", "o_orderkey")}, {money("floor(o_totalprice / 10)")}, cast(o_orderdate as date),
  'ORE' || lpad(cast(o_orderkey as string), 8, '0'),
  case when o_orderkey % 2 = 0 then 'done' else 'open' end, 3, cast(o_orderdate as date) + 2
from {{orders}}"""

ENTITIES["e_scorecard"] = """
select s.s_suppkey as agt_code, 'Tier ' || cast(s.s_suppkey % 3 as string) as agent_tier,
  last_day(date '2000-01-01' + cast(m.k * 31 - 15 as int)) as monthend_dt
from {supplier} s join (values (0, 1), (0, 2), (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2), (3, 3),
  (3, 4), (3, 5)) as m(kind, k) on m.kind = s.s_suppkey % 4"""

ENTITIES["e_batch_header"] = """
select cast(l_shipdate as date) as trxn_dt, l_suppkey as btch_num, 'C' as btch_role,
  'B' || cast(l_suppkey % 4 as string) as btch_typ, 'U' || cast(l_suppkey as string) as user_id,
  'BR' || cast(l_suppkey % 5 as string) as br_code,
  case when l_suppkey % 3 = 0 then 'BK' || cast(l_suppkey % 6 as string) end as bank_code
from {lineitem}
group by cast(l_shipdate as date), l_suppkey"""

ENTITIES["e_batch_detail"] = f"""
select cast(l_shipdate as date) as trxn_dt, l_suppkey as btch_num, case when l_linenumber = 7 then 'D' else 'C' end as btch_role,
  'RN' || cast(l_partkey as string) || '-' || cast(l_linenumber as string) as rep_num, l_orderkey as pol_num,
  case l_partkey % 6 when 0 then 'SHOPEEVC' when 1 then 'ECOMSACB' when 2 then 'SCBHCMC' when 3 then 'BK1'
    when 4 then 'BK4' end as bank_cd,
  {money("l_extendedprice")} as trxn_amt,
  case when l_partkey % 8 = 0 then 'REFUND' else 'COLECT' end as trxn_cd,
  'P' || cast(l_partkey % 3 as string) as prod_cat, 'T' || cast(l_partkey % 2 as string) as rep_typ,
  'S' || cast(l_linenumber % 2 as string) as prem_stat, cast(l_partkey % 4 as string) as reasn_code,
  case when l_partkey % 5 = 0 then 'X' else 'A' end as btch_dtl_stat_cd
from {{lineitem}}"""

ENTITIES["e_outstanding"] = f"""
select distinct cast(l_shipdate as date) as input_dt, {away("l_quantity > 5", "l_orderkey")} as pol_num,
  'RN' || cast(l_partkey as string) || '-' || cast(l_linenumber as string) as receipt_num,
  'TX' || cast(l_orderkey as string) as trxn_num, 'OB' || cast(l_suppkey % 3 as string) as bank_cd,
  'REF' || cast(l_partkey as string) as bank_ref,
  case l_partkey % 4 when 0 then '6' when 1 then '8' else '1' end as service_type,
  'B' || cast(l_suppkey % 4 as string) as pmt_type
from {{lineitem}}"""

ENTITIES["e_online"] = """
select case when o_orderkey % 3 = 0 then o_orderkey + 100000000 else o_orderkey end as pol_num,
  'V' || cast(o_orderkey as string) as receipt_num_vendor, 'TX' || cast(o_orderkey as string) as trxn_num,
  case when o_orderkey % 10 = 0 then 'C' else 'A' end as status
from {orders}"""

ENTITIES["e_application"] = f"""
select {away("o_orderpriority <> '2-HIGH'", "o_orderkey + 100000000")} as proposal_num, o_orderkey as pol_num from {{orders}}"""

ENTITIES["e_cheque_bank"] = """
select * from (values ('BK0', 'CHQ0'), ('BK1', 'CHQ1'), ('BK3', 'CHQ3'), ('BK4', cast(null as string)))
  as t(bank_cd, acct_mne_cd)"""
ENTITIES["e_auto_bank"] = """
select * from (values ('BK0', 'AUT0'), ('BK1', 'AUT1'), ('BK4', 'AUT4'), ('SCBHCMC', 'AUT9'))
  as t(bank_cd, acct_mne_cd)"""
ENTITIES["e_account"] = """
select * from (values ('1110', 'PCCASH'), ('1120', 'CHQ0'), ('1121', 'CHQ1'), ('1130', 'AUT0'), ('1131', 'AUT1'),
  ('1134', 'AUT4'), ('1139', 'AUT9')) as t(acct_num, acct_mne_cd)"""

ENTITIES["e_pickup"] = f"""
select cast(l_shipdate as date) as trxn_dt, 'BR' || cast(l_suppkey % 5 as string) as br_code, l_orderkey as pol_num,
  l_orderkey * 10 + l_linenumber as dnr_num, case when l_partkey % 11 = 0 then 'H' else 'D' end as rec_typ,
  case l_partkey % 4 when 0 then 'CS' when 1 then 'AVCS' when 2 then 'CS' else 'TF' end as btch_typ,
  case l_partkey % 3 when 0 then '01' when 1 then '02' else '03' end as reasn_code,
  case when l_partkey % 7 = 0 then 'O' else 'C' end as btch_stat_code, {money("l_extendedprice")} as trxn_amt
from {{lineitem}}"""
ENTITIES["e_return"] = f"""
select cast(l_shipdate as date) + 3 as trxn_dt, 'BR9' as br_code, {away("l_returnflag = 'R'", "l_orderkey")} as pol_num,
  {away("l_returnflag = 'R'", "l_orderkey * 10 + l_linenumber")} as dnr_num, 'D' as rec_typ, 'CS' as btch_typ, '01' as reasn_code,
  'C' as btch_stat_code, {money("floor(l_extendedprice / 2)")} as trxn_amt
from {{lineitem}}"""

ENTITIES["e_exam"] = """
select distinct 'C' || cast(p_partkey % 12 as string) as class_cd,
  date '1995-01-01' + cast((p_partkey % 12) * 100 + (p_partkey % 24) * 3 as int) as exam_dt,
  'EX' || cast(p_partkey % 24 as string) as exam_master_cd
from {part}"""
ENTITIES["e_class"] = "select distinct 'C' || cast(p_partkey % 12 as string) as cls_num from {part}"
ENTITIES["e_attend"] = f"""
select s_suppkey * 15 as can_num, 'C' || cast(s_suppkey % 12 as string) as class_cd from {{supplier}}
union all
select {away("s_acctbal > 4000", "s_suppkey * 15")}, 'C' || cast((s_suppkey + 5) % 12 as string) from {{supplier}}"""
ENTITIES["e_result"] = f"""
select {away("s_acctbal < 8000", "s_suppkey * 15")} as can_num, 'C' || cast(s_suppkey % 12 as string) as class_cd, 'EX' as training_cat_cd,
  date '1996-01-01' + cast(s_suppkey % 300 as int) as eff_dt from {{supplier}}
union all
select {away("s_acctbal > 4000", "s_suppkey * 15")}, 'C' || cast((s_suppkey + 5) % 12 as string), case when s_suppkey % 4 = 0 then 'EX' else 'TR' end,
  date '1996-06-01' + cast(s_suppkey % 300 as int) from {{supplier}}"""
ENTITIES["e_course"] = """
select user_id % 100 as agt_code, 'CRS' || cast(event_id % 5 as string) as class_code,
  case when event_id % 4 = 0 then 'P' else 'C' end as stat_cd, cast(ts as date) as end_dt from {events}"""

ENTITIES["e_trailer"] = f"""
select distinct cast(l_suppkey as bigint) as agt_code, l_orderkey as pol_num,
  case when l_linenumber = 1 then {plan("l_orderkey")}
    else 'R' || lpad(cast(l_partkey % 50 as string), 2, '0') end as plan_code,
  {version("l_orderkey")} as vers_num, cast(l_shipdate as date) as cvg_eff_dt, 50 + l_suppkey % 2 * 50 as pct_splt
from {{lineitem}}"""
ENTITIES["e_history"] = """
select o_orderkey as pol_num, cast(o_orderdate as date) + 5 as trxn_dt,
  case when o_orderkey % 4 = 0 then 'CHANGE' else 'NEWBUS' end as trxn_cd,
  case when o_orderkey % 5 = 0 then '112' else '111' end as reasn_code from {orders}"""
ENTITIES["e_work"] = f"""
select l_orderkey as pol_num, case when l_linenumber = 1 then {plan("l_orderkey")}
    else 'R' || lpad(cast(l_partkey % 50 as string), 2, '0') end as plan_code,
  case l_partkey % 4 when 0 then 'FYP-TOPUP' when 1 then 'SP' else 'FYP' end as typ,
  cast(l_suppkey as bigint) as agt_code, {money("l_extendedprice")} as amt
from {{lineitem}}"""
ENTITIES["e_commission"] = f"""
select l_orderkey as pol_num, case when l_linenumber = 1 then {plan("l_orderkey")}
    else 'R' || lpad(cast(l_partkey % 50 as string), 2, '0') end as plan_cd,
  cast(l_suppkey as bigint) as agt_cd, case when l_partkey % 6 = 0 then 'BON' else 'COM' end as crr_typ,
  case when l_partkey % 7 = 0 then '116' else '115' end as reasn_cd,
  case when l_partkey % 9 <> 0 then {money("floor(l_extendedprice / (1 + l_partkey % 7))")} end as crr_valu
from {{lineitem}}"""
ENTITIES["e_commission_bk"] = f"""
select {away("crr_valu > 20000", "pol_num")} as pol_num, plan_cd, agt_cd, crr_typ, reasn_cd, crr_valu from {{e_commission}}"""
ENTITIES["e_change_ctl"] = """
select o_orderkey as pol_num, o_orderkey * 2 as pos_num, cast(o_orderdate as date) + 40 as comp_date,
  cast(o_orderdate as date) + 30 as ho_recv_dt, cast(o_orderdate as date) - 3 as sbmt_date,
  o_orderkey % 50 as btch_num, case when o_orderkey % 3 <> 0 then o_orderkey % 9 end as btch_seq,
  'U' || cast(o_orderkey % 12 as string) as asign_user_id,
  case when o_orderkey % 6 = 5 then '01' else '00' end as chg_stat,
  case when o_orderkey % 4 = 0 then 'NB' else 'PS' end as dept_typ from {orders}"""
ENTITIES["e_check"] = """
select o_orderkey as pol_num, o_orderkey * 2 as pos_num,
  case o_orderkey % 5 when 0 then '10' when 1 then '12' when 2 then '37' when 3 then '37' else '99' end as chg_typ,
  case when o_orderkey % 8 = 7 then '2' else '1' end as chklst_id, 'R' || cast(o_orderkey % 3 as string) as chklst_result
from {orders}"""
ENTITIES["e_pos_batch"] = """
select k as btch_num, 'BC' || cast(k % 4 as string) as btch_branch, 'S' || cast(k % 7 as string) as btch_submit_by
from (select distinct o_orderkey % 50 as k from {orders}) batches"""
ENTITIES["e_branch"] = "select case when n_regionkey <> 4 then 'BR' else 'XB' end || cast(n_nationkey as string) as br_code from {nation}"
ENTITIES["e_termination"] = f"""
select {away("o_orderstatus <> 'O'", "o_orderkey")} as pol_num, cast(o_orderdate as date) + cast(o_orderkey % 200 as int) as trmn_actv_dt
from {{orders}}"""

ENTITIES["e_med"] = f"""
select o_orderkey as pol_num, o_orderkey % 3 as med_seq, cast(o_orderdate as date) as med_date,
  'H' || cast(o_orderkey % 4 as string) as med_hosp,
  case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) + 2 end as med_comp_dt,
  {money("floor(o_totalprice / 100)")} as in_exps from {{orders}}"""
ENTITIES["e_med_client"] = f"""
select {away("o_orderstatus <> 'P'", "o_orderkey")} as pol_num, o_orderkey % 3 as med_seq, case when o_orderkey % 7 <> 0 then 'Client ' || cast(o_custkey as string) end as ins_nm
from {{orders}}"""
ENTITIES["e_med_item"] = """
select l_orderkey as pol_num, l_orderkey % 3 as med_seq, cast(o.o_orderdate as date) as med_date,
  'H' || cast(l_orderkey % 4 as string) as med_hosp, 'X' || cast(l_linenumber as string) as med_supp_exam
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey"""
ENTITIES["e_med_exam"] = """
select o_orderkey as pol_num, o_orderkey % 3 as med_seq, cast(o_orderdate as date) as med_date,
  'H' || cast(o_orderkey % 4 as string) as med_hosp, case when o_orderkey % 2 = 0 then '04' else '05' end as exam_cd
from {orders}"""

ENTITIES["e_sms"] = """
select date '2021-01-01' + cast((conv_id * 11) % 1500 as int) as trxn_dt,
  case conv_id % 3 when 0 then 'C' when 1 then 'A' end as cli_typ,
  case when turn % 3 = 2 then 'OTH-' else 'BCS-CS-' end || role as tmp_id,
  cast(conv_id % 4 as string) as status_vendor, 'RS' || cast(turn % 2 as string) as reason_vendor, text as msg_txt
from {conversations}"""
ENTITIES["e_template"] = """
select distinct 'BCS-CS-' || role as tmp_id, 'Template ' || role as tmp_nm from {conversations}"""
ENTITIES["e_contact_req"] = """
select conv_id as pol_num, conv_id * 100 + turn as csd_num, date '2019-10-01' + cast(conv_id % 300 as int) as cntct_dt,
  case turn % 4 when 0 then '03' when 1 then '40' when 2 then '42' else '50' end as track_typ,
  date '2019-10-01' + cast(conv_id % 300 as int) as trxn_dt, case when role = 'user' then text end as remark
from {conversations}"""
ENTITIES["e_service"] = f"""
select {away("role <> 'system'", "conv_id * 100 + turn")} as csd_num, date '2019-10-01' + cast(conv_id % 300 as int) as cntct_dt,
  'ST' || cast(turn % 3 as string) as cisc_status, date '2019-10-05' + cast(conv_id % 300 as int) as comp_dt,
  'RC' || cast(conv_id % 5 as string) as result_cd, role as cisc_typ from {{conversations}}"""
ENTITIES["e_vendor_call"] = f"""
select {away("role = 'user'", "conv_id * 100 + turn")} as csd_num, conv_id as pol_num, date '2019-10-01' + cast(conv_id % 300 as int) as cntct_dt,
  date '2019-10-03' + cast(conv_id % 300 as int) as import_dt, 'OBC' || cast(turn % 2 as string) as result_obc
from {{conversations}}"""

# Campaign ids look like CPM-UCM-2024-0117: kind at 5, year at 9, day at 11.
ENTITIES["e_hit_pair"] = """
select event_id, user_id, event_type, value, cast(ts as date) as hit_day,
  'CPM-' || case when user_id % 3 = 0 then 'UCM' else 'ACM' end
    || '-' || cast(2021 + user_id % 4 as string) || lpad(cast(user_id % 100 as string), 2, '0') as cpmid
from {events}"""

ENTITIES["e_lapse_score"] = """
select l_orderkey as pol_num, '202005' as month_snapshot,
  cast((max(l_partkey) * 7919 + l_orderkey * 104729) % 100000 as double) / 100000 as lapse_score
from {lineitem} group by l_orderkey"""
ENTITIES["e_lead_score"] = f"""
select c_custkey as po_num, date '{REPORT_DATE}' as image_date,
  cast((c_custkey * 7919) % 100003 as double) / 100003 as p_1 from {{customer}}"""
ENTITIES["e_product_score"] = """
select c_custkey as po_num, case when c_custkey % 5 = 0 then 'DRAFT' else 'APPROVED' end as deployment_approval_status,
  case when c_custkey % 13 <> 0 then cast(c_custkey % 10 as double) / 20 end as health_base,
  cast(c_custkey % 7 as double) / 20 as inv_base, cast(c_custkey % 4 as double) / 20 as health_rider,
  cast(c_custkey % 9 as double) / 20 as riders from {customer}"""
ENTITIES["e_tier"] = f"""
select {away("s_acctbal > 1000", "s_suppkey")} as agt_code, {away("s_acctbal > 1000", "s_suppkey")} as agt_cd,
  case s_suppkey % 4 when 1 then 'MDRT' when 2 then 'COT' when 3 then 'TOT' else 'Platinum' end as tier
from {{supplier}}"""
ENTITIES["e_programme"] = f"""
select {away("s_acctbal > -500", "s_suppkey")} as agt_cd, s_suppkey % 40 + 50 as m19_per from {{supplier}}"""
ENTITIES["e_allowance"] = f"""
select {away("s_acctbal < 9000", "s_suppkey")} as agt_cd, case when s_suppkey % 3 <> 0 then s_suppkey % 5 * 1000 end as monthly_allowance,
  case when s_suppkey % 11 <> 0 then '1999' || lpad(cast(s_suppkey % 12 + 1 as string), 2, '0') end as qualify_date
from {{supplier}}"""
ENTITIES["e_pack_claim"] = f"""
select l_orderkey * 10 + l_linenumber as clm_id, {away("l_returnflag = 'A'", "l_orderkey")} as pol_num, cast(l_shipdate as date) as clm_recv_dt,
  case l_partkey % 4 when 0 then 'A' when 1 then 'I' when 2 then 'A' else 'R' end as clm_stat_code,
  {money("floor(l_extendedprice / 100)")} as clm_prvd_amt, {money("floor(l_extendedprice / 200)")} as clm_aprov_amt
from {{lineitem}}"""
