"""Policy service, messages, calls, exams and campaign pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import pick, require
from ..functions.amounts import value_map
from ..functions.conditions import is_or_null, yn
from ..functions.dates import DateLike, day, day_shift, since
from ..functions.text import sha256_text
from ..operators.aggregates import value_set
from ..operators.joins import decode
from . import values as v


def dropped_policies(
    checks: DataFrame,
    changes: DataFrame,
    policies: DataFrame,
    coverages: DataFrame,
    batches: DataFrame,
    agents: DataFrame,
    branches: DataFrame,
    terminations: DataFrame,
    codes: DataFrame,
    as_of: DateLike,
    *,
    months: int = 4,
) -> DataFrame:
    """Requests that ended a policy in the last months, with decoded texts.

    Expiry requests (type 37) count by the later of completion and termination date, others
    by completion. Inputs: checks (pol_num, pos_num, chg_typ, chklst_id, chklst_result),
    changes (pol_num, pos_num, comp_date, ho_recv_dt, btch_num, btch_seq, asign_user_id,
    chg_stat), policies (pol_num, pol_stat_cd, agt_code), coverages (pol_num), batches
    (btch_num, btch_branch, btch_submit_by), agents (agt_code, br_code), branches (br_code),
    terminations (pol_num, trmn_actv_dt), codes.
    """
    require(changes, "changes", "pol_num", "pos_num", "comp_date", "btch_num", "chg_stat")
    asked = checks.where(F.col("chg_typ").isin("10", "12", "37") & (F.col("chklst_id") == "1"))
    ended = policies.where(F.col("pol_stat_cd").isin("A", "E", "H"))
    ended_by = F.greatest(F.col("comp_date"), F.coalesce("ended_dt", "comp_date"))
    relevant = F.when(F.col("chg_typ") == "37", ended_by).otherwise(F.col("comp_date"))
    full = (
        changes.where(F.col("chg_stat") == "00")
        .select(
            "pol_num", "pos_num", "comp_date", "ho_recv_dt", "btch_num", "btch_seq", "asign_user_id"
        )
        .join(asked.select("pol_num", "pos_num", "chg_typ", "chklst_result"), ["pol_num", "pos_num"])
        .join(ended.select("pol_num", "pol_stat_cd", "agt_code"), "pol_num")
        .join(coverages.select("pol_num"), "pol_num", "left_semi")
        .join(batches.select("btch_num", "btch_branch", "btch_submit_by"), "btch_num")
        .join(agents.select("agt_code", "br_code"), "agt_code")
        .join(branches.select("br_code"), "br_code")
        .join(
            terminations.select("pol_num", F.col("trmn_actv_dt").alias("ended_dt")), "pol_num", "left"
        )
        .where(since(relevant, as_of, months=months))
    )
    full = decode(full, codes, "POS_CHG_TYP", "chg_typ", "chg_typ_desc")
    full = decode(full, codes, "STAT_CODE", "pol_stat_cd", "pol_stat")
    full = decode(full, codes, "POS_SRV_CTR", "btch_branch", "counter_nm")
    return full.select(
        "comp_date",
        "pol_stat_cd",
        F.when(F.col("pol_stat_cd") == "A", F.col("comp_date"))
        .otherwise(F.col("ended_dt"))
        .alias("trmn_actv_dt"),
        "chg_typ",
        "btch_branch",
        "pos_num",
        "counter_nm",
        "pol_num",
        "pol_stat",
        "chg_typ_desc",
        "ho_recv_dt",
        F.col("comp_date").alias("comp_date_1"),
        F.when(F.col("btch_seq").isNull(), F.col("asign_user_id"))
        .otherwise(F.col("btch_submit_by"))
        .alias("btch_submit_by"),
        "asign_user_id",
        "chklst_result",
    ).distinct()


def medical_exams(
    details: DataFrame,
    clients: DataFrame,
    supplements: DataFrame,
    exams: DataFrame,
    codes: DataFrame,
    as_of: DateLike,
    *,
    days: int = 365,
) -> DataFrame:
    """Medical exams of the last ``days`` days with their items and a blood-test mark.

    Inputs: details (pol_num, med_seq, med_date, med_hosp, med_comp_dt, in_exps), clients
    (pol_num, med_seq, ins_nm), supplements (pol_num, med_seq, med_date, med_hosp,
    med_supp_exam), exams (pol_num, med_seq, med_date, med_hosp, exam_cd), codes. Fees are
    stored in thousands. The item list is ordered.
    """
    require(details, "details", "pol_num", "med_seq", "med_date", "med_hosp", "med_comp_dt", "in_exps")
    visit = ["pol_num", "med_seq", "med_date", "med_hosp"]
    run = day(as_of)
    recent = F.col("med_date").between(F.lit(day_shift(run, -days)), F.lit(run))
    names = clients.select("pol_num", "med_seq", F.col("ins_nm").alias("cli_nm")).distinct()
    items = (
        supplements.where(recent)
        .select(*visit, "med_supp_exam")
        .distinct()
    )
    blood = (
        exams.where(recent & (F.col("exam_cd") == "04"))
        .select(*visit)
        .distinct()
        .withColumn("bt", F.lit("Y"))
    )
    hospitals = codes.where(F.col("fld_nm") == "med_hosp").select(
        F.col("fld_valu").alias("med_hosp"), F.col("fld_valu_desc").alias("hospital")
    )
    return (
        details.where(F.col("med_comp_dt").isNotNull() & recent)
        .join(hospitals, "med_hosp")
        .join(names, ["pol_num", "med_seq"], "left")
        .join(items, visit, "left")
        .join(blood, visit, "left")
        .groupBy("hospital", "med_hosp", "pol_num", "cli_nm", "med_date", "in_exps", "bt")
        .agg(value_set("med_supp_exam").alias("medic_check_items"))
        .select(
            F.col("pol_num").alias("policy_no"),
            F.col("cli_nm").alias("client_name"),
            F.col("med_date").alias("medic_date"),
            "medic_check_items",
            F.col("bt").alias("blood_test"),
            (F.col("in_exps") * 1000).alias("fee"),
            "hospital",
            F.col("med_hosp").alias("med_hosp"),
        )
        .distinct()
    )


def not_taken(
    policies: DataFrame,
    links: DataFrame,
    clients: DataFrame,
    plans: DataFrame,
    agents: DataFrame,
    start: DateLike,
) -> DataFrame:
    """Policies ended on or after ``start`` with owner, insured and servicing agent.

    Inputs: policies (pol_num, sbmt_dt, pol_eff_dt, pol_iss_dt, pol_stat_cd, plan_code_base,
    vers_num_base, pol_trmn_dt, cnfrm_acpt_dt, mode_prem, pmt_mode, agt_code), links
    (pol_num, cli_num, link_typ, rec_status), clients (cli_num, cli_nm, birth_dt), plans
    (plan_code, vers_num), agents (agt_code, agt_nm, loc_code).
    """
    active = links.where(F.col("rec_status") == "A")

    def person(kind: str, role: str) -> DataFrame:
        named = clients.select(
            "cli_num",
            F.col("cli_nm").alias(f"{role}_name"),
            F.col("birth_dt").alias(f"{role}_dob"),
        )
        return (
            active.where(F.col("link_typ") == kind)
            .select("pol_num", "cli_num")
            .join(named, "cli_num")
            .drop("cli_num")
        )

    ended = pick(
        policies, "policies", "pol_num", "sbmt_dt", "pol_eff_dt", "pol_iss_dt", "pol_stat_cd",
        "plan_code_base", "vers_num_base", "pol_trmn_dt", "cnfrm_acpt_dt", "mode_prem", "pmt_mode", "agt_code",
    )
    return (
        ended.where(F.col("pol_trmn_dt").cast("date") >= F.lit(day(start)))
        .join(person("O", "owner"), "pol_num")
        .join(person("I", "insured"), "pol_num")
        .join(
            plans.select(
                F.col("plan_code").alias("plan_code_base"), F.col("vers_num").alias("vers_num_base")
            ),
            ["plan_code_base", "vers_num_base"],
        )
        .join(agents.select("agt_code", "agt_nm", "loc_code"), "agt_code")
        .select(
            F.col("pol_num").alias("policy_number"),
            F.col("sbmt_dt").alias("submit_date"),
            F.col("pol_eff_dt").alias("policy_effective_date"),
            F.col("pol_iss_dt").alias("policy_issued_date"),
            F.col("pol_stat_cd").alias("policy_status_code"),
            "plan_code_base",
            F.col("pol_trmn_dt").alias("policy_terminated_date"),
            F.col("cnfrm_acpt_dt").alias("confirm_accept_date"),
            F.col("mode_prem").alias("mode_premium"),
            F.col("pmt_mode").alias("payment_mode"),
            "insured_name",
            "insured_dob",
            "owner_name",
            "owner_dob",
            F.col("agt_code").alias("servicing_agent_code"),
            F.col("agt_nm").alias("servicing_agent_name"),
            F.col("loc_code").alias("location_code"),
        )
    )


def sms_report(
    sends: DataFrame,
    templates: DataFrame,
    codes: DataFrame,
    as_of: DateLike,
    *,
    pattern: str = "BCS-CS-%",
    days: int = 1095,
) -> DataFrame:
    """Messages sent to customers, with template name and decoded vendor status.

    Inputs: sends (trxn_dt, cli_typ, tmp_id, status_vendor, reason_vendor, msg_txt),
    templates (tmp_id, tmp_nm), codes.
    """
    require(sends, "sends", "trxn_dt", "cli_typ", "tmp_id", "status_vendor", "reason_vendor", "msg_txt")
    sent = sends.where(
        F.col("tmp_id").like(pattern) & is_or_null("cli_typ", "C") & since("trxn_dt", as_of, days=days)
    )
    named = decode(sent, codes, "SMS_STATUS_VENDOR", "status_vendor", "result_status_desc")
    return named.join(templates.select("tmp_id", "tmp_nm"), "tmp_id").select(
        F.col("trxn_dt").alias("send_date"),
        F.col("cli_typ").alias("type"),
        F.col("tmp_id").alias("template_id"),
        F.col("tmp_nm").alias("template_name"),
        F.col("status_vendor").alias("result_status"),
        "result_status_desc",
        F.col("reason_vendor").alias("reason_vendor_code"),
        F.col("msg_txt").alias("sms_content"),
    )


def welcome_calls(
    contacts: DataFrame,
    services: DataFrame,
    vendor: DataFrame,
    *,
    types: Sequence[str] = ("03", "40", "42"),
    start: DateLike = "2020-01-01",
) -> DataFrame:
    """Contact requests with service status and the vendor's call result.

    Inputs: contacts (pol_num, csd_num, cntct_dt, track_typ, trxn_dt, remark), services
    (cntct_dt, csd_num, cisc_status, comp_dt, result_cd, cisc_typ), vendor (cntct_dt,
    csd_num, pol_num, import_dt, result_obc).
    """
    asked = contacts.where(
        F.col("track_typ").isin(*types) & (F.col("trxn_dt") >= F.lit(day(start)))
    )
    request = ["cntct_dt", "csd_num"]
    return (
        asked.join(
            services.select(*request, "cisc_status", "comp_dt", "result_cd", "cisc_typ"), request, "left"
        )
        .join(
            vendor.select(*request, "pol_num", "import_dt", "result_obc"), [*request, "pol_num"], "left"
        )
        .select(
            F.col("pol_num").alias("policy_number"),
            F.col("csd_num").alias("contact_number"),
            F.col("track_typ").alias("contact_source"),
            F.col("trxn_dt").alias("file_date_or_upload_aws_date"),
            F.col("import_dt").alias("vendor_import_date"),
            F.col("result_obc").alias("vendor_wcc_result"),
            yn(F.col("remark").isNotNull()).alias("agent_feedback_date"),
            F.col("cisc_status").alias("contact_status"),
            F.col("comp_dt").alias("contact_close_date"),
            F.col("result_cd").alias("contact_result"),
            F.col("cisc_typ").alias("contact_type"),
        )
        .distinct()
    )


def campaign_tracking(hits: DataFrame, as_of: DateLike) -> DataFrame:
    """One row per page hit and campaign named in it, for campaigns of this and last year.

    hits has (cmpgn_id_list, agent_id, page, pageviews, com_id, compaign_id, tgt_id, cust_id,
    loc_cd, br_code, rh_name, manager_name_0, hit_date text). The batch id of some campaigns
    carries the month of their first hit, which is aggregated and joined back.
    """
    require(hits, "hits", "cmpgn_id_list", "agent_id", "page", "pageviews", "hit_date")
    year = F.substring("cpmid", 9, 4).try_cast("int")
    seen = hits.withColumn("cpmid", F.explode("cmpgn_id_list")).where(year >= day(as_of).year - 1)
    first = seen.groupBy("cpmid").agg(F.min("hit_date").alias("first_hit"))
    first_month = F.concat(F.substring("first_hit", 3, 2), F.substring("first_hit", 6, 2))
    by_first_hit = F.substring("cpmid", 5, 3) == "UCM"
    return seen.join(first, "cpmid").select(
        "cpmid",
        F.concat_ws(
            "-",
            "cpmid",
            F.when(by_first_hit, first_month).otherwise(F.substring("cpmid", 11, 4)),
        ).alias("cmpgn_btch_id"),
        F.col("agent_id").alias("agentid"),
        value_map(F.substring("page", 55, 32), v.PAGE_TEXT).alias("page"),
        F.col("pageviews").alias("pageview"),
        F.col("com_id").alias("comid"),
        F.col("compaign_id").alias("compaignid"),
        "tgt_id",
        "cust_id",
        F.col("loc_cd").alias("loc_code"),
        "br_code",
        "rh_name",
        "manager_name_0",
        "hit_date",
    )


def mask_columns(df: DataFrame, cols: int | str | Sequence[int | str] | None = None) -> DataFrame:
    """Replace columns by the SHA-256 of their text; nulls stay null.

    ``cols`` names columns by 1-based position or name; without it all are masked.
    """
    if cols is None:
        targets = list(df.columns)
    else:
        wanted = [cols] if isinstance(cols, (int, str)) else list(cols)
        targets = []
        for c in wanted:
            if isinstance(c, int):
                if not 1 <= c <= len(df.columns):
                    raise ValueError(f"column position {c} is outside 1..{len(df.columns)}")
                c = df.columns[c - 1]
            targets.append(c)
        require(df, "df", *targets)
    return df.withColumns({c: sha256_text(F.col(c)) for c in targets})
