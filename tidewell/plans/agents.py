"""Agent reports: hierarchy, contacts, training, active agents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checks import pick, require
from ..functions.amounts import value_map
from ..functions.dates import DateLike, month_end, month_number, month_index
from ..operators.joins import decode
from ..operators.windows import first_ties_by
from . import values as v


def agent_hierarchy(
    rpt: DataFrame, groups: DataFrame, mgr_map: DataFrame, agents: DataFrame, head_offset: int = 2
) -> DataFrame:
    """Manager and regional head of every location, one row per location.

    Inputs: rpt (agt_cd, sub_agt_cd, rpt_level), groups (loc_code, loc_mrg), mgr_map
    (dsr_cd, mgr_cd), agents (agt_code, agt_nm). The manager sits at the location's lowest
    level, the head ``head_offset`` below its highest; both limits are taken after lines to
    unnamed managers and open locations are dropped. Columns: loc_code, sm_cd, sm_nm, rh_cd,
    rh_nm.
    """
    require(rpt, "rpt", "agt_cd", "sub_agt_cd", "rpt_level")
    named = agents.where(F.col("agt_nm") != v.OPEN_LOCATION).select("agt_code", "agt_nm")
    lines = (
        rpt.where(F.col("agt_cd").isNotNull())
        .join(groups.select("loc_code", "loc_mrg"), F.col("sub_agt_cd") == F.col("loc_mrg"))
        .join(named, F.col("agt_cd") == F.col("agt_code"))
        .join(mgr_map.select("dsr_cd", "mgr_cd"), F.col("agt_cd") == F.col("dsr_cd"), "left")
    )
    # A location has a handful of levels, so the window below sees a few rows per location.
    levels = lines.groupBy("loc_code", "rpt_level").agg(
        F.min("mgr_cd").alias("cd"), F.min("agt_nm").alias("nm")
    )
    loc = Window.partitionBy("loc_code")
    placed = levels.withColumns(
        {"low": F.min("rpt_level").over(loc), "head": F.max("rpt_level").over(loc) - head_offset}
    )
    at_low, at_head = F.col("rpt_level") == F.col("low"), F.col("rpt_level") == F.col("head")
    return placed.groupBy("loc_code").agg(
        F.min(F.when(at_low, F.col("cd"))).alias("sm_cd"),
        F.min(F.when(at_low, F.col("nm"))).alias("sm_nm"),
        F.min(F.when(at_head, F.col("cd"))).alias("rh_cd"),
        F.min(F.when(at_head, F.col("nm"))).alias("rh_nm"),
    )


def course_completions(
    agents: DataFrame,
    hierarchy: DataFrame,
    attendance: DataFrame,
    class_code: str,
    *,
    channel: str = "01",
    status: str = "C",
) -> DataFrame:
    """Agents of a channel who completed one course, with their location's manager and head.

    ``hierarchy`` comes from :func:`agent_hierarchy`; this report uses ``head_offset=1``.
    Inputs: agents (agt_code, agt_nm, loc_code, chnl_cd), attendance (agt_code, class_code,
    stat_cd, end_dt).
    """
    done = attendance.where((F.col("stat_cd") == status) & (F.col("class_code") == class_code))
    staff = agents.where(F.col("chnl_cd") == channel).select("agt_code", "agt_nm", "loc_code")
    return (
        staff.join(done.select("agt_code", F.col("end_dt").alias("date_completion")), "agt_code")
        .join(hierarchy, "loc_code")
        .select(
            "agt_code",
            "agt_nm",
            "date_completion",
            "loc_code",
            F.col("sm_cd").alias("sm"),
            "sm_nm",
            F.col("rh_cd").alias("rh"),
            "rh_nm",
        )
    )


def agent_contacts(
    agents: DataFrame,
    candidates: DataFrame,
    units: DataFrame,
    ranks: DataFrame,
    locations: DataFrame,
    hierarchy: DataFrame,
    codes: DataFrame,
    *,
    providers: Sequence[str] | None = v.CONTACT_PROVIDERS,
    joined_by: DateLike | None = None,
) -> DataFrame:
    """Active agents with contact data of themselves, their direct and their location manager.

    Inputs: agents (agt_code, agt_nm, can_num, loc_code, unit_code, rank_cd, agt_sup,
    mobl_phon_num, epos_ind, dtk_ind, cmp_ind, mba_ind, cntrct_eff_dt, comp_prvd_num,
    agt_stat_code), candidates (can_num, sex_code, email_addr, agent_group), units
    (stru_grp_cd, mgr_cd), ranks (rank_cd), locations (loc_cd, loc_desc, chnl).
    ``providers`` limits the provider numbers, ``joined_by`` the contract start.
    """
    mail = candidates.select("can_num", "email_addr")
    people = agents.select("agt_code", "agt_nm", "mobl_phon_num", "can_num").join(mail, "can_num")
    manager = people.select(
        F.col("agt_code").alias("sm_cd"),
        F.col("mobl_phon_num").alias("sm_code2_phone"),
        F.col("email_addr").alias("sm_code2_email"),
    )
    direct = people.join(units, F.col("mgr_cd") == F.col("agt_code")).select(
        F.col("stru_grp_cd").alias("unit_code"),
        F.col("agt_code").alias("direct_mgr"),
        F.col("agt_nm").alias("direct_mgr_nm"),
        F.col("email_addr").alias("direct_mgr_email"),
        F.col("mobl_phon_num").alias("direct_mgr_phone"),
    )
    active = pick(
        agents, "agents", "agt_code", "agt_nm", "can_num", "loc_code", "unit_code", "rank_cd", "agt_sup",
        "mobl_phon_num", "epos_ind", "dtk_ind", "cmp_ind", "mba_ind", "cntrct_eff_dt", "comp_prvd_num",
        "agt_stat_code",
    ).where(F.col("agt_stat_code") == "1")
    if providers is not None:
        active = active.where(F.col("comp_prvd_num").isin(*providers))
    if joined_by is not None:
        active = active.where(F.col("cntrct_eff_dt") <= F.lit(joined_by).cast("date"))
    person = candidates.select(
        "can_num", F.col("sex_code").alias("agt_gender"), "email_addr", "agent_group"
    )
    places = locations.select(
        F.col("loc_cd").alias("loc_code"),
        F.col("loc_desc").alias("location_name"),
        value_map("chnl", v.LOCATION_CHANNEL_TEXT, "Unknown").alias("channel"),
    )
    full = (
        active.join(hierarchy, "loc_code")
        .join(manager, "sm_cd")
        .join(direct, "unit_code")
        .join(ranks.select("rank_cd"), "rank_cd")
        .join(person, "can_num")
        .join(places, "loc_code")
    )
    full = decode(full, codes, "AGENT_GROUP", "agent_group", "fta_flag", how="left")
    return full.select(
        F.col("rh_cd").alias("rh_code"),
        F.col("rh_nm").alias("rh_name"),
        F.col("sm_cd").alias("sm_code2"),
        F.col("sm_nm").alias("sm_incharge_loc"),
        "sm_code2_phone",
        "sm_code2_email",
        "direct_mgr",
        "direct_mgr_nm",
        "direct_mgr_email",
        "direct_mgr_phone",
        F.col("loc_code").alias("location_code"),
        "location_name",
        "agt_code",
        "agt_nm",
        "agt_gender",
        "rank_cd",
        "agt_sup",
        "mobl_phon_num",
        "email_addr",
        "epos_ind",
        "dtk_ind",
        "cmp_ind",
        "mba_ind",
        "fta_flag",
        "cntrct_eff_dt",
        "comp_prvd_num",
        "channel",
    )


def campaign_agents(contacts: DataFrame, as_of: DateLike) -> DataFrame:
    """Agency and direct-sales agents of the app campaign, with months of service.

    ``contacts`` comes from :func:`agent_contacts` with ``providers=None`` and ``joined_by``
    the month end before ``as_of``.
    """
    report = month_end(as_of, -1)
    return contacts.where(F.col("channel").isin("Agency", "DMTM")).select(
        "rh_code",
        "rh_name",
        F.col("sm_code2").alias("sm_code"),
        F.col("sm_incharge_loc").alias("sm_name"),
        F.col("sm_code2_email").alias("sm_email"),
        F.col("direct_mgr").alias("direct_mgr_code"),
        F.col("direct_mgr_nm").alias("direct_mgr_name"),
        "agt_code",
        F.col("agt_nm").alias("agt_name"),
        "location_code",
        "location_name",
        "mba_ind",
        F.col("fta_flag").alias("fta_ind"),
        (F.lit(month_number(report)) - month_index("cntrct_eff_dt")).cast("long").alias("srv_mth"),
        "channel",
        "comp_prvd_num",
        F.lit(report).alias("reporting_date"),
    )


def first_exams(
    classes: DataFrame, attendance: DataFrame, exams: DataFrame, results: DataFrame, category: str = "EX"
) -> DataFrame:
    """Exam sittings on each candidate's first exam date, with a result of the category.

    Inputs: classes (cls_num), attendance (can_num, class_cd), exams (class_cd, exam_dt,
    exam_master_cd), results (can_num, class_cd, training_cat_cd, eff_dt).
    """
    sat = (
        results.where(F.col("training_cat_cd") == category)
        .select("can_num", "class_cd", "eff_dt")
        .join(attendance.select("can_num", "class_cd"), ["can_num", "class_cd"])
        .join(classes.select(F.col("cls_num").alias("class_cd")), "class_cd")
        .join(exams.select("class_cd", "exam_dt", "exam_master_cd"), "class_cd")
    )
    firsts = first_ties_by(sat, ["can_num"], [F.col("exam_dt").asc_nulls_first()])
    return firsts.where(F.col("exam_dt").isNotNull()).select(
        "can_num",
        F.col("class_cd").alias("ex_cls_num"),
        F.col("exam_master_cd").alias("ex_exam_code"),
        F.col("exam_dt").alias("ex_exam_dt"),
        F.col("eff_dt").alias("ex_eff_dt"),
    )


def active_agents(
    agents: DataFrame,
    units: DataFrame,
    lines: DataFrame,
    locations: DataFrame,
    candidates: DataFrame,
    channels: DataFrame,
    exams: DataFrame,
    first_exam: DataFrame,
    codes: DataFrame,
) -> DataFrame:
    """Agents on the books with their direct manager, channel, class exam and first exam.

    An agent who heads their own unit is managed one line up. Inputs: agents (agt_code,
    agt_nm, class_num, agt_join_dt, br_code, loc_code, stat_cd, rank_cd, unit_code,
    team_code, can_num, comp_prvd_num), units (stru_grp_cd, stru_grp_typ, mgr_cd), lines
    (agt_cd, sub_agt_cd, rpt_level), locations (loc_cd, loc_desc), candidates (can_num,
    id_num, can_dob, sex_code, agent_group), channels (comp_prvd_num, chnl_cd), exams
    (class_cd, exam_dt, exam_master_cd), ``first_exam`` from :func:`first_exams`.
    """
    staff = pick(
        agents, "agents", "agt_code", "agt_nm", "class_num", "agt_join_dt", "br_code", "loc_code", "stat_cd",
        "rank_cd", "unit_code", "team_code", "can_num", "comp_prvd_num",
    )
    own_unit = units.where(F.col("stru_grp_typ") == "UN").select(
        F.col("stru_grp_cd").alias("unit_code"), "mgr_cd"
    )
    above = lines.where(F.col("rpt_level").cast("int") == 1).select(
        F.col("sub_agt_cd").alias("agt_code"), F.col("agt_cd").alias("line_mgr")
    )
    sold_by = channels.where(F.col("chnl_cd").isin(*v.CHANNEL_TEXT)).select(
        "comp_prvd_num", value_map("chnl_cd", v.CHANNEL_TEXT).alias("channel_code")
    )
    class_exam = exams.select(
        F.col("class_cd").alias("class_num"),
        F.col("exam_master_cd").alias("exam_code"),
        F.col("exam_dt").alias("exam_date"),
    )
    full = (
        staff.where(F.col("stat_cd").isin("01", "99"))
        .join(own_unit, "unit_code")
        .join(above, "agt_code")
        .join(locations.select(F.col("loc_cd").alias("loc_code"), "loc_desc"), "loc_code")
        .join(candidates.select("can_num", "id_num", "can_dob", "sex_code", "agent_group"), "can_num")
        .join(sold_by, "comp_prvd_num")
        .join(class_exam, "class_num", "left")
        .join(first_exam, "can_num", "left")
    )
    full = decode(full, codes, "AGENT_GROUP", "agent_group", "agent_group_desc", how="left")
    own = F.col("mgr_cd") == F.col("agt_code")
    return full.select(
        F.col("agt_code").alias("agent_code"),
        F.col("agt_nm").alias("agent_name"),
        F.col("class_num").alias("class_code"),
        "exam_code",
        F.col("agt_join_dt").alias("agent_load_code"),
        "br_code",
        F.col("loc_code").alias("location_code"),
        F.col("stat_cd").alias("status"),
        "rank_cd",
        F.year("agt_join_dt").alias("vyear"),
        F.month("agt_join_dt").alias("vmonth"),
        "exam_date",
        F.when(own, F.col("line_mgr")).otherwise(F.col("mgr_cd")).alias("direct_manager_code"),
        F.col("loc_desc").alias("location_name"),
        "team_code",
        "comp_prvd_num",
        F.col("id_num").alias("id_number"),
        F.col("can_dob").alias("agent_dob"),
        "sex_code",
        "channel_code",
        "ex_cls_num",
        "ex_exam_code",
        "ex_exam_dt",
        "ex_eff_dt",
        F.col("agent_group_desc").alias("agent_group"),
    ).distinct()
