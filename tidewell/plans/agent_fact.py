"""Base fact of the agent pack: one row per coverage sold by an active agency agent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import pick, require
from ..functions.amounts import MONEY, adjusted_premium, ape, mean_of, owner_relation, value_map
from ..functions.conditions import flag
from ..functions.dates import DateLike, day, month_index, month_number, months_apart, week_number
from ..operators.aggregates import best_by_distinct_count
from ..operators.joins import lookup
from ..operators.windows import with_first_flag
from . import values as v


def agency_agents(agents: DataFrame) -> DataFrame:
    """Active agency agents. Input: (agt_code, channel, comp_prvd_num, agt_stat_code, agt_term_dt, ..)."""
    require(agents, "agents", "agt_code", "channel", "comp_prvd_num", "agt_stat_code", "agt_term_dt")
    return agents.where(
        F.col("agt_code").isNotNull()
        & (F.col("channel") == "Agency")
        & F.col("comp_prvd_num").isin("01", "98")
        & (F.col("agt_stat_code") == "1")
        & F.col("agt_term_dt").isNull()
    )


def plan_margins(margins: DataFrame, as_of: DateLike) -> DataFrame:
    """Product type and last year's mean margin per plan.

    The type is the need a plan was listed under on the most dates. Input: (plan_code,
    customer_needs, effective_date, effective_qtr, nbv_margin_agency).
    """
    rows = margins.distinct()
    kind = best_by_distinct_count(rows, "plan_code", "customer_needs", "effective_date", "type")
    last_year = rows.where(F.substring("effective_qtr", 1, 4) == str(day(as_of).year - 1))
    mean = last_year.groupBy("plan_code").agg(
        mean_of(F.col("nbv_margin_agency").cast("decimal(18,8)")).alias("margin_nbv")
    )
    return kind.select("plan_code", "type").join(mean, "plan_code", "full_outer")


def coverage_fact(
    coverages: DataFrame,
    policies: DataFrame,
    agents: DataFrame,
    links: DataFrame,
    clients: DataFrame,
    candidates: DataFrame,
    margins: DataFrame,
    tiers: DataFrame,
    as_of: DateLike,
    *,
    single_plans: tuple[str, ...] = (),
) -> DataFrame:
    """Coverages of policies written by active agency agents, up to the report date.

    Inputs: coverages (pol_num, cli_num, plan_code, cvg_prem, cvg_typ, cvg_eff_dt,
    cvg_del_dt, cvg_stat_cd, rel_to_insrd), policies (pol_num, wa_cd_1, pol_eff_dt,
    pol_trmn_dt, pmt_mode, pol_stat_cd, pd_to_dt), agents (agt_code, can_num, agt_join_dt and
    the columns of :func:`agency_agents`), links (pol_num, cli_num, link_typ, rec_status),
    clients (cli_num, cli_nm, id_num, birth_dt, sex_code), candidates (can_num, id_num),
    margins as in :func:`plan_margins`, tiers (agt_code, tier).

    ``last_n_month_eff_cvg`` is -1 for the report month. Premium is cut for policies that
    ended in their first year, in full units. Only coverages whose policy has an owner count.
    """
    run = day(as_of)
    this_month = F.lit(month_number(run))

    # Everything known per agent, then per policy, is joined at that level; the coverages,
    # by far the most rows, meet only policies, insured clients and plans.
    staff = agency_agents(agents)
    staff = lookup(staff, candidates, "can_num", "can_num", "id_num", "agt_id_num")
    staff = lookup(staff, tiers, "agt_code", "agt_code", "tier", "tier", default=v.BASE_TIER)
    staff = staff.select(F.col("agt_code").alias("wa_cd_1"), "agt_join_dt", "agt_id_num", "tier")

    person = clients.select(
        "cli_num",
        (F.lit(run.year) - F.year("birth_dt")).alias("age"),
        F.upper("sex_code").alias("sex"),
        "id_num",
    )
    owner = person.drop("id_num").toDF("po_num", "po_age_this_year", "po_gender")
    # Clients who are agents themselves show their id number.
    agent_ids = candidates.select(F.col("id_num").alias("agent_id")).dropna().distinct()
    insured = person.join(agent_ids, F.col("id_num") == F.col("agent_id"), "left").select(
        "cli_num",
        F.col("age").alias("in_age_this_year"),
        F.col("sex").alias("ins_gender"),
        F.col("agent_id").alias("cli_id_num_agt_buy"),
    )
    owners = links.where((F.col("link_typ") == "O") & (F.col("rec_status") == "A"))
    owner_of = owners.groupBy("pol_num").agg(F.max("cli_num").alias("po_num"))

    held = (
        pick(
            policies, "policies", "pol_num", "wa_cd_1", "pol_eff_dt", "pol_trmn_dt", "pmt_mode",
            "pol_stat_cd", "pd_to_dt",
        )
        .withColumn("pmt_mode", F.col("pmt_mode").cast("int"))
        .join(staff, "wa_cd_1")
        .join(owner_of, "pol_num")
        .join(coverages.select("pol_num"), "pol_num", "left_semi")
    )
    held = with_first_flag(
        held, "po_num", [F.col("pol_eff_dt"), F.col("pol_num")], "pol_num", "if_first_pol", "repeat_sales"
    )
    held = held.where(F.col("pol_eff_dt") <= F.lit(run)).join(owner, "po_num", "left")
    fact = (
        pick(
            coverages, "coverages", "pol_num", "cli_num", "plan_code", "cvg_prem", "cvg_typ",
            "cvg_eff_dt", "cvg_del_dt", "cvg_stat_cd", "rel_to_insrd",
        )
        .where(F.col("cvg_eff_dt") <= F.lit(run))
        .join(held, "pol_num")
        .join(insured, "cli_num", "left")
        .join(plan_margins(margins, run), "plan_code", "left")
    )

    ended = F.least("pol_trmn_dt", "cvg_del_dt")
    same_person = F.coalesce(F.col("po_num") == F.col("cli_num"), F.lit(False))
    gap = F.when(~same_person, F.col("po_age_this_year") - F.col("in_age_this_year"))
    full = ape("cvg_prem", "pmt_mode")
    premium = adjusted_premium(
        F.col("pol_eff_days"), F.col("pmt_mode"), F.col("cvg_prem"), full,
        F.col("plan_code").isin(*single_plans) if single_plans else F.lit(False),
    )
    return (
        fact.withColumn("pol_eff_days", F.datediff(ended, "pol_eff_dt"))
        .withColumns(
            {
                "ape": full.cast(MONEY),
                "adjust_ape": (premium * 1000).cast("bigint"),
                "term_pol_last_days": F.datediff("pol_trmn_dt", "pol_eff_dt"),
                "cvg_eff_yr": F.year("cvg_eff_dt"),
                "pol_eff_yr": F.year("pol_eff_dt"),
                "cvg_month": month_index("cvg_eff_dt"),
                "pol_month": month_index("pol_eff_dt"),
                "end_month": month_index("pol_trmn_dt"),
                "cvg_eff_mth_from_pol_eff": months_apart("cvg_eff_dt", "pol_eff_dt") + 1,
                "cvg_eff_mth_from_agt_join": months_apart("cvg_eff_dt", "agt_join_dt") + 1,
                "pol_eff_mth_from_agt_join": months_apart("pol_eff_dt", "agt_join_dt") + 1,
                "pol_eff_days_from_agt_join": F.datediff("pol_eff_dt", "agt_join_dt"),
                "cvg_eff_week_from_agt_join": week_number("cvg_eff_dt", "agt_join_dt"),
                "last_n_month_eff_cvg": month_index("cvg_eff_dt") - this_month - 1,
                "last_n_month_end": month_index("pol_trmn_dt") - this_month - 1,
                "status": value_map("pol_stat_cd", v.STATUS_TEXT),
                "cvg_active": flag(F.col("cvg_stat_cd").isin("1", "2", "3", "5", "7")),
                "pol_active": flag(F.col("pol_stat_cd").isin("1", "2", "3", "5", "7")),
                "is_non_taken": flag(F.col("pol_stat_cd").isin("A", "N")),
                "lapsed": flag(F.col("pol_stat_cd") == "B"),
                "rejected": flag(F.col("pol_stat_cd") == "R"),
                "insrd": value_map(F.col("rel_to_insrd").cast("int"), v.RELATION_TEXT),
                "po_is_cli": flag(same_person),
                "po_cli_age_gap": gap,
                "po_ins_rela": owner_relation(same_person, gap, "po_gender", "ins_gender"),
                "pmt_mode_map": value_map("pmt_mode", v.PAYMENT_MODE_TEXT),
            }
        )
        .withColumns(
            {
                "be_is_cli": flag(F.col("insrd") == "Self"),
                "nbv": F.col("adjust_ape") * F.col("margin_nbv"),
                "prd_cus_mix": F.concat_ws("_", "type", "po_ins_rela"),
            }
        )
        .withColumn("prd_cus_mix", F.when(F.col("type").isNotNull(), F.col("prd_cus_mix")))
    )


def agent_list(agents: DataFrame, members: DataFrame, tiers: DataFrame, as_of: DateLike) -> DataFrame:
    """Agents of the programme with tenure in months and tier.

    Inputs: agents as in :func:`agency_agents` with (agt_nm, rank_code, br_code,
    agt_join_dt), members (agt_cd), tiers (agt_code, tier).
    """
    run = day(as_of)
    listed = agency_agents(agents).join(
        members.select(F.col("agt_cd").alias("agt_code")).distinct(), "agt_code", "left_semi"
    )
    tiered = lookup(listed, tiers, "agt_code", "agt_code", "tier", "tier", default=v.BASE_TIER)
    return tiered.select(
        F.col("agt_code").alias("agt_cd"),
        "agt_nm",
        "rank_code",
        "br_code",
        (F.lit(month_number(run)) - month_index("agt_join_dt")).alias("tenure_mth"),
        "agt_join_dt",
        "tier",
    )
