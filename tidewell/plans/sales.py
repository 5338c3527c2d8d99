"""New-business value, sales reports, e-commerce sales."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checks import pick, require
from ..functions.amounts import ape, payments_per_year, vip_tier
from ..functions.conditions import yn
from ..functions.dates import DateLike, day, day_shift, quarter_label
from ..operators.aggregates import weighted_sum
from ..operators.joins import interval_join, month_range_join
from ..operators.sets import stack_tagged
from ..operators.windows import first_by
from . import values as v

MARGINS = (
    "nbv_margin_banca_other_banks",
    "nbv_margin_other_channel_affinity",
    "nbv_margin_agency",
    "nbv_margin_dmtm",
    "nbv_margin_other_channel",
    "nbv_margin_banca_tcb",
    "nbv_margin_banca_scb",
    "nbv_margin_banca_vti",
)


def margin_for(channel: Column, location: Column, margins: dict[str, Column], form: str = "leads") -> Column:
    """The margin a sale earns, by its channel and the seller's location.

    ``margins`` maps the margin names to columns. Forms: ``leads``; ``ecommerce`` has a
    shorter loan margin and no third bank; ``upsell`` also gives every agency channel with a
    location the agency margin.
    """
    if form not in ("leads", "ecommerce", "upsell"):
        raise ValueError(f"unknown form {form}")
    loan = v.LEAD_LOAN_MARGIN if form == "leads" else v.ECOMMERCE_LOAN_MARGIN
    no_location = (
        F.when(channel.isin(*v.OTHER_BANK_CHANNELS), margins["nbv_margin_banca_other_banks"])
        .when(channel.isin(*v.AFFINITY_CHANNELS), margins["nbv_margin_other_channel_affinity"])
        .when(channel.isin(*v.AGENCY_CHANNELS), margins["nbv_margin_agency"])
        .when(channel.isin(*v.DIRECT_CHANNELS), margins["nbv_margin_dmtm"])
        .when(channel.isin(*v.LOAN_CHANNELS), F.lit(loan).cast("decimal(16,14)"))
        .otherwise(margins["nbv_margin_other_channel"])
    )
    agency = v.AGENCY_CHANNELS if form == "upsell" else ("*",)
    out = F.when(location.isNull(), no_location).when(channel.isin(*agency), margins["nbv_margin_agency"])
    for prefix, name in v.BANK_PREFIX_MARGINS.items():
        if form == "leads" or prefix != "VTI":
            out = out.when(location.startswith(prefix), margins[name])
    return out.otherwise(margins["nbv_margin_other_channel"])


def _rate_columns(rates: DataFrame, mark: str, *extra: str) -> list[Column]:
    return [F.col(c).alias(f"{mark}_{c}") for c in (*MARGINS, *extra)]


def channel_group(channel: Column) -> Column:
    return (
        F.when(channel.isin(*v.AGENCY_CHANNELS), "Agency")
        .when(channel.isin(*v.DIRECT_CHANNELS), "DMTM")
        .otherwise("Banca")
    )


def new_business_value(
    policies: DataFrame,
    coverages: DataFrame,
    agents: DataFrame,
    rates: DataFrame,
    plan_rates: DataFrame,
) -> DataFrame:
    """Value of new business per policy: coverage premium times margin, summed over coverages.

    The margin of the plan two quarters before issue counts, or the plan's general margin
    where that quarter has none. Inputs: policies (pol_num, po_num, plan_code, plan_nm,
    pol_iss_dt, pol_stat_cd, pol_stat_desc, tot_ape, wa_code, dist_chnl_cd), coverages
    (pol_num, cvg_prem), agents (agt_code, loc_cd), rates (plan_code, effective_qtr and the
    margins), plan_rates (plan_code and the margins).
    """
    require(rates, "rates", "plan_code", "effective_qtr", *MARGINS)
    require(plan_rates, "plan_rates", "plan_code", *MARGINS)
    sold = pick(
        policies, "policies", "pol_num", "po_num", "plan_code", "plan_nm", "pol_iss_dt", "pol_stat_cd",
        "pol_stat_desc", "tot_ape", "wa_code", "dist_chnl_cd",
    ).where(
        ~F.col("pol_stat_cd").isin(*v.NOT_SOLD)
        & ~F.substring("plan_code", 1, 3).isin(*v.LEAD_EXCLUDED_PLAN_PREFIXES)
    ).withColumn("rate_qtr", quarter_label("pol_iss_dt"))
    priced = (
        sold.join(agents.select(F.col("agt_code").alias("wa_code"), "loc_cd"), "wa_code", "left")
        .join(
            rates.select("plan_code", F.col("effective_qtr").alias("rate_qtr"), *_rate_columns(rates, "q")),
            ["plan_code", "rate_qtr"],
            "left",
        )
        .join(plan_rates.select("plan_code", *_rate_columns(plan_rates, "p")), "plan_code", "left")
    )
    margins = {m: F.coalesce(F.col(f"q_{m}"), F.col(f"p_{m}")) for m in MARGINS}
    priced = priced.withColumn("margin", margin_for(F.col("dist_chnl_cd"), F.col("loc_cd"), margins))
    keys = ["pol_num", "po_num", "plan_code", "plan_nm", "pol_iss_dt", "pol_stat_desc", "tot_ape",
            "wa_code", "loc_cd"]
    return (
        priced.join(coverages.select("pol_num", "cvg_prem"), "pol_num")
        .groupBy(*keys, channel_group(F.col("dist_chnl_cd")).alias("channel"))
        .agg(F.sum(F.round(F.col("cvg_prem") * F.col("margin"), 2)).alias("nbv"))
        .select(*keys, "nbv", "channel")
    )


def submissions(batch_details: DataFrame, changes: DataFrame, outstanding: DataFrame) -> DataFrame:
    """Submission dates of three sources, tagged '1', '2', '3'.

    Inputs: batch_details (pol_num, trxn_dt, btch_role, btch_dtl_stat_cd), changes (pol_num,
    sbmt_date, dept_typ), outstanding (pol_num, input_dt).
    """
    cashier = batch_details.where((F.col("btch_role") == "C") & (F.col("btch_dtl_stat_cd") == "A"))
    return stack_tagged(
        {
            "1": cashier.select("pol_num", "trxn_dt"),
            "2": changes.where(F.col("dept_typ") == "NB").select(
                "pol_num", F.col("sbmt_date").alias("trxn_dt")
            ),
            "3": outstanding.select("pol_num", F.col("input_dt").alias("trxn_dt")),
        },
        "rowtype",
    )


def first_submissions(events: DataFrame) -> DataFrame:
    """Earliest submission per policy, over all sources and at the cashier (sources 1 and 2)."""
    at_cashier = F.col("rowtype").isin("1", "2")
    return events.groupBy("pol_num").agg(
        F.min("trxn_dt").cast("date").alias("submis_dt"),
        F.min(F.when(at_cashier, F.col("trxn_dt"))).cast("date").alias("sbmts_at_cashier"),
    )


def first_year_premium(work: DataFrame) -> DataFrame:
    """First-year premium per policy, plan, kind and agent; top-ups and single premium at 6 %."""
    return work.groupBy("pol_num", "plan_code", "typ", "agt_code").agg(
        weighted_sum("amt", "typ", v.FYP_WEIGHTS).alias("fyp_amt")
    )


def commission(ledger: DataFrame) -> DataFrame:
    """First-year commission per policy, plan and agent; missing values count 0."""
    return (
        ledger.where((F.col("crr_typ") == "COM") & (F.col("reasn_cd") == "115"))
        .groupBy("pol_num", F.col("plan_cd").alias("plan_code"), F.col("agt_cd").alias("agt_code"))
        .agg(F.sum(F.coalesce("crr_valu", F.lit(0))).alias("amt"))
    )


def sales_report(
    agents: DataFrame,
    trailers: DataFrame,
    coverages: DataFrame,
    policies: DataFrame,
    plans: DataFrame,
    histories: DataFrame,
    work: DataFrame,
    commissions: DataFrame,
    commissions_backup: DataFrame,
    lines: DataFrame,
    submitted: DataFrame,
    as_of: DateLike,
    *,
    by: str = "submit",
    provider: str = "01",
) -> DataFrame:
    """Coverages sold by agents of a provider in the last year, with premium and commission.

    ``by='submit'`` takes policies submitted in the 365 days to ``as_of``, ``by='join'``
    agents who joined in them. In a coverage's first year the commission is the sum of both
    commission ledgers, before and after it the first-year premium. ``submitted`` comes from
    :func:`submissions`. Other inputs: agents (agt_code, agt_join_dt, loc_code,
    comp_prvd_num), trailers (agt_code, pol_num, plan_code, vers_num, cvg_eff_dt, pct_splt),
    coverages (pol_num, plan_code, vers_num, cvg_eff_dt, cvg_prem, cvg_typ), policies
    (pol_num, pol_stat_cd, pmt_mode, frst_iss_dt, sbmt_dt, plan_code_base, wa_cd_1,
    wa_cd_2), plans (plan_code, vers_num, plan_lng_desc), histories (pol_num, trxn_dt,
    trxn_cd, reasn_code), work (pol_num, plan_code, typ, agt_code, amt), commissions
    (pol_num, plan_cd, agt_cd, crr_typ, reasn_cd, crr_valu), lines (agt_cd, sub_agt_cd,
    rpt_level).
    """
    if by not in ("submit", "join"):
        raise ValueError(f"by is 'submit' or 'join', not {by}")
    run = day(as_of)
    last_year = (F.lit(day_shift(run, -365)), F.lit(run))
    staff = agents.where(F.col("comp_prvd_num") == provider).select("agt_code", "agt_join_dt", "loc_code")
    sold = policies.select(
        "pol_num", "pol_stat_cd", "pmt_mode", "frst_iss_dt", "sbmt_dt", "plan_code_base",
        "wa_cd_1", "wa_cd_2",
    )
    if by == "join":
        staff = staff.where(F.col("agt_join_dt").between(*last_year))
    else:
        sold = sold.where(F.col("sbmt_dt").between(*last_year))
    confirmed = (
        histories.where((F.col("trxn_cd") == "NEWBUS") & (F.col("reasn_code") == "111"))
        .groupBy("pol_num")
        .agg(F.min("trxn_dt").cast("date").alias("cnfrm_acpt_dt"))
    )
    seller = ["pol_num", "plan_code", "agt_code"]
    premium = first_year_premium(work.where(F.col("typ") == "FYP")).drop("typ")
    regular = commission(commissions).withColumnRenamed("amt", "com_amt")
    backup = commission(commissions_backup).withColumnRenamed("amt", "com_bk_amt")
    manager = lines.where(F.col("rpt_level").cast("int") == 1).select(
        F.col("sub_agt_cd").alias("agt_code"), F.col("agt_cd").alias("dr_mgr_cd")
    )
    yesterday = F.lit(day_shift(run, -1))
    in_first_year = (F.col("cvg_eff_dt") < yesterday) & (yesterday < F.add_months("cvg_eff_dt", 12))
    paid = F.coalesce("com_amt", F.lit(0)) + F.coalesce("com_bk_amt", F.lit(0))
    coverage_key = ["pol_num", "plan_code", "vers_num", "cvg_eff_dt"]
    return (
        trailers.select("agt_code", *coverage_key, "pct_splt")
        .join(staff, "agt_code")
        .join(coverages.select(*coverage_key, "cvg_prem", "cvg_typ"), coverage_key)
        .join(sold, "pol_num")
        .join(plans.select("plan_code", "vers_num", "plan_lng_desc"), ["plan_code", "vers_num"])
        .join(confirmed, "pol_num", "left")
        .join(manager, "agt_code", "left")
        .join(premium, seller, "left")
        .join(regular, seller, "left")
        .join(backup, seller, "left")
        .join(first_submissions(submitted), "pol_num", "left")
        .select(
            "agt_code",
            F.col("agt_join_dt").cast("date").alias("agt_join_dt"),
            "pol_num",
            "pol_stat_cd",
            "fyp_amt",
            F.when(in_first_year, paid).otherwise(F.col("fyp_amt")).alias("fyc_amt"),
            (F.col("cvg_prem") / F.col("pmt_mode").cast("int") * 12).alias("ape"),
            "submis_dt",
            F.col("frst_iss_dt").cast("date").alias("issuedate"),
            "cnfrm_acpt_dt",
            "cvg_typ",
            F.col("plan_code_base").alias("plan_cd_base"),
            "plan_code",
            "plan_lng_desc",
            F.col("loc_code").alias("loc_cd"),
            "dr_mgr_cd",
            "pct_splt",
            "sbmts_at_cashier",
            "wa_cd_1",
            "wa_cd_2",
        )
        .distinct()
    )


def ecommerce_sales(
    policies: DataFrame,
    links: DataFrame,
    orders: DataFrame,
    rates: DataFrame,
    plan_rates: DataFrame,
    scorecard: DataFrame,
    agents: DataFrame,
    locations: DataFrame,
    as_of: DateLike,
    *,
    plans: tuple[str, ...] = v.ECOMMERCE_PLANS,
    upsell_days: int = 180,
) -> DataFrame:
    """E-commerce policies of this and the two years before, each with what its owner bought next.

    ``new_ind`` is 'Y' when the owner held no other plan before; upsells are other plans the
    owner was issued within ``upsell_days`` after. Inputs: policies (pol_num, agt_code,
    wa_cd_1, plan_code_base, vers_num_base, dist_chnl_cd, pol_iss_dt, pol_eff_dt,
    frst_iss_dt, pol_stat_cd, mode_prem, pmt_mode), links (pol_num, cli_num, link_typ,
    rec_status), orders (source, pol_num, batch_trxn_amt, batch_trxn_dt, shopee_order_id,
    case_status, case_count, api_import_time), rates (plan_code, effective_date,
    nbv_factor_group, margins), plan_rates (plan_code, nbv_factor_group, margins), scorecard
    (agt_code, agent_tier, monthend_dt), agents (agt_code, loc_code), locations (loc_cd,
    rh_code, rh_name).
    """
    require(rates, "rates", "plan_code", "effective_date", "nbv_factor_group", *MARGINS)
    run = day(as_of)
    owners = links.where(F.col("link_typ") == "O")
    last_order = (
        orders.where(F.col("shopee_order_id").isNotNull())
        .groupBy("source", "pol_num", "batch_trxn_amt", "batch_trxn_dt", "case_status")
        .agg(
            F.max("shopee_order_id").alias("shopee_order_id"),
            F.max("case_count").alias("case_count"),
            F.max("api_import_time").cast("date").alias("api_import_time"),
        )
    )
    tiers = first_by(
        scorecard.where(F.col("agent_tier").isNotNull()),
        ["agt_code", "monthend_dt"],
        [F.col("agent_tier")],
    ).select("agt_code", F.col("monthend_dt").alias("month_end"), "agent_tier")
    quarter_rates = rates.select(
        F.col("plan_code").alias("rate_plan"),
        "effective_date",
        F.col("nbv_factor_group").alias("q_group"),
        *_rate_columns(rates, "q"),
    )
    seller = agents.select(F.col("agt_code").alias("wa_cd_1"), "loc_code")
    heads = locations.select(F.col("loc_cd").alias("loc_code"), "rh_code", "rh_name")
    policies = pick(
        policies, "policies", "pol_num", "agt_code", "wa_cd_1", "plan_code_base", "vers_num_base",
        "dist_chnl_cd", "pol_iss_dt", "pol_eff_dt", "frst_iss_dt", "pol_stat_cd", "mode_prem", "pmt_mode",
    )
    issued = policies.where(~F.col("pol_stat_cd").isin(*v.NOT_SOLD))

    online = issued.where(
        (F.col("pol_iss_dt") >= F.lit(date(run.year - 2, 1, 1))) & F.col("plan_code_base").isin(*plans)
    )
    amount = F.coalesce("batch_trxn_amt", ape("mode_prem", "pmt_mode"))
    own_margin = margin_for(
        F.col("dist_chnl_cd"), F.col("loc_code"), {m: F.col(f"q_{m}") for m in MARGINS}, "ecommerce"
    )
    sales = (
        month_range_join(
            online.join(owners.select("pol_num", "cli_num"), "pol_num")
            .join(last_order, "pol_num", "left")
            .join(seller, "wa_cd_1", "left")
            .join(heads, "loc_code", "left")
            .withColumn("month_end", F.last_day("pol_iss_dt"))
            .join(tiers, ["agt_code", "month_end"], "left"),
            quarter_rates,
            ("plan_code_base", "rate_plan"),
            "pol_iss_dt",
            "effective_date",
        )
        .select(
            "source",
            "api_import_time",
            "cli_num",
            "pol_num",
            F.col("agt_code").alias("agent_code"),
            F.coalesce("agent_tier", F.lit("Unknown")).alias("agent_tier"),
            F.col("loc_code").alias("agent_location_code"),
            "batch_trxn_dt",
            F.round(amount, 2).alias("batch_trxn_amt"),
            F.round(amount * own_margin, 2).alias("nbv"),
            "shopee_order_id",
            F.col("plan_code_base").alias("plan_code"),
            F.col("vers_num_base").alias("vers_num"),
            F.col("pol_iss_dt").cast("date").alias("pol_iss_dt"),
            F.col("pol_eff_dt").cast("date").alias("policy_effective_date"),
            F.col("pol_stat_cd").alias("policy_status_code"),
            "case_status",
            F.col("rh_code").alias("agent_code_level_6"),
            F.col("rh_name").alias("agent_name_level_6"),
            F.coalesce("case_count", F.lit(1)).alias("case_count"),
            F.last_day("pol_iss_dt").alias("reporting_date"),
        )
        .distinct()
    )
    earlier = (
        policies.where(
            F.col("pol_stat_cd").isin(*v.ORIGINAL_HOLDING) & ~F.col("plan_code_base").isin(*plans)
        )
        .join(links.select("pol_num", "cli_num"), "pol_num")
        .groupBy("cli_num")
        .agg(F.min("frst_iss_dt").cast("date").alias("first_issue"))
    )
    yearly = ape("mode_prem", "pmt_mode")
    up_margin = margin_for(
        F.col("dist_chnl_cd"),
        F.col("loc_code"),
        {m: F.coalesce(F.col(f"q_{m}"), F.col(f"p_{m}")) for m in MARGINS},
        "upsell",
    )
    others = issued.where(~F.col("plan_code_base").isin(*plans)).join(
        owners.where(F.col("rec_status") == "A").select("pol_num", "cli_num"), "pol_num"
    )
    general = plan_rates.select(
        F.col("plan_code").alias("plan_code_base"),
        F.col("nbv_factor_group").alias("p_group"),
        *_rate_columns(plan_rates, "p"),
    )
    upsells = month_range_join(
        others.join(seller, "wa_cd_1", "left").join(general, "plan_code_base", "left"),
        quarter_rates,
        ("plan_code_base", "rate_plan"),
        "pol_iss_dt",
        "effective_date",
    ).select(
        F.col("cli_num").alias("up_cli"),
        F.col("pol_num").alias("cc_upsell"),
        F.col("plan_code_base").alias("cc_plancode"),
        F.coalesce("q_group", "p_group").alias("cc_productgroup"),
        F.col("pol_iss_dt").cast("date").alias("iss_dt_upsell"),
        (payments_per_year("pmt_mode") * F.col("mode_prem") * 1000).alias("ape_upsell"),
        F.round(yearly * up_margin, 2).alias("nbv_upsell"),
    )
    paired = interval_join(
        sales,
        upsells,
        [("cli_num", "up_cli")],
        "pol_iss_dt",
        "iss_dt_upsell",
        1,
        upsell_days,
        how="left",
    )
    was_new = F.col("first_issue").isNull() | ~F.coalesce(
        F.col("pol_iss_dt") > F.col("first_issue"), F.lit(False)
    )
    return (
        paired.join(earlier, "cli_num", "left")
        .withColumns(
            {
                "new_ind": yn(was_new),
                "ape_upsell": F.coalesce("ape_upsell", F.lit(0)),
                "nbv_upsell": F.coalesce("nbv_upsell", F.lit(0)),
            }
        )
        .drop("up_cli", "first_issue")
    )


def ecommerce_enrich(
    sales: DataFrame, customers: DataFrame, agents: DataFrame, holdings: DataFrame
) -> DataFrame:
    """E-commerce sales with the customer's profile, tier and holdings.

    A policy with upsells keeps one row (its earliest upsell, then least policy number);
    policies without keep theirs. Inputs: customers (cli_num, id_num, sex_code, cur_age,
    frst_iss_age, city), agents (id_num), holdings (po_num, pol_num, pol_stat_cd, tot_ape).
    """
    held = (
        holdings.where(F.col("pol_stat_cd").isin(*v.PAYING))
        .groupBy("po_num")
        .agg(F.countDistinct("pol_num").alias("no_pols"), F.sum("tot_ape").alias("tot_ape"))
    )
    agent_ids = agents.select("id_num").where(F.col("id_num").isNotNull()).distinct()
    tenure = F.col("cur_age") - F.col("frst_iss_age")
    profile = (
        customers.join(agent_ids.withColumn("is_agent", F.lit("Y")), "id_num", "left")
        .join(held, F.col("cli_num") == F.col("po_num"), "left")
        .select(
            "cli_num",
            F.col("sex_code").alias("gender"),
            F.col("cur_age").alias("age_curr"),
            vip_tier("tot_ape", F.coalesce(tenure >= 10, F.lit(False)), v.ENRICHED_TIERS).alias("vip_cat"),
            "city",
            tenure.alias("tenure"),
            "tot_ape",
            F.coalesce("is_agent", F.lit("N")).alias("agent_ind"),
            "no_pols",
        )
    )
    full = sales.join(profile, "cli_num")
    with_upsell = first_by(
        full.where(F.col("cc_upsell").isNotNull()),
        ["pol_num"],
        [F.col("iss_dt_upsell"), F.col("cc_upsell"), F.col("batch_trxn_dt"), F.col("shopee_order_id")],
    )
    return full.where(F.col("cc_upsell").isNull()).unionByName(with_upsell)
