"""Customer tables: app customers, campaign, monthly premium, monthly table, holdings, profile."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import pick, require
from ..functions.amounts import ape, band, value_map, vip_tier
from ..functions.conditions import yn
from ..functions.dates import (
    DateLike,
    day,
    month_end,
    parse_mixed_ts,
    same_month,
    same_quarter,
    same_year,
    whole_years,
)
from ..functions.text import drop_first
from ..operators.aggregates import count_if, text_list
from ..operators.joins import decode, snapshot_join, with_top_row
from ..operators.windows import first_ties_by, latest_by
from . import values as v


def owned(policies: DataFrame, links: DataFrame) -> DataFrame:
    """Policies with their owner's client number, within the same snapshot if there is one."""
    owners = links.where(F.col("link_typ") == "O")
    if "image_date" in policies.columns and "image_date" in links.columns:
        return snapshot_join(policies, owners.select("image_date", "pol_num", "cli_num"), ["pol_num"])
    return policies.join(owners.select("pol_num", "cli_num"), "pol_num")


def app_users(
    users: DataFrame, members: DataFrame, keys: DataFrame, states: DataFrame | None = None
) -> DataFrame:
    """App users with their key; the key without its first letter is the client number.

    Inputs: users (_id), members (userid, keyid, status), keys (_id, value, activated,
    activationdate text), and states (userid, lastdatasync text) if the last sync is wanted.
    """
    key = keys.select(
        F.col("_id").alias("keyid"),
        F.col("value").alias("app_key"),
        drop_first("value").alias("cli_num"),
        F.col("activated").alias("key_activated"),
        F.try_to_date(F.substring("activationdate", 1, 10), "yyyy-MM-dd").alias("activation_date"),
    )
    out = (
        users.select(F.col("_id").alias("userid"))
        .join(members.select("userid", "keyid", F.col("status").alias("member_status")), "userid")
        .join(key, "keyid", "left")
    )
    columns = ["userid", "app_key", "cli_num", "member_status", "key_activated", "activation_date"]
    if states is not None:
        synced = F.try_to_date(F.substring("lastdatasync", 1, 10), "yyyy-MM-dd")
        out = out.join(states.select("userid", synced.alias("last_sync_date")), "userid", "left")
        columns.append("last_sync_date")
    return out.select(*columns).distinct()


def app_customers(
    policies: DataFrame,
    links: DataFrame,
    addresses: DataFrame,
    provinces: DataFrame,
    agents: DataFrame,
    users: DataFrame,
    campaign: DataFrame,
    as_of: DateLike,
    *,
    launch: DateLike = "2019-06-01",
    since: DateLike = "2022-06-01",
) -> DataFrame:
    """Customers with a paying policy whose newest policy is with a campaign agent.

    Counts policies up to the app's launch, after it, in the report month, in the three
    months to it and since a date; adds the app activation. Inputs: policies (pol_num,
    mode_prem, pmt_mode, pol_eff_dt, pol_stat_cd, agt_code), links (pol_num, cli_num,
    link_typ, rec_status, addr_typ), addresses (cli_num, addr_typ, zip_code), provinces
    (prov_id, prov_nm), agents (agt_code), ``users`` from :func:`app_users`, ``campaign``
    (agt_code).

    Everything about a customer, the newest policy's city and agent included, comes from one
    aggregate over the policies.
    """
    require(links, "links", "pol_num", "cli_num", "link_typ", "rec_status", "addr_typ")
    report = month_end(as_of, -1)
    eff = F.col("pol_eff_dt")
    quarter_back = F.lit(month_end(report, -2))
    active_links = links.where((F.col("link_typ") == "O") & (F.col("rec_status") == "A"))
    rows = (
        policies.where(
            ~F.col("pol_stat_cd").isin(*v.NOT_SOLD) & (F.col("pol_eff_dt") <= F.lit(report))
        )
        .select(
            "pol_num", "pol_eff_dt", "pol_stat_cd", "agt_code",
            F.round(ape("mode_prem", "pmt_mode"), 2).alias("ape"),
        )
        .join(agents.select("agt_code"), "agt_code", "left_semi")
        .join(active_links.select("pol_num", "cli_num", "addr_typ"), "pol_num")
        .join(
            addresses.select("cli_num", "addr_typ", F.substring("zip_code", 1, 2).alias("prov_id")),
            ["cli_num", "addr_typ"],
        )
        .join(provinces.select("prov_id", F.col("prov_nm").alias("customer_city")), "prov_id")
    )
    recent = F.last_day(eff) >= quarter_back
    per_customer = (
        rows.groupBy("cli_num")
        .agg(
            F.max_by(F.struct("customer_city", "agt_code"), F.struct("pol_eff_dt", "pol_num")).alias("newest"),
            count_if(F.col("pol_stat_cd").isin(*v.PAYING)).alias("paying"),
            count_if(eff <= F.lit(day(launch)), "pol_num").alias("vol_before_launch"),
            count_if(eff > F.lit(day(launch)), "pol_num").alias("vol_after_launch"),
            count_if(F.last_day(eff) == F.lit(report), "pol_num").alias("vol_in_rpt_mth"),
            count_if(recent, "pol_num").alias("vol_in_lst_3mths"),
            F.sum(F.when(recent, F.col("ape"))).alias("ape_in_lst_3mths"),
            count_if(eff >= F.lit(day(since)), "pol_num").alias("vol_since"),
        )
        .where(F.col("paying") > 0)
        .withColumns({"customer_city": F.col("newest.customer_city"), "agt_code": F.col("newest.agt_code")})
        .drop("newest", "paying")
    )
    activation = users.select(F.col("cli_num").alias("user_cli"), "key_activated", "activation_date")
    return (
        per_customer.join(campaign.select("agt_code"), "agt_code", "left_semi")
        .join(activation, F.col("cli_num").cast("string") == F.col("user_cli"), "left")
        .select(
            "cli_num",
            "customer_city",
            "vol_before_launch",
            "vol_after_launch",
            "vol_in_rpt_mth",
            "vol_in_lst_3mths",
            "ape_in_lst_3mths",
            "vol_since",
            "agt_code",
            F.when(F.col("key_activated") == 1, "Activated").otherwise("Not-Activated").alias("user_info"),
            "activation_date",
            F.when(F.col("vol_after_launch") > 0, "NPB").otherwise("Legacy").alias("cust_seg"),
            F.lit(report).alias("reporting_date"),
        )
    )


def agent_campaign(
    agents: DataFrame, customers: DataFrame, as_of: DateLike, *, promo_start: DateLike = "2022-07-01"
) -> DataFrame:
    """Campaign agents with their customers' activations by month, quarter, promotion and ever.

    ``agents`` from ``campaign_agents``, ``customers`` from :func:`app_customers`. A customer
    with several app keys is several rows there; distinct counts take them once. Both need the
    agents, who are few and come from many tables: ``settle`` them first.
    """
    report = F.lit(month_end(as_of, -1))
    on = F.col("user_info") == "Activated"
    when = F.col("activation_date")
    legacy, buyer, fresh = (
        F.col("vol_after_launch") == 0,
        F.col("vol_after_launch") > 0,
        F.col("vol_since") > 0,
    )
    # One row per agent and customer first; distinct counts are then plain counts.
    per_customer = customers.groupBy("agt_code", "cli_num").agg(
        F.max(on & same_month(when, report)).alias("in_month"),
        F.max(on & same_quarter(when, report)).alias("in_quarter"),
        F.max(on & (when >= F.lit(day(promo_start)))).alias("in_promo"),
        F.max(on).alias("ever"),
        F.max(when).alias("last"),
        count_if(legacy).alias("legacy"),
        count_if(legacy & on).alias("legacy_on"),
        count_if(buyer).alias("buyer"),
        count_if(buyer & on).alias("buyer_on"),
        count_if(fresh).alias("fresh"),
        count_if(fresh & on).alias("fresh_on"),
        F.sum("vol_in_rpt_mth").alias("rpt_mth"),
        F.sum("vol_in_lst_3mths").alias("lst_3mths"),
    )
    totals = per_customer.groupBy("agt_code").agg(
        F.count("cli_num").cast("double").alias("no_of_cust"),
        count_if(F.col("in_month"), "cli_num").alias("activation_this_month"),
        count_if(F.col("in_quarter"), "cli_num").alias("actvation_this_quarter"),
        count_if(F.col("in_promo"), "cli_num").alias("activation_total"),
        F.max("last").alias("lst_activation_date"),
        F.sum("rpt_mth").alias("vol_in_rpt_mth"),
        F.sum("lst_3mths").alias("vol_in_lst_3mths"),
        F.sum("legacy").alias("vol_of_cust_legacy"),
        F.sum("legacy_on").alias("vol_of_cust_legacy_activated"),
        F.sum("buyer").alias("vol_of_cust_nbp"),
        F.sum("buyer_on").alias("vol_of_cust_nbp_activated"),
        F.sum("fresh").alias("vol_of_cus_nb_since"),
        F.sum("fresh_on").alias("vol_of_cus_nb_since_activated"),
        count_if(F.col("ever"), "cli_num").alias("activation_ptd"),
    )
    return agents.join(totals, "agt_code", "left")


def top_campaign_agents(campaign: DataFrame, customers: DataFrame, top: int = 50) -> DataFrame:
    """The customers with the greatest recent premium, with their agent's campaign row.

    An agent appears once per such customer. Ties go by agent, then customer.
    """
    agent = campaign.drop("vol_in_rpt_mth", "vol_in_lst_3mths")
    customer = customers.select(
        "agt_code", "reporting_date", "cli_num", "vol_in_rpt_mth", "vol_in_lst_3mths", "ape_in_lst_3mths"
    )
    return (
        agent.join(customer, ["agt_code", "reporting_date"])
        .orderBy(F.col("ape_in_lst_3mths").desc_nulls_last(), "agt_code", "cli_num")
        .limit(top)
        .drop("cli_num")
    )


def insured_policies(
    policies: DataFrame,
    links: DataFrame,
    clients: DataFrame,
    contacts: DataFrame,
    addresses: DataFrame,
    provinces: DataFrame,
    plans: DataFrame,
    codes: DataFrame,
    agents: DataFrame,
    channels: DataFrame,
    rpt_date: DateLike,
) -> DataFrame:
    """Paying policies of one snapshot with owner, city, plan, status text and sales channel.

    All tables but ``channels`` have image_date. Inputs: policies (pol_num, plan_code_base,
    vers_num_base, mode_prem, pmt_mode, pol_stat_cd, pol_eff_dt, cnfrm_acpt_dt, agt_code),
    links (pol_num, cli_num, link_typ, rec_status, addr_typ), clients (cli_num), contacts
    (cli_num, email_addr), addresses (cli_num, addr_typ, zip_code), provinces (prov_id,
    prov_nm), plans (plan_code, vers_num, plan_lng_desc), codes, agents (agt_code,
    comp_prvd_num), channels (comp_prvd_num, chnl_cd).
    """
    report = F.lit(day(rpt_date))
    here = F.col("image_date") == report
    active = links.where(here & (F.col("link_typ") == "O") & (F.col("rec_status") == "A"))
    paying = pick(
        policies, "policies", "image_date", "pol_num", "plan_code_base", "vers_num_base", "mode_prem",
        "pmt_mode", "pol_stat_cd", "pol_eff_dt", "cnfrm_acpt_dt", "agt_code",
    )
    rows = snapshot_join(
        paying.where(here & F.col("pol_stat_cd").isin(*v.APP_PAYING)),
        active.select("image_date", "pol_num", "cli_num", "addr_typ"),
        ["pol_num"],
    )
    rows = snapshot_join(rows, clients.where(here).select("image_date", "cli_num"), ["cli_num"])
    rows = snapshot_join(
        rows, contacts.where(here).select("image_date", "cli_num", "email_addr"), ["cli_num"]
    )
    zoned = addresses.where(here & F.col("zip_code").isNotNull()).select(
        "image_date", "cli_num", "addr_typ", F.substring("zip_code", 1, 2).alias("prov_id")
    )
    rows = snapshot_join(rows, zoned, ["cli_num", "addr_typ"])
    rows = snapshot_join(rows, provinces.where(here).select("image_date", "prov_id", "prov_nm"), ["prov_id"])
    named = plans.where(here).select(
        "image_date",
        F.col("plan_code").alias("plan_code_base"),
        F.col("vers_num").alias("vers_num_base"),
        "plan_lng_desc",
    )
    rows = snapshot_join(rows, named, ["plan_code_base", "vers_num_base"])
    rows = decode(rows, codes.where(here).drop("image_date"), "STAT_CODE", "pol_stat_cd", "policy_status")
    rows = snapshot_join(
        rows, agents.where(here).select("image_date", "agt_code", "comp_prvd_num"), ["agt_code"]
    )
    rows = rows.join(channels.select("comp_prvd_num", "chnl_cd"), "comp_prvd_num")
    return rows.select(
        F.col("cli_num").alias("customer_id"),
        F.col("email_addr").alias("customer_email"),
        F.col("prov_nm").alias("customer_city"),
        F.col("pol_num").alias("policy_number"),
        F.col("plan_code_base").alias("plan_code"),
        F.col("plan_lng_desc").alias("plan_name"),
        ape("mode_prem", "pmt_mode").alias("policy_ape"),
        "policy_status",
        F.col("pol_eff_dt").alias("pol_eff_date"),
        F.date_format("pol_eff_dt", "yyyy-MM").alias("eff_mth"),
        "cnfrm_acpt_dt",
        F.col("chnl_cd").alias("agt_channel"),
        yn(F.col("chnl_cd") == "AGT").alias("agency_ind"),
        yn(F.col("chnl_cd") == "BK").alias("banca_ind"),
        yn(F.col("chnl_cd") == "DR").alias("dmtm_ind"),
    ).distinct()


def monthly_app_premium(
    policy_rows: DataFrame, users: DataFrame, rpt_date: DateLike, *, launch: DateLike = "2019-06-01"
) -> DataFrame:
    """Premium per customer before and after launch, after activation and in the month.

    ``policy_rows`` from :func:`insured_policies`, ``users`` from :func:`app_users`. The
    customer's channels and city are those of the newest policy (highest number on the
    latest date). A customer with two app keys is counted once per key, as the keys are
    joined before the sums.
    """
    report, start = F.lit(day(rpt_date)), F.lit(day(launch))
    newest = first_ties_by(
        policy_rows, ["customer_id"], [F.col("pol_eff_date").desc(), F.col("policy_number").desc()]
    )
    eligible = (
        newest.where(F.col("agt_channel").isin(*v.APP_CHANNEL_TEXT))
        .groupBy("customer_id", "customer_city")
        .agg(
            text_list(value_map("agt_channel", v.APP_CHANNEL_TEXT)).alias("channel"),
            F.max("agency_ind").alias("agency_ind"),
            F.max("banca_ind").alias("banca_ind"),
            F.max("dmtm_ind").alias("dmtm_ind"),
        )
    )
    eff = F.col("pol_eff_date")
    periods = {
        "before_launch": eff <= start,
        "after_launch": eff > start,
        "after_activation": eff > F.col("activation_date"),
        "new_policies": F.last_day(eff) == report,
    }
    user_key = F.col("customer_id").cast("string") == F.col("user_cli")
    keyed = users.withColumnRenamed("cli_num", "user_cli")
    volumes = (
        policy_rows.join(keyed.select("user_cli", "activation_date"), user_key, "left")
        .groupBy("customer_id")
        .agg(
            *[count_if(test, "policy_number").alias(name) for name, test in periods.items()],
            *[F.sum(F.when(test, F.col("policy_ape"))).alias(f"ape_{name}") for name, test in periods.items()],
        )
    )
    segment = (
        F.when(F.col("after_launch") == 0, "Legacy")
        .when(F.col("before_launch") == 0, "New policy buyer")
        .otherwise("New converted from Legacy")
    )
    return (
        eligible.join(volumes, "customer_id")
        .join(keyed.drop("userid"), user_key, "left")
        .select(
            "customer_id",
            "app_key",
            "before_launch",
            "ape_before_launch",
            "after_launch",
            "ape_after_launch",
            "new_policies",
            "ape_new_policies",
            "channel",
            value_map("customer_city", v.CITY_TEXT, "Others").alias("customer_city"),
            "member_status",
            "key_activated",
            "activation_date",
            segment.alias("cus_seg"),
            "after_activation",
            "ape_after_activation",
            yn((F.col("new_policies") > 0) & (F.col("after_activation") > 0)).alias("subsequent_ind"),
            "agency_ind",
            "banca_ind",
            "dmtm_ind",
            report.alias("reporting_date"),
        )
    )


def customer_month(
    customers: DataFrame,
    policies: DataFrame,
    links: DataFrame,
    clients: DataFrame,
    rpt_date: DateLike,
    as_of: DateLike,
    *,
    constants: Mapping[str, str] = v.RETIRED_COLUMNS,
) -> DataFrame:
    """The month's customer table: tier, new-in-month and new-in-year flags, policies held.

    ``customers`` has (po_num, tot_ape) and any further columns, which pass through.
    policies (pol_num, pol_iss_dt, pol_eff_dt, pol_stat_cd), links (pol_num, cli_num,
    link_typ), clients (cli_num). A policy is ten years old when it is at ``as_of``.
    """
    require(customers, "customers", "po_num", "tot_ape")
    report = F.lit(day(rpt_date))
    paying = F.col("pol_stat_cd").isin(*v.PAYING)
    old = whole_years(F.lit(day(as_of)), "pol_iss_dt") >= 10
    held = (
        owned(pick(policies, "policies", "pol_num", "pol_iss_dt", "pol_eff_dt", "pol_stat_cd"), links)
        .groupBy("cli_num")
        .agg(
            count_if(paying & old, "pol_num").alias("old_count"),
            F.min("pol_eff_dt").alias("first_eff"),
            count_if(paying, "pol_num").alias("paying_count"),
        )
    )
    known = clients.select(F.col("cli_num").alias("known_cli")).distinct()
    has_old = F.coalesce((F.col("old_count") >= 1) & F.col("known_cli").isNotNull(), F.lit(False))
    return (
        customers.join(held, F.col("po_num") == F.col("cli_num"), "left")
        .join(known, F.col("po_num") == F.col("known_cli"), "left")
        .select(
            *customers.columns,
            *[F.lit(text).alias(name) for name, text in constants.items()],
            vip_tier("tot_ape", has_old).alias("vip_seg"),
            yn(same_month(report, "first_eff")).alias("cust_new_mtd"),
            yn(same_year(report, "first_eff")).alias("cust_new_ytd"),
            F.when(F.col("paying_count") > 0, F.col("paying_count")).alias("policies_holding"),
            report.alias("reporting_date"),
        )
        .distinct()
    )


def bank_customers(policies: DataFrame, links: DataFrame, agents: DataFrame) -> DataFrame:
    """Clients and the bank (location prefix) of the bank agents who service their policies."""
    staff = agents.where((F.col("chnl_cd") == "03") & (F.col("stat_cd") == "01"))
    return (
        owned(
            pick(policies, "policies", "pol_num", "agt_code", "pol_stat_cd").where(
                F.col("pol_stat_cd").isin(*v.PAYING)
            ),
            links.where(F.col("rec_status") == "A"),
        )
        .join(
            staff.select("agt_code", F.substring("loc_code", 1, 3).alias("bank_cd")), "agt_code"
        )
        .select("cli_num", "bank_cd")
        .distinct()
    )


def customer_holdings(
    customers: DataFrame,
    policies: DataFrame,
    links: DataFrame,
    coverages: DataFrame,
    rates: DataFrame,
    rpt_date: DateLike,
    *,
    banks: DataFrame | None = None,
    currency: str = v.REPORT_CURRENCY,
) -> DataFrame:
    """Policies, base and rider premium of each customer in the report's currency.

    Premium is divided by the latest rate of the currency; policies in other currencies have
    none and form a row of their own. With ``banks`` (cli_num, bank_cd) there is one row per
    customer and bank. Inputs with image_date: policies (pol_num, pmt_mode, pol_stat_cd,
    crcy_code, pol_eff_dt), links (pol_num, cli_num, link_typ), coverages (pol_num, cvg_typ,
    cvg_reasn, cvg_stat_cd, cvg_prem); customers (po_num, channel, reporting_date), rates
    (xchng_rate, xchng_rate_typ, fr_crcy_code, to_crcy_code, to_eff_dt).
    """
    require(rates, "rates", "xchng_rate", "xchng_rate_typ", "fr_crcy_code", "to_crcy_code", "to_eff_dt")
    report = F.lit(day(rpt_date))
    here = F.col("image_date") == report
    in_currency = rates.where(
        (F.col("fr_crcy_code") == currency)
        & (F.col("to_crcy_code") == currency)
        & (F.col("xchng_rate_typ") == "U")
    )
    terms = pick(
        policies, "policies", "image_date", "pol_num", "pmt_mode", "pol_stat_cd", "crcy_code", "pol_eff_dt"
    )
    all_owned = owned(terms.where(here), links.where(here))
    paying = with_top_row(
        all_owned.where(F.col("pol_stat_cd").isin(*v.PAYING)),
        in_currency,
        [F.col("to_eff_dt").desc(), F.col("xchng_rate")],
        ["xchng_rate"],
        lambda top: F.col("crcy_code") == F.lit(currency),
    )
    kept = coverages.where(
        here & (F.col("cvg_reasn") == "O") & F.col("cvg_stat_cd").isin(*v.PAYING)
    ).select("image_date", "pol_num", "cvg_typ", "cvg_prem")
    is_base = F.col("cvg_typ") == "B"
    yearly = ape("cvg_prem", "pmt_mode")
    # Per policy first, so that policies can be counted without a distinct pass.
    per_policy = (
        snapshot_join(paying, kept, ["pol_num"])
        .groupBy("cli_num", "xchng_rate", "pol_num")
        .agg(
            F.sum(F.when(is_base, yearly)).alias("base"),
            count_if(~is_base).alias("riders"),
            F.sum(F.when(~is_base, yearly)).alias("rider"),
        )
    )
    held = per_policy.groupBy("cli_num", "xchng_rate").agg(
        F.count("pol_num").alias("pol_cnt"),
        (F.sum("base") / F.col("xchng_rate")).alias("base_ape"),
        F.sum("riders").alias("rid_cnt"),
        (F.sum("rider") / F.col("xchng_rate")).alias("rid_ape"),
    )
    month = customers.where(F.col("reporting_date") == report)
    measures = ["pol_cnt", "base_ape", "rid_cnt", "rid_ape"]
    if banks is not None:
        return (
            month.join(held, F.col("po_num") == F.col("cli_num"))
            .drop("cli_num")
            .join(banks, F.col("po_num") == F.col("cli_num"))
            .select("po_num", "bank_cd", "reporting_date", *measures)
        )
    first = all_owned.groupBy(F.col("cli_num").alias("first_cli")).agg(
        F.min("pol_eff_dt").alias("first_eff")
    )
    return (
        month.join(held, F.col("po_num") == F.col("cli_num"))
        .join(first, F.col("po_num") == F.col("first_cli"), "left")
        .select(
            "po_num",
            "channel",
            "reporting_date",
            *measures,
            yn(same_year("first_eff", report)).alias("new_cust_ytd_ind"),
        )
    )


def servicing_status(
    customers: DataFrame,
    policies: DataFrame,
    links: DataFrame,
    agents: DataFrame,
    collectors: DataFrame,
    rpt_date: DateLike,
) -> DataFrame:
    """How each customer's newest paying policy is serviced; null without one.

    Inputs: customers (po_num, channel, reporting_date), policies and links with image_date
    (pol_num, wa_cd_1, agt_code, pol_stat_cd, pol_iss_dt; pol_num, cli_num, link_typ), agents
    with image_date (agt_code, stat_cd, comp_prvd_num), collectors (col_code, col_grp).
    """
    report = F.lit(day(rpt_date))
    here = F.col("image_date") == report
    terms = pick(
        policies, "policies", "image_date", "pol_num", "wa_cd_1", "agt_code", "pol_stat_cd", "pol_iss_dt"
    )
    paying = owned(terms.where(here & F.col("pol_stat_cd").isin(*v.PAYING)), links.where(here))
    serviced = snapshot_join(
        paying.drop("pol_stat_cd"), agents.where(here).select("image_date", "agt_code", "stat_cd", "comp_prvd_num"), ["agt_code"]
    )
    newest = latest_by(
        serviced, ["cli_num"], [F.col("pol_iss_dt").desc(), F.col("pol_num").desc()]
    ).join(
        collectors.select(F.col("col_code").alias("agt_code"), "col_grp"), "agt_code", "left"
    )
    same_agent = F.col("wa_cd_1") == F.col("agt_code")
    collector = F.when(F.substring("col_grp", 1, 3) == "PSA", "PSA").otherwise("Collector")
    status = (
        F.when(F.col("comp_prvd_num") == "04", collector)
        .when(F.col("comp_prvd_num") == "98", "SM")
        .when(F.col("stat_cd") == "99", "Unassigned")
        .when((F.col("stat_cd") == "01") & same_agent, "Original")
        .when((F.col("stat_cd") == "01") & ~same_agent, "Reassigned")
        .otherwise("Unknown")
    )
    return (
        customers.where(F.col("reporting_date") == report)
        .select("reporting_date", "po_num", "channel")
        .join(
            newest.select(F.col("cli_num").alias("po_num"), status.alias("def")).distinct(),
            "po_num",
            "left",
        )
        .select("reporting_date", "po_num", "channel", "def")
    )


def app_registrations(
    users: DataFrame, members: DataFrame, keys: DataFrame, customers: DataFrame, rpt_date: DateLike
) -> DataFrame:
    """Customers who registered in the app in the report month, by channel.

    Inputs: users (_id, created: ISO text or epoch milliseconds as text), members (userid,
    keyid), keys (_id, value), customers (po_num, channel, reporting_date).
    """
    report = F.lit(day(rpt_date))
    registered = (
        users.select(F.col("_id").alias("userid"), parse_mixed_ts("created").alias("created_on"))
        .where(F.last_day("created_on") == report)
        .join(members.select("userid", "keyid"), "userid")
        .join(keys.select(F.col("_id").alias("keyid"), drop_first("value").alias("cli_num")), "keyid")
        .select("cli_num")
        .distinct()
    )
    month = customers.where(F.col("reporting_date") == report)
    return (
        month.select(F.col("po_num").cast("string").alias("cli_num"), "channel")
        .join(registered, "cli_num")
        .distinct()
        .groupBy("channel")
        .agg(F.count("cli_num").alias("kpi_val"))
        .select(
            F.lit(v.APP_KPI).alias("kpi"),
            F.lit("").alias("kpi_sub"),
            "channel",
            "kpi_val",
            report.alias("reporting_date"),
        )
    )


def customer_profile(
    customers: DataFrame, products: DataFrame, rpt_date: DateLike
) -> dict[str, DataFrame]:
    """The eleven profile counts by name.

    Inputs: customers (po_num, gender, age_curr, tot_ape, tenure, pol_iss_dt, channel,
    email_contact, mobile_contact, city), products (po_num and the need_* counts).
    """
    require(customers, "customers", "po_num", "gender", "age_curr", "tot_ape", "tenure", "pol_iss_dt",
            "channel", "email_contact", "mobile_contact", "city")
    require(products, "products", "po_num", *v.NEEDS.values())
    report = F.lit(day(rpt_date)).alias("reporting_date")
    people = F.count("po_num").cast("double").alias("val")

    def counted(df: DataFrame, *keys, measure=people, drop_null: bool = True) -> DataFrame:
        grouped = df.select("po_num", *keys)
        names = grouped.columns[1:]
        if drop_null:
            grouped = grouped.dropna(subset=names)
        return grouped.groupBy(*names).agg(measure).withColumn("reporting_date", report)

    age = band(F.floor("age_curr"), v.AGE_EDGES, v.AGE_LABELS)
    since_issue = whole_years(F.lit(month_end(rpt_date, -1)), "pol_iss_dt")
    tenure = band("tenure", v.TENURE_EDGES, v.TENURE_LABELS).alias("tenure_band")
    recency = band(since_issue, v.RECENCY_EDGES, v.RECENCY_LABELS, v.RECENCY_DEFAULT)
    distinct_people = F.countDistinct("po_num").cast("double").alias("val")
    needs = products.agg(
        *[count_if(F.col(column) > 0, "po_num").cast("double").alias(name) for name, column in v.NEEDS.items()]
    )
    contact = customers.agg(
        count_if(F.col("email_contact") == "Y", "po_num").cast("double").alias("with_email"),
        count_if(F.col("email_contact") == "N", "po_num").cast("double").alias("without_email"),
        count_if(F.col("mobile_contact") == "Y", "po_num").cast("double").alias("with_mbl_phone"),
        count_if(F.col("mobile_contact") == "N", "po_num").cast("double").alias("without_mbl_phone"),
    )
    return {
        "size": customers.agg(people).withColumn("reporting_date", report),
        "gender": counted(customers, F.col("gender")),
        "age_band": counted(customers, age.alias("age_band")),
        "ape": counted(customers, band("tot_ape", v.PREMIUM_EDGES, v.PREMIUM_LABELS).alias("ape_band")),
        "tenure": counted(customers, tenure, measure=distinct_people),
        "recency": counted(customers, recency.alias("recency"), measure=distinct_people),
        "tenure_vs_recency": counted(
            customers, tenure, recency.alias("recency_band"), measure=distinct_people
        ),
        "needs": needs.select(
            F.explode(F.array(*[F.struct(F.lit(n).alias("need_typ"), F.col(n).alias("val")) for n in v.NEEDS])).alias("e")
        ).select("e.need_typ", "e.val", report),
        "channel": counted(
            customers, F.col("channel"), measure=F.count(F.lit(1)).cast("double").alias("val"), drop_null=False
        ),
        "contact": contact.withColumn("reporting_date", report),
        "city": counted(customers, F.col("city")),
    }
