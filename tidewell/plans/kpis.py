"""Company and bank KPI tables in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.amounts import band, value_map
from ..functions.conditions import yn
from ..functions.dates import DateLike, day
from ..functions.text import contains, drop_last
from ..operators.aggregates import Kpi, count_if, kpi_block
from ..operators.joins import decode
from ..operators.sets import stack
from ..operators.windows import latest_by
from . import values as v
from .customers import owned

KPI_TABLE = ("kpi", "kpi_sub", "chnl", "kpi_val", "reporting_date")


def product_group(
    plan: Column, user: Column, version: Column, map_plan: Column, name: Column, *, bank: bool = False
) -> Column:
    """Product group of a policy, by plan code, entry user and version, then by the plan's name.

    The bank table knows fewer code groups.
    """
    out = None
    for label, codes in v.PRODUCT_CODE_GROUPS:
        if bank and label in v.BANK_UNGROUPED:
            continue
        test = plan.isin(*codes)
        out = F.when(test, label) if out is None else out.when(test, label)
    out = out.when(user == v.PARTNER_USER, v.PARTNER_GROUP)
    out = out.when((plan == v.PARTNER_PLAN) & version.isin(*v.PARTNER_VERSIONS), v.PARTNER_GROUP)
    if not bank:
        out = out.when(plan.isin(*v.CASH_PLANS), v.CASH_GROUP)
    out = out.when(map_plan == "UL007", "2015 Universal Life")
    lowered = F.lower(name)
    for part, label in v.NAME_GROUPS:
        out = out.when(contains(lowered, part), drop_last(name, v.FLEXIBLE_SUFFIX) if label is None else label)
    return out.otherwise("Others")


def product_groups(
    policies: DataFrame,
    coverages: DataFrame,
    links: DataFrame,
    plan_map: DataFrame,
    rpt_date: DateLike,
    *,
    bank: bool = False,
) -> DataFrame:
    """The product groups each client holds, one row per client and group.

    Inputs with image_date: policies (pol_num, plan_code_base, nb_user_id, pol_stat_cd),
    coverages (pol_num, cvg_typ, vers_num), links (pol_num, cli_num, link_typ); plan_map
    (plan_code, product_name, effective_date), whose newest row per plan counts.
    """
    here = F.col("image_date") == F.lit(day(rpt_date))
    newest = latest_by(
        plan_map, ["plan_code"], [F.col("effective_date").desc(), F.col("product_name")]
    ).select(F.col("plan_code").alias("map_plan"), "product_name")
    base = coverages.where(here & (F.col("cvg_typ") == "B")).select("pol_num", "vers_num").distinct()
    held = owned(
        policies.where(here & F.col("pol_stat_cd").isin(*v.PAYING)).select(
            "image_date", "pol_num", "plan_code_base", "nb_user_id"
        ),
        links.where(here),
    )
    group = product_group(
        F.col("plan_code_base"),
        F.col("nb_user_id"),
        F.col("vers_num"),
        F.col("map_plan"),
        F.col("product_name"),
        bank=bank,
    )
    return (
        held.join(base, "pol_num")
        .join(newest, F.col("plan_code_base") == F.col("map_plan"), "left")
        .select("cli_num", group.alias("product_group"))
        .distinct()
    )


def _policies_label(count: str) -> Column:
    n = F.col(count)
    return (
        F.when(n == 1, "1 policy")
        .when(n < 5, F.concat(n.cast("string"), F.lit(" policies")))
        .otherwise(">= 5 policies")
    )


def _riders_label(count: str) -> Column:
    """Rider band; no riders has a band of its own."""
    n = F.col(count)
    return (
        F.when(n == 0, "0 riders")
        .when(n == 1, "1 rider")
        .when(n == 2, "2 riders")
        .when(n.between(3, 5), "3 - 5 riders")
        .when(n.between(6, 10), "6 - 10 riders")
        .otherwise("> 10 riders")
    )


def _averages(suffix: str, sub: Column | None) -> list[Kpi]:
    """Policies, riders and premium per customer, premium per policy and per rider."""
    one = F.lit(1)
    both = (F.col("base_ape") + F.col("rid_ape")) * 1000
    return [
        Kpi(f"avg_pol_per_cust{suffix}", F.col("pol_cnt"), sub, one),
        Kpi(f"avg_rid_per_cust{suffix}", F.col("rid_cnt"), sub, one),
        Kpi(f"avg_ape_per_cust{suffix}", both, sub, one),
        Kpi(f"avg_case_size{suffix}", both, sub, F.col("pol_cnt")),
        Kpi(f"avg_ape_base{suffix}", F.col("base_ape") * 1000, sub, F.col("pol_cnt")),
        Kpi(f"avg_ape_rider{suffix}", F.col("rid_ape") * 1000, sub, F.col("rid_cnt")),
    ]


def _payment_modes(policies: DataFrame, links: DataFrame, codes: DataFrame, report: Column) -> DataFrame:
    """Paying policies of the snapshot with their owner and the text of their payment mode."""
    here = F.col("image_date") == report
    paying = policies.where(
        here & F.col("pol_stat_cd").isin(*v.PAYING) & (F.col("plan_code_base") != v.EXCLUDED_PLAN)
    ).select("image_date", "pol_num", "pmt_mode")
    names = codes.where(here).drop("image_date")
    return decode(
        owned(paying, links.where(here)), names, "PMT_MODE", "pmt_mode", "kpi_sub", text="fld_valu_desc_eng"
    ).select("pol_num", "cli_num", "kpi_sub")


def _distinct_kpi(df: DataFrame, name: str, item: str, sub: str, dims: list[str]) -> DataFrame:
    return (
        df.select(item, F.col(sub).alias("kpi_sub"), *dims)
        .distinct()
        .groupBy("kpi_sub", *dims)
        .agg(F.count(item).cast("double").alias("kpi_val"))
        .select(F.lit(name).alias("kpi"), "kpi_sub", *dims, "kpi_val")
    )


def company_kpis(
    customers: DataFrame,
    contacts: DataFrame,
    holdings: DataFrame,
    groups: DataFrame,
    status: DataFrame,
    registrations: DataFrame,
    policies: DataFrame,
    links: DataFrame,
    codes: DataFrame,
    rpt_date: DateLike,
) -> DataFrame:
    """The company KPI table (kpi, kpi_sub, chnl, kpi_val, reporting_date).

    Inputs: customers from ``customer_month`` (po_num, channel, cust_new_ytd, prod_cnt,
    customer_type, vip_seg, city, age_iss_group, age_curr_group, gender, tenure, mthly_incm,
    cws_reg, digital_reg_ind, pmt_ind, pmt_onl_ind, clm_ind, clm_cws_ind, clm_ezc_ind,
    reporting_date), contacts (cli_num, image_date, mobl_phon_num, sms_stat_cd, email_addr,
    service_method_recv), holdings from ``customer_holdings``, groups from
    :func:`product_groups`, status from ``servicing_status``, registrations from
    ``app_registrations``; policies, links and codes of the snapshot. All counts of one input
    come from a single pass over it.
    """
    require(customers, "customers", "po_num", "channel", "reporting_date", "vip_seg", "tenure")
    report = F.lit(day(rpt_date))
    one = F.lit(1)
    month = customers.where(F.col("reporting_date") == report)
    dims = ["channel", "reporting_date"]
    online_claim = (F.col("clm_cws_ind") == "Y") | (F.col("clm_ezc_ind") == "Y")
    new_or_old = F.when(F.col("cust_new_ytd") == "Y", "new_customer").otherwise("existing_customer")

    def present(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    by_customer = kpi_block(
        month,
        [
            Kpi("unique_customers", one, new_or_old),
            Kpi("customers_more_than_1_product", present(F.col("prod_cnt").isin(2, 3, 4) | (F.col("prod_cnt") > 4))),
            Kpi("existing_customers", present(F.col("customer_type") == "Existing Customer")),
            Kpi("new_customers", present(F.col("customer_type") == "New Customer")),
            Kpi("customer_segmentation", one, F.col("vip_seg")),
            Kpi("cities", one, F.col("city")),
            Kpi("customers_issue_age", one, F.col("age_iss_group")),
            Kpi("customers_curr_age", one, F.col("age_curr_group")),
            Kpi("customers_gender", one, value_map("gender", {"M": "Male", "F": "Female"}, "Unknown")),
            Kpi(
                "customers_tenure",
                one,
                band("tenure", v.KPI_TENURE_EDGES, v.KPI_TENURE_LABELS, v.KPI_TENURE_DEFAULT),
            ),
            Kpi(
                "sustomers_income",
                one,
                band("mthly_incm", v.INCOME_EDGES, v.INCOME_LABELS, v.INCOME_DEFAULT),
            ),
            Kpi("CWS_registration", one, F.col("cws_reg")),
            Kpi("digital_payment", one, F.col("pmt_onl_ind"), where=F.col("pmt_ind") == "Y"),
            Kpi("claim_online", one, yn(online_claim), where=F.col("clm_ind") == "Y"),
        ],
        dims,
    )
    reach = contacts.where(F.col("image_date") == report).select(
        F.col("cli_num").alias("po_num"), "mobl_phon_num", "sms_stat_cd", "email_addr", "service_method_recv"
    )
    by_contact = kpi_block(
        month.select("po_num", *dims).join(reach, "po_num"),
        [
            Kpi(
                "contact_availability_mobl",
                one,
                yn(F.col("sms_stat_cd") == "01"),
                where=F.col("mobl_phon_num").isNotNull(),
            ),
            Kpi(
                "contact_availability_email",
                one,
                yn(F.col("service_method_recv") == "2"),
                where=F.col("email_addr").isNotNull(),
            ),
        ],
        dims,
    )
    digital = month.groupBy("reporting_date").agg(
        count_if(F.col("digital_reg_ind") == "Y", "po_num").cast("double").alias("kpi_val")
    ).select(
        F.lit("digital_active_customers").alias("kpi"),
        F.lit(None).cast("string").alias("kpi_sub"),
        F.lit(None).cast("string").alias("channel"),
        "reporting_date",
        "kpi_val",
    )
    owner = month.select(F.col("po_num").alias("cli_num"), *dims)
    here = F.col("image_date") == report
    entered = owned(
        policies.where(
            here
            & F.col("nb_user_id").isin("SHOPEE", "ECOMMERCE")
            & (F.last_day("pol_iss_dt") == report)
            & F.col("pol_stat_cd").isin(*v.PAYING)
        ).select("image_date", "pol_num", "nb_user_id"),
        links.where(here),
    ).distinct()
    by_user = kpi_block(
        entered.join(owner, "cli_num"), [Kpi("Digital_product_volume", one, F.col("nb_user_id"))], dims
    )
    old, new = F.col("new_cust_ytd_ind") == "N", F.col("new_cust_ytd_ind") == "Y"
    by_holding = kpi_block(
        holdings,
        [
            Kpi("policies_per_cust_existing", one, _policies_label("pol_cnt"), where=old),
            Kpi("policies_per_cust_new_ytd", one, _policies_label("pol_cnt"), where=new),
            Kpi("coverages_per_cust", one, _riders_label("rid_cnt")),
            *_averages("", None),
        ],
        dims,
    )
    by_product = _distinct_kpi(
        groups.join(owner, "cli_num"), "product_distribution", "cli_num", "product_group", dims
    )
    by_status = kpi_block(status, [Kpi("customer_status", one, F.col("def"))], dims)
    by_mode = _distinct_kpi(
        _payment_modes(policies, links, codes, report).join(owner, "cli_num"),
        "policy_payment_mode",
        "pol_num",
        "kpi_sub",
        dims,
    )
    registered = registrations.withColumn("kpi_val", F.col("kpi_val").cast("double"))
    blocks = [
        by_customer, by_contact, digital, by_user, by_holding, by_product, by_status, by_mode, registered,
    ]
    return stack(blocks).withColumnRenamed("channel", "chnl").select(*KPI_TABLE)


def bank_kpis(
    holdings: DataFrame,
    customers: DataFrame,
    banks: DataFrame,
    groups: DataFrame,
    policies: DataFrame,
    links: DataFrame,
    codes: DataFrame,
    rpt_date: DateLike,
) -> DataFrame:
    """The bank KPI table (kpi, kpi_sub, bank_cd, kpi_val, reporting_date).

    ``holdings`` is the bank form of ``customer_holdings``, ``banks`` comes from
    ``bank_customers``, ``groups`` from :func:`product_groups` with ``bank=True``.
    """
    report = F.lit(day(rpt_date))
    one = F.lit(1)
    dims = ["bank_cd", "reporting_date"]
    by_holding = kpi_block(
        holdings,
        [
            Kpi("unique_customers_bnk", one),
            Kpi("policies_per_cust_bnk", one, _policies_label("pol_cnt")),
            Kpi("coverages_per_cust_bnk", one, _riders_label("rid_cnt")),
            *_averages("_bnk", F.lit("")),
        ],
        dims,
    )
    month = customers.where(F.col("reporting_date") == report)
    owner = month.select(F.col("po_num").alias("cli_num"), "reporting_date").join(banks, "cli_num")
    by_product = _distinct_kpi(
        groups.join(owner, "cli_num"), "product_distribution_bnk", "cli_num", "product_group", dims
    )
    by_mode = _distinct_kpi(
        _payment_modes(policies, links, codes, report).join(owner, "cli_num"),
        "policy_payment_mode_bnk",
        "pol_num",
        "kpi_sub",
        dims,
    )
    return stack([by_holding, by_product, by_mode]).select("kpi", "kpi_sub", "bank_cd", "kpi_val", "reporting_date")
