"""Leads and their attribution to sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.conditions import any_not_null, null_when, yn
from ..functions.dates import DateLike, day
from ..functions.text import fold, last_chars, keep_alnum, like_any, normalize_phone
from ..operators.joins import interval_join
from ..operators.lineage import settle

LEAD_SOURCE = (
    "id", "createddate", "lastname", "phone", "email", "state", "leadsource", "description",
    "iscustomer__c", "status", "website", "webtrackingid__c", "utmcampaignsource__c",
    "utmcampaignmedium__c", "utmcampaignname__c", "utmcampaigncontent__c", "ownerid",
    "createdbyid", "agent_account_agent_code__c",
)
TRACKING = (
    "website", "utmcampaignsource__c", "utmcampaignmedium__c", "utmcampaignname__c",
    "utmcampaigncontent__c",
)
LEAD = (
    "createddate", "lastname", "phone", "email", "state", "leadsource", "description",
    "iscustomer", "status", "website", "webtrackingid", "utmcampaignsource",
    "utmcampaignmedium", "utmcampaignname", "utmcampaigncontent", "id", "leadid", "ownerid",
    "owner_alias", "createdbyid", "created_by", "agent_code",
)
SALE_TEXT = (
    "pol_num", "po_num", "plan_code", "plan_nm", "pol_iss_dt", "pol_stat_desc", "wa_code",
    "loc_cd", "cli_nm", "mobl_phon_num", "email_addr", "channel",
)
SALE_AMOUNTS = ("tot_ape", "nbv")


def clean_leads(leads: DataFrame, users: DataFrame, excluded_patterns: Sequence[str]) -> DataFrame:
    """Leads worth following: traced to a page or campaign, worked on, not from excluded pages.

    ``excluded_patterns`` are ``LIKE`` patterns of lower-case addresses; a lead id that ever
    came from one is dropped. ``users`` has (id, alias, name).
    """
    require(leads, "leads", *LEAD_SOURCE)
    excluded = leads.where(like_any("website", excluded_patterns)).select("id").distinct()
    owner = users.select(F.col("id").alias("ownerid"), F.col("alias").alias("owner_alias"))
    creator = users.select(F.col("id").alias("createdbyid"), F.col("name").alias("created_by"))
    return (
        leads.where(any_not_null(TRACKING) & (F.col("status") != "New"))
        .join(excluded, "id", "left_anti")
        .join(owner, "ownerid")
        .join(creator, "createdbyid")
        .select(
            F.col("createddate").cast("date").alias("createddate"),
            "lastname",
            last_chars(keep_alnum("phone"), 9).alias("phone"),
            "email",
            "state",
            "leadsource",
            "description",
            F.when(F.col("iscustomer__c") == "false", "N").otherwise("Y").alias("iscustomer"),
            "status",
            "website",
            F.col("webtrackingid__c").alias("webtrackingid"),
            F.col("utmcampaignsource__c").alias("utmcampaignsource"),
            F.col("utmcampaignmedium__c").alias("utmcampaignmedium"),
            F.col("utmcampaignname__c").alias("utmcampaignname"),
            F.col("utmcampaigncontent__c").alias("utmcampaigncontent"),
            "id",
            F.substring("id", 1, 15).alias("leadid"),
            "ownerid",
            "owner_alias",
            "createdbyid",
            "created_by",
            F.col("agent_account_agent_code__c").alias("agent_code"),
        )
        .distinct()
    )


PHONES = ("mobl_phon_num", "prim_phon_num", "othr_phon_num")


def contact_entries(clients: DataFrame, contacts: DataFrame) -> DataFrame:
    """Each client's contact keys: ``po_num``, ``route`` ('phone' or 'email') and ``key``.

    Distinct phones, and the e-mail address folded.
    """
    phones = F.array_distinct(F.array_compact(F.array(*[normalize_phone(p) for p in PHONES])))
    by_phone = clients.select(F.col("cli_num").alias("po_num"), F.lit("phone").alias("route"), F.explode(phones).alias("key"))
    by_email = (
        contacts.where(F.col("email_addr").isNotNull())
        .join(clients.select("cli_num"), "cli_num", "left_semi")
        .select(F.col("cli_num").alias("po_num"), F.lit("email").alias("route"), fold("email_addr").alias("key"))
    )
    return by_phone.unionByName(by_email).distinct()


def attribute_leads(
    leads: DataFrame,
    sales: DataFrame,
    clients: DataFrame,
    contacts: DataFrame,
    *,
    issued: DataFrame | None = None,
    phone_days: tuple[int, int] = (2, 180),
    email_days: tuple[int, int] = (2, 366),
) -> DataFrame:
    """All leads with the sales that followed them to the same phone or e-mail address.

    Sales of leads marked as duplicates are blanked. ``leads`` comes from
    :func:`clean_leads`, ``sales`` from ``new_business_value``; clients (cli_num, cli_nm and
    three phone columns), contacts (cli_num, email_addr). ``issued`` (pol_num, po_num,
    pol_iss_dt) names the policies sold; given the plain policy table, a policy is priced only
    once a lead has met it.

    Leads and sales meet on ids and dates alone, each route over its own interval, and only
    sales of owners with a lead's phone or address take part. What is shown of a sale joins the
    pairs afterwards, so a phone number that many clients and leads share multiplies narrow
    rows only. What the leads ask for (one row per lead and key) and the pairs, both ids and
    dates, are read several times and settled, which runs two jobs.
    """
    require(clients, "clients", "cli_num", "cli_nm", *PHONES)
    sale_cols = [*SALE_TEXT, *SALE_AMOUNTS]
    sale_key = ["pol_num", "po_num", "pol_iss_dt"]
    lead_keys = F.array_compact(
        F.array(
            *[
                F.when(key.isNotNull(), F.struct(F.lit(route).alias("route"), key.alias("key")))
                for route, key in (("phone", F.col("phone")), ("email", fold("email")))
            ]
        )
    )
    duplicate = F.coalesce(F.lower(F.trim("status")).contains("duplicate"), F.lit(False))
    asked = settle(
        leads.select("id", "createddate", duplicate.alias("duplicate"), F.explode(lead_keys).alias("e"))
        .select("id", "createddate", "duplicate", "e.route", "e.key")
        .distinct()
    )
    wanted = asked.select("route", "key").distinct()
    owners = contact_entries(clients, contacts).join(wanted, ["route", "key"], "left_semi")
    sold = (
        (sales if issued is None else issued).select(*sale_key)
        .distinct()
        .join(owners, "po_num")
        .select(*[F.col(c).alias(f"s_{c}") for c in (*sale_key, "route", "key")])
    )
    pairs = None
    for route, (low, high) in (("phone", phone_days), ("email", email_days)):
        met = interval_join(
            asked.where(F.col("route") == route),
            sold.where(F.col("s_route") == route).drop("s_route"),
            [("key", "s_key")],
            "createddate",
            "s_pol_iss_dt",
            low,
            high,
        )
        found = met.select("id", "duplicate", "route", "key", *[F.col(f"s_{c}").alias(c) for c in sale_key])
        pairs = found if pairs is None else pairs.unionByName(found)
    pairs = settle(pairs)
    met_sales = sales.join(pairs.select(*sale_key).distinct(), sale_key, "left_semi")
    people = clients.select(F.col("cli_num").alias("po_num"), "cli_nm", normalize_phone("mobl_phon_num").alias("mobile"))
    addresses = contacts.select(F.col("cli_num").alias("po_num"), "email_addr")
    # A phone match shows that phone, an e-mail match the owner's mobile number.
    shown = (
        pairs.join(met_sales, sale_key)
        .join(people, "po_num")
        .join(addresses, "po_num", "left")
        .withColumn("mobl_phon_num", F.when(F.col("route") == "phone", F.col("key")).otherwise(F.col("mobile")))
        .where((F.col("route") == "phone") | (fold("email_addr") == F.col("key")))
        .select("id", "duplicate", *sale_cols)
    )
    matched = null_when(shown, F.col("duplicate"), [*SALE_TEXT], [*SALE_AMOUNTS]).select("id", *sale_cols)
    return leads.join(matched.distinct(), "id", "left").select(*LEAD, *sale_cols)


def lead_history(matched: DataFrame, history: DataFrame, as_of: DateLike) -> DataFrame:
    """Rows to add to the lead history: hit flags, and the image date they belong to.

    A lead already on file with a sale keeps its latest image date, others get the run date.
    ``matched`` comes from :func:`attribute_leads`; history has (id, leadid, createddate,
    pol_num, image_date). Write with ``write_partitions(.., by="image_date")``.
    """
    require(history, "history", "id", "leadid", "createddate", "pol_num", "image_date")
    lead_key = ["id", "leadid", "createddate"]
    on_file = (
        history.where(F.col("pol_num").isNotNull())
        .groupBy(*lead_key)
        .agg(F.max("image_date").alias("last_image"))
    )

    def hit(a: str, b: str):
        return yn(fold(a) == fold(b))

    flagged = matched.select(
        *LEAD,
        *[c for c in SALE_TEXT if c != "pol_iss_dt"],
        F.col("pol_iss_dt").alias("pol_eff_dt"),
        F.round("tot_ape", 2).alias("tot_ape"),
        F.round("nbv", 2).alias("nbv"),
        hit("lastname", "cli_nm").alias("name_hit_ind"),
        hit("phone", "mobl_phon_num").alias("phone_hit_ind"),
        hit("email", "email_addr").alias("email_hit_ind"),
    ).distinct()
    return (
        flagged.join(on_file, lead_key, "left")
        .withColumn("image_date", F.coalesce("last_image", F.lit(day(as_of))))
        .drop("last_image")
    )
