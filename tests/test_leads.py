"""Lead attribution against all pairs, with shared and empty contact keys."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidewell import plans
from tidewell.plans.leads import LEAD, SALE_TEXT

DAY = date(2024, 1, 1)


def norm(phone):
    kept = "".join(c for c in phone.strip() if c.isascii() and c.isalnum())
    return kept[-9:]


def given(spark):
    rng = random.Random(11)
    phones = ["0900000000", "", "--"] + [f"09{i:08d}" for i in range(12)]
    emails = [None, "a@x ", "B@x", "c@x"]
    leads, sales, clients, contacts = [], [], [], []
    for i in range(120):
        status = rng.choice(["new", "Duplicate lead", None])
        leads.append((f"L{i}", DAY + timedelta(days=rng.randrange(60)), rng.choice([None, *map(norm, phones)]), rng.choice(emails), status))
    for c in range(25):
        # a placeholder number is shared by many clients; some have no letters or digits at all
        clients.append((c, f"client {c}", rng.choice(phones[:3]), rng.choice([None, *phones]), rng.choice([None, *phones])))
        contacts.append((c, rng.choice([None, "A@X", "b@x", "d@x"])))
    for p in range(80):
        sales.append((p, rng.randrange(30), DAY + timedelta(days=rng.randrange(-20, 460)), rng.randrange(100)))
    lead_df = spark.createDataFrame(leads, "id string, createddate date, phone string, email string, status string")
    for c in LEAD:
        if c not in lead_df.columns:
            lead_df = lead_df.withColumn(c, F.lit("x"))
    sale_df = spark.createDataFrame(sales, "pol_num long, po_num long, pol_iss_dt date, tot_ape long").withColumn("nbv", F.col("tot_ape") * 2)
    for c in SALE_TEXT:
        if c not in ("cli_nm", "mobl_phon_num", "email_addr", *sale_df.columns):
            sale_df = sale_df.withColumn(c, F.lit("s"))
    client_df = spark.createDataFrame(clients, "cli_num long, cli_nm string, mobl_phon_num string, prim_phon_num string, othr_phon_num string")
    contact_df = spark.createDataFrame(contacts, "cli_num long, email_addr string")
    return (leads, sales, clients, dict(contacts)), (lead_df, sale_df, client_df, contact_df)


@pytest.mark.parametrize("issued", [False, True])
def test_attribution_matches_all_pairs(spark, issued):
    (leads, sales, clients, contacts), (lead_df, sale_df, client_df, contact_df) = given(spark)
    people = {c[0]: c for c in clients}
    want = set()
    for lead, created, phone, email, status in leads:
        found = set()
        for pol, owner, iss, ape in sales:
            if owner not in people:
                continue
            _, name, mobile, *others = people[owner]
            gap, address = (iss - created).days, contacts.get(owner)
            numbers = {norm(x) for x in (mobile, *others) if x is not None}
            if phone is not None and phone in numbers and 2 <= gap <= 180:
                found.add((pol, owner, name, phone, address, ape))
            if email and address and email.strip().upper() == address.strip().upper() and 2 <= gap <= 366:
                found.add((pol, owner, name, norm(mobile), address, ape))
        if status and "duplicate" in status.lower():
            found = {(None, None, None, None, None, 0)} if found else set()
        want |= {(lead, *f) for f in found} or {(lead, None, None, None, None, None, None)}
    more = {"issued": sale_df.select("pol_num", "po_num", "pol_iss_dt")} if issued else {}
    got = plans.attribute_leads(lead_df, sale_df, client_df, contact_df, **more)
    rows = got.select("id", "pol_num", "po_num", "cli_nm", "mobl_phon_num", "email_addr", "tot_ape").collect()
    assert len(rows) == len(want) and {tuple(r) for r in rows} == want
    assert any(r[4] == "900000000" for r in want) and any(r[4] == "" for r in want)
