"""Ledger, cash and reconciliation reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.dates import DateLike, day, day_shift, month_end, month_shift
from ..operators.aggregates import debit_credit_net, signed_sum, sum_if
from ..operators.joins import lookup_first
from ..operators.sets import net_of, stack
from . import values as v

LEDGER = ("acct_num", "pol_num", "extract_typ", "cr_or_dr", "acct_gen_amt", "trxn_dt")
POLICY_TERMS = (
    "plan_code_base", "pol_eff_dt", "pd_to_dt", "last_pd_to_dt", "last_avy_dt", "pmt_mode",
    "mode_prem", "pol_stat_cd", "wrk_area",
)
COVERAGE_TERMS = ("face_amt", "prem_dur", "xpry_dt")


def account_balance(
    current: DataFrame,
    history: DataFrame,
    old: DataFrame,
    policies: DataFrame,
    coverages: DataFrame,
    as_of: DateLike,
) -> DataFrame:
    """Open balance per account, policy and extract type with the policy's terms.

    Ledgers have (acct_num, pol_num, extract_typ, cr_or_dr, acct_gen_amt, trxn_dt); the
    current one counts up to the last month end. Zero balances are left out.

    Postings are netted per account and policy before they meet the policies, so the joins
    carry one row per balance, not one per posting.
    """
    require(policies, "policies", "pol_num", "vers_num_base", *POLICY_TERMS)
    booked = stack(
        [
            current.where(F.col("trxn_dt") <= F.lit(month_end(as_of, -1))).select(*LEDGER),
            history.select(*LEDGER),
            old.select(*LEDGER),
        ]
    )
    net = booked.groupBy("acct_num", "pol_num", "extract_typ").agg(
        signed_sum("acct_gen_amt", "cr_or_dr").alias("net"), F.max("trxn_dt").alias("last")
    )
    base = coverages.select(
        F.col("pol_num").alias("cvg_pol"), "plan_code", "vers_num", *COVERAGE_TERMS
    )
    return (
        net.join(policies.select("pol_num", "vers_num_base", *POLICY_TERMS), "pol_num", "left")
        .join(
            base,
            # The policy alone is the key: rows stay where the join before left them, the few coverages are compared there.
            (F.col("pol_num") == F.col("cvg_pol"))
            & F.col("plan_code_base").between(F.col("plan_code"), F.col("plan_code"))
            & F.col("vers_num_base").between(F.col("vers_num"), F.col("vers_num")),
            "left",
        )
        .groupBy("acct_num", "pol_num", "extract_typ", *POLICY_TERMS, *COVERAGE_TERMS)
        .agg(F.sum("net").alias("balance_amt"), F.max("last").alias("susp_dt"))
        .where(F.col("balance_amt") != 0)
    )


def ledger_summary(
    ledger: DataFrame,
    as_of: DateLike,
    types: Sequence[str] = v.LEDGER_TYPES,
    *,
    scale: int = 1000,
    ordered: bool = True,
) -> DataFrame:
    """Debit, credit and net per account, policy prefix and day of the year of ``as_of - 7``.

    Input: (acct_num, pol_num, cr_or_dr, acct_gen_amt, crcy_code, lob, wrk_area,
    acct_mne_cd, trxn_dt, extract_typ). Equal rows count once; amounts are stored in
    ``scale`` units.
    """
    require(ledger, "ledger", *LEDGER, "crcy_code", "lob", "wrk_area", "acct_mne_cd")
    year_start = date(day_shift(as_of, -7).year, 1, 1)
    keys = ["acct_num", "acct_mne_cd", "lob", "crcy_code", "pol_prefix", "wrk_area", "trxn_dt", "extract_typ"]
    result = (
        ledger.where(F.col("extract_typ").isin(*types) & (F.col("trxn_dt") >= F.lit(year_start)))
        .dropDuplicates()
        .withColumn("pol_prefix", F.substring(F.col("pol_num").cast("string"), 1, 3))
        .groupBy(*keys)
        .agg(*debit_credit_net("acct_gen_amt", "cr_or_dr", scale))
        .withColumn("reporting_date", F.last_day("trxn_dt"))
        .withColumn("crcy_code", F.when(F.col("crcy_code") == "90", "CNY").otherwise(F.col("crcy_code")))
    )
    return result.orderBy(*keys) if ordered else result


def par_split(amount: str) -> list:
    """The amount split by participation code; a missing code counts as 3."""
    code = F.col("par_code")
    return [
        sum_if(code == "0", amount).alias("par_code_0"),
        sum_if(code == "1", amount).alias("par_code_1"),
        sum_if(F.coalesce(code, F.lit("3")) == "3", amount).alias("par_code_3"),
        sum_if(code == "4", amount).alias("par_code_4"),
    ]


def collection_start(as_of: DateLike) -> date:
    """First day of the collection reports: the month end after the day following four months back."""
    return month_end(day_shift(month_shift(as_of, -4), 1))


def original_base(coverages: DataFrame) -> DataFrame:
    return coverages.where((F.col("cvg_typ") == "B") & (F.col("cvg_reasn") == "O"))


def collections(
    headers: DataFrame,
    details: DataFrame,
    coverages: DataFrame,
    policies: DataFrame,
    agents: DataFrame,
    batch_kinds: DataFrame,
    cheque_banks: DataFrame,
    auto_banks: DataFrame,
    accounts: DataFrame,
    as_of: DateLike,
) -> DataFrame:
    """Collected premium per receipt, split by participation, with the account it went to.

    Inputs: headers (trxn_dt, btch_num, btch_role, user_id, br_code, btch_typ, bank_code),
    details (trxn_dt, btch_num, btch_role, rep_num, pol_num, bank_cd, trxn_amt, trxn_cd),
    coverages (pol_num, plan_code, par_code, cvg_typ, cvg_reasn), policies (pol_num,
    agt_code), agents (agt_code, team_code), batch_kinds (fld_nm, fld_valu, fld_lkup_valu),
    cheque_banks and auto_banks (bank_cd, acct_mne_cd), accounts (acct_num, acct_mne_cd).
    """
    require(details, "details", "trxn_dt", "btch_num", "btch_role", "rep_num", "pol_num", "trxn_amt")
    start = F.lit(collection_start(as_of))
    batch = ["trxn_dt", "btch_num", "btch_role"]
    head = headers.where((F.col("trxn_dt") >= start) & (F.col("btch_role") == "C")).select(
        *batch, "user_id", "br_code", "btch_typ", "bank_code"
    )
    paid = details.where(
        (F.col("trxn_cd") == "COLECT") & (F.col("trxn_dt") >= start) & (F.col("btch_role") == "C")
    ).select(*batch, "rep_num", "pol_num", "bank_cd", "trxn_amt")
    receipts = (
        head.join(paid, batch)
        .join(original_base(coverages).select("pol_num", "plan_code", "par_code"), "pol_num", "left")
        .join(policies.select("pol_num", "agt_code"), "pol_num", "left")
        .join(agents.select("agt_code", "team_code"), "agt_code", "left")
        .groupBy(
            "trxn_dt",
            "rep_num",
            "pol_num",
            F.col("user_id").alias("nhothu_user"),
            F.col("br_code").alias("thu"),
            "btch_typ",
            F.coalesce("bank_code", "bank_cd").alias("bank_cd"),
            F.coalesce("plan_code", F.lit(v.NO_PLAN)).alias("prod_code"),
            "team_code",
        )
        .agg(
            F.sum("trxn_amt").alias("amt"),
            F.count("pol_num").alias("sophieu"),
            *par_split("trxn_amt"),
        )
    )
    kinds = batch_kinds.where(F.col("fld_nm") == "BTCH_TYP").select(
        F.col("fld_valu").alias("btch_typ"), F.col("fld_lkup_valu").alias("kind")
    )

    def bank_accounts(banks: DataFrame, out: str) -> DataFrame:
        known = banks.where(F.col("acct_mne_cd").isNotNull())
        return known.select("bank_cd", F.col("acct_mne_cd").alias(out)).distinct()

    has_bank = F.col("bank_cd").isNotNull()
    account_name = (
        F.when((F.col("kind") == "CS") & ~has_bank, v.CASH_ACCOUNT)
        .when(F.col("kind").isin("CS", "TF") & has_bank, F.col("cheque_name"))
        .when((F.col("kind") == "AUTO") & has_bank, F.col("auto_name"))
    )
    named = (
        receipts.join(kinds, "btch_typ", "left")
        .join(bank_accounts(cheque_banks, "cheque_name"), "bank_cd", "left")
        .join(bank_accounts(auto_banks, "auto_name"), "bank_cd", "left")
        .withColumn("account_name", account_name)
    )
    # An account is found by its own name, or by a bank that pays into it.
    numbers = accounts.select("acct_num", F.col("acct_mne_cd").alias("found_by")).unionByName(
        auto_banks.join(accounts, "acct_mne_cd").select("acct_num", F.col("bank_cd").alias("found_by"))
    )
    resolved = lookup_first(named, numbers, ["account_name", "bank_cd"], "found_by", "acct_num", "acct_num")
    return resolved.select(
        "trxn_dt", "rep_num", "pol_num", "nhothu_user", "thu", "btch_typ", "bank_cd", "acct_num",
        "prod_code", "team_code", "amt", "sophieu", "par_code_0", "par_code_1", "par_code_3",
        "par_code_4",
    )


def net_pickups(
    pickups: DataFrame,
    returns: DataFrame,
    coverages: DataFrame,
    policies: DataFrame,
    agents: DataFrame,
    as_of: DateLike,
) -> DataFrame:
    """Deposits less returns per day, branch, team and policy, split by participation.

    pickups and returns have (trxn_dt, br_code, pol_num, dnr_num, rec_typ, btch_typ,
    reasn_code, btch_stat_code, trxn_amt); a return is booked at the branch of its pick-up.
    """
    require(pickups, "pickups", "trxn_dt", "br_code", "pol_num", "dnr_num", "trxn_amt")
    cash = F.col("btch_typ").isin("CS", "AVCS") & F.col("reasn_code").isin("01", "02")
    counted = (
        cash
        & (F.col("rec_typ") == "D")
        & (F.col("btch_stat_code") == "C")
        & (F.col("trxn_dt") >= F.lit(collection_start(as_of)))
    )
    picked_at = pickups.where(cash).select("br_code", "dnr_num").distinct()
    entry = ["trxn_dt", "br_code", "pol_num", "trxn_amt"]
    back = returns.where(counted).drop("br_code").join(picked_at, "dnr_num")
    entries = net_of(pickups.where(counted).select(*entry), back.select(*entry), "trxn_amt")
    # Net per day, branch and policy first: the joins below only add attributes of the policy.
    daily = entries.groupBy("trxn_dt", "br_code", "pol_num").agg(F.sum("trxn_amt").alias("net"))
    return (
        daily.join(original_base(coverages).select("pol_num", "plan_code", "par_code"), "pol_num")
        .join(policies.select("pol_num", "agt_code"), "pol_num")
        .join(agents.select("agt_code", "team_code"), "agt_code")
        .groupBy("trxn_dt", "br_code", "team_code", "pol_num", "plan_code")
        .agg(F.sum("net").alias("amt"), *par_split("net"))
    )


def payment_reconciliation(
    headers: DataFrame,
    details: DataFrame,
    outstanding: DataFrame,
    online: DataFrame,
    applications: DataFrame,
    as_of: DateLike,
    *,
    days: int = 181,
    vendor_until: DateLike = v.VENDOR_RECEIPT_UNTIL,
) -> DataFrame:
    """Online payments of the last ``days`` days with the receipt number to reconcile on.

    Up to ``vendor_until``, and for vouchers, that is the vendor's number, then the own one.
    Inputs: headers (trxn_dt, btch_num, btch_role, btch_typ, user_id), details (trxn_dt,
    btch_num, btch_role, rep_num, pol_num, prod_cat, rep_typ, prem_stat, trxn_amt,
    reasn_code, bank_cd), outstanding (input_dt, pol_num, receipt_num, trxn_num, bank_cd,
    bank_ref, service_type, pmt_type), online (pol_num, receipt_num_vendor, trxn_num,
    status), applications (proposal_num, pol_num).
    """
    require(outstanding, "outstanding", "input_dt", "pol_num", "receipt_num", "trxn_num", "pmt_type")
    start = F.lit(day_shift(as_of, -days))
    recent = (F.col("trxn_dt") >= start) & (F.col("btch_role") == "C")
    batch = ["trxn_dt", "btch_num", "btch_role"]
    paid = details.where(recent & F.col("bank_cd").isin(*v.ONLINE_BANKS)).withColumnRenamed(
        "bank_cd", "paid_at"
    )
    open_items = outstanding.where(
        F.col("service_type").isin(*v.ONLINE_SERVICE_TYPES) & (F.col("input_dt") >= start)
    ).select(
        F.col("input_dt").alias("trxn_dt"),
        "pol_num",
        F.col("receipt_num").alias("rep_num"),
        F.col("pmt_type").alias("btch_typ"),
        "trxn_num",
        "bank_cd",
        "bank_ref",
        "service_type",
    )
    # A payment made on a proposal is known by the policy the proposal became.
    became = applications.select("proposal_num", F.col("pol_num").alias("app_pol"))
    vendor = (
        online.where(F.col("status") == "A")
        .join(became, F.col("pol_num") == F.col("proposal_num"), "left")
        .select(
            F.coalesce("app_pol", "pol_num").alias("pol_num"), "trxn_num", "receipt_num_vendor"
        )
    )
    voucher = F.col("paid_at") == v.VOUCHER_BANK
    by_vendor = voucher | (F.col("trxn_dt") <= F.lit(day(vendor_until)))
    return (
        headers.where(recent)
        .select(*batch, "btch_typ", "user_id")
        .join(paid, batch)
        .join(open_items, ["trxn_dt", "pol_num", "rep_num", "btch_typ"])
        .join(vendor, ["pol_num", "trxn_num"], "left")
        .select(
            "trxn_dt",
            "user_id",
            "rep_num",
            "pol_num",
            F.col("prod_cat").alias("product_type"),
            "rep_typ",
            "prem_stat",
            "trxn_amt",
            "reasn_code",
            "bank_cd",
            "bank_ref",
            "service_type",
            F.when(by_vendor, F.col("receipt_num_vendor")).otherwise(F.col("rep_num")).alias("trxn_id"),
            F.when(voucher, "Shopee").otherwise("SCB").alias("trxn_typ"),
        )
    )
