"""The straightforward form of four rewritten operators, to compare results and run time with.

Each function gives the same rows as the query it is named after, in the shape a report
writer would first put down: one query per bucket, per column, per window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import normalize_phone
from ..plans import values as v
from .entities import PREVIOUS_DATE, REPORT_DATE
from .registry import Tables
from .reports_ledger import snapshots


def status_movement(t: Tables) -> DataFrame:
    """One query per bucket, every one with scans and joins of its own."""
    prev, curr = snapshots(t)
    listed = F.col("plan_code_base") != v.EXCLUDED_PLAN
    now = curr.where(listed).select("pol_num", "pol_stat_cd", "pol_iss_dt")
    was = prev.where(listed).select("pol_num", F.col("pol_stat_cd").alias("was"))
    age = F.datediff(F.lit(PREVIOUS_DATE).cast("date"), "pol_iss_dt") / F.lit(365.25)

    def count(df: DataFrame, kind: str, sub: str = "") -> DataFrame:
        return df.agg(F.count("pol_num").alias("count_num")).select(
            F.lit(kind).alias("type"), F.lit(sub).alias("sub_type"), "count_num"
        )

    def moved(*statuses: str) -> DataFrame:
        before = was.where(F.col("was").isin(*v.IN_FORCE))
        return now.where(F.col("pol_stat_cd").isin(*statuses)).join(before, "pol_num")

    alive = now.where(F.col("pol_stat_cd").isin(*v.IN_FORCE))
    parts = [
        count(prev.where(listed & F.col("pol_stat_cd").isin(*v.IN_FORCE)), v.MOVE_OPENING),
        count(
            alive.join(was, "pol_num", "left").where(F.col("was").isNull() | F.col("was").isin(*v.PENDING)),
            v.MOVE_NEW,
        ),
        count(
            alive.join(was.where(~F.col("was").isin(*v.IN_FORCE, *v.PENDING)), "pol_num"), v.MOVE_REINSTATED
        ),
        count(alive, v.MOVE_CLOSING),
        count(
            curr.where((F.col("plan_code_base") == v.EXCLUDED_PLAN) & F.col("pol_stat_cd").isin(*v.IN_FORCE)),
            v.MOVE_CLOSING_EXCLUDED,
        ),
    ]
    for kind, statuses in v.MOVE_EXITS.items():
        if kind == v.MOVE_LAPSED:
            one, two, more = v.LAPSE_AGES
            lapsed = moved(*statuses)
            parts += [
                count(lapsed.where(age <= 1), kind, one),
                count(lapsed.where((age > 1) & (age <= 2)), kind, two),
                count(lapsed.where(age > 2), kind, more),
            ]
        else:
            parts.append(count(moved(*statuses), kind))
    return reduce(DataFrame.unionByName, parts).withColumn("image_date", F.lit(REPORT_DATE).cast("date"))


def unfold_phones(t: Tables) -> DataFrame:
    """One scan per phone column."""
    columns = ("mobl_phon_num", "prim_phon_num", "othr_phon_num")
    parts = [
        t.e_client.where(F.col(c).isNotNull()).select("cli_num", normalize_phone(c).alias("phone"))
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def newest_policy(t: Tables) -> DataFrame:
    """The newest date per owner joined back to the rows."""
    rows = t.e_policy_mart
    last = rows.groupBy("po_num").agg(F.max("pol_iss_dt").alias("pol_iss_dt"))
    return rows.join(last, ["po_num", "pol_iss_dt"]).groupBy("po_num", "pol_iss_dt").agg(
        F.max("pol_num").alias("pol_num")
    ).select("po_num", "pol_num", "pol_iss_dt")


def rolling_kpis(t: Tables) -> DataFrame:
    """One group-by per measure and window, joined on the agent."""
    rows = t.e_policy.join(t.e_policy_mart.select("pol_num", "po_num"), "pol_num").withColumn(
        "m", F.year("pol_iss_dt") * 12 + F.month("pol_iss_dt") - (2000 * 12 + 5) - 1
    )
    parts = []
    for label, months in (("last_mth", 1), ("last_yr", 12), ("last_3m", 3), ("last_6m", 6)):
        inside = rows.where(F.col("m").between(-months, -1)).groupBy("agt_code")
        parts.append(inside.agg(F.sum("mode_prem").cast("double").alias(f"{label}_ape")))
        parts.append(inside.agg(F.countDistinct("po_num").alias(f"{label}_cus")))
    return reduce(lambda a, b: a.join(b, "agt_code", "full_outer"), parts)


# Plain form against the registered query.
PAIRS = {
    "d24_status_movement": status_movement,
    "u02_unfold_phones": unfold_phones,
    "j17_newest_instead_of_join_back": newest_policy,
    "a28_rolling_kpis": rolling_kpis,
}
