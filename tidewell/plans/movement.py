"""Status movement of policies between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.dates import DateLike, day
from . import values as v

SNAPSHOT = ("pol_num", "plan_code_base", "pol_stat_cd", "pol_iss_dt")


def bucket_labels() -> list[tuple[str, str]]:
    """All (type, sub_type) lines of the report, in report order."""
    lines = []
    for name in (
        v.MOVE_OPENING,
        v.MOVE_NEW,
        v.MOVE_REINSTATED,
        *v.MOVE_EXITS,
        v.MOVE_CLOSING,
        v.MOVE_CLOSING_EXCLUDED,
    ):
        subs = v.LAPSE_AGES if name == v.MOVE_LAPSED else ("",)
        lines += [(name, sub) for sub in subs]
    return lines


def status_movement(
    prev: DataFrame,
    curr: DataFrame,
    prev_date: DateLike,
    curr_date: DateLike,
    excluded_plan: str = v.EXCLUDED_PLAN,
) -> DataFrame:
    """Policies per movement bucket from opening to closing balance, empty buckets as 0.

    Both snapshots have (pol_num, plan_code_base, pol_stat_cd, pol_iss_dt), one row per
    policy; month end against today works as well as month end against month end. Policies
    without a plan count nowhere. Columns: type, sub_type, count_num, image_date.

    Both snapshots meet once in a full outer join on the policy; each pair then names the
    buckets it counts in, and counts are pre-summed before the second, tiny shuffle.
    """
    require(prev, "prev", "pol_num", "plan_code_base", "pol_stat_cd")
    require(curr, "curr", *SNAPSHOT)
    before = prev.where(F.col("plan_code_base") != excluded_plan).select(
        "pol_num", F.col("pol_stat_cd").alias("prev_stat"), F.lit(True).alias("had")
    )
    now = curr.select(
        "pol_num",
        F.col("pol_stat_cd").alias("curr_stat"),
        F.col("pol_iss_dt"),
        (F.col("plan_code_base") == excluded_plan).alias("excluded"),
    ).where(F.col("excluded").isNotNull())

    opened = F.coalesce(F.col("prev_stat").isin(*v.IN_FORCE), F.lit(False))
    was_pending = F.col("prev_stat").isin(*v.PENDING)
    was_closed = ~F.col("prev_stat").isin(*v.IN_FORCE, *v.PENDING)
    alive = F.col("curr_stat").isin(*v.IN_FORCE)
    listed = F.coalesce(~F.col("excluded"), F.lit(False))
    age = F.datediff(F.lit(day(prev_date)), F.col("pol_iss_dt")) / F.lit(365.25)
    one, two, more = v.LAPSE_AGES
    lapse_age = F.when(age <= 1, one).when((age > 1) & (age <= 2), two).otherwise(more)

    def line(name: str, test, sub=F.lit("")):
        return F.when(test, F.struct(F.lit(name).alias("type"), sub.alias("sub_type")))

    lines = [
        line(v.MOVE_OPENING, opened),
        line(v.MOVE_NEW, listed & alive & (F.col("had").isNull() | was_pending)),
        line(v.MOVE_REINSTATED, listed & alive & was_closed),
        line(v.MOVE_CLOSING, listed & alive),
        line(v.MOVE_CLOSING_EXCLUDED, F.col("excluded") & alive),
    ]
    for name, statuses in v.MOVE_EXITS.items():
        sub = lapse_age if name == v.MOVE_LAPSED else F.lit("")
        lines.append(line(name, listed & opened & F.col("curr_stat").isin(*statuses), sub))

    # A policy of the excluded plan must not meet its own earlier, listed self.
    side = F.coalesce(F.col("excluded"), F.lit(False))
    pairs = before.withColumn("side", F.lit(False)).join(
        now.withColumn("side", side), ["pol_num", "side"], "full_outer"
    )
    counts = (
        pairs.select(F.explode(F.array_compact(F.array(*lines))).alias("l"))
        .groupBy("l.type", "l.sub_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spark = prev.sparkSession
    labels = spark.createDataFrame(bucket_labels(), "type string, sub_type string")
    return labels.join(counts, ["type", "sub_type"], "left").select(
        "type",
        "sub_type",
        F.coalesce("n", F.lit(0)).alias("count_num"),
        F.lit(day(curr_date)).alias("image_date"),
    )
