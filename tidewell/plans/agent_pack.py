"""The agent pack: KPI matrix, ratios, mixes, claims, retention, risks, leads, pages, advice.

``fact`` is the result of ``coverage_fact``; ``agents`` that of ``agent_list`` (agt_cd, tier, ..).
All results have one row per agent in ``agt_cd`` unless stated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checks import require
from ..functions.amounts import argmax_name, mean_of, ratio, value_map
from ..functions.dates import (
    DateLike,
    day,
    day_shift,
    first_day_from_yyyymm,
    month_index,
    month_number,
    month_shift,
    tenure_text,
)
from ..functions.text import cut_percent
from ..operators.aggregates import Metric, count_if, densify, rolling_kpis, top_list_by
from ..operators.lineage import settle
from ..operators.partials import monthly_partials, rolling_from_partials
from ..operators.ranks import median_of, with_mean_rank, with_rank, with_standing
from ..operators.windows import latest_by, top_n_by
from . import values as v


def counted() -> Column:
    """Rows of policies that were taken up."""
    return ~F.col("pol_stat_cd").isin(*v.NOT_COUNTED)


def of_agents(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """Fact rows of the listed agents, keyed by ``agt_cd``."""
    return fact.withColumnRenamed("wa_cd_1", "agt_cd").join(agents.select("agt_cd"), "agt_cd", "left_semi")


def last_year() -> Column:
    return F.col("last_n_month_eff_cvg").between(-12, -1)


def agent_metrics() -> list[Metric]:
    """The twelve measures: ape, nbv, po, cus, pol, NT, rej, lap, prd, fam, rid, rep."""
    base = F.col("cvg_typ") == "B"
    return [
        Metric("ape", "sum", "adjust_ape", counted()),
        Metric("nbv", "sum", "nbv", counted()),
        Metric("po", "distinct", "po_num", counted()),
        Metric("cus", "distinct", "cli_num", counted()),
        Metric("pol", "distinct", "pol_num", base & counted()),
        Metric("NT", "distinct", "pol_num", base & (F.col("is_non_taken") == 1)),
        Metric("rej", "distinct", "pol_num", base & (F.col("rejected") == 1)),
        Metric("lap", "distinct", "pol_num", base & (F.col("lapsed") == 1), "last_n_month_end"),
        Metric("prd", "distinct", "type", counted()),
        Metric("fam", "distinct", "po_ins_rela", counted()),
        Metric("rid", "sum", "adjust_ape", counted() & (F.col("cvg_typ") == "R")),
        Metric("rep", "sum", "adjust_ape", counted() & (F.col("repeat_sales") == 1)),
    ]


def agent_kpis(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """:func:`agent_metrics` over the last 1, 12, 3 and 6 months: ``last_mth_ape`` .. ``last_6m_rep``.

    A measure is null where the agent has no row for it in the window.
    """
    return rolling_kpis(of_agents(fact, agents), "agt_cd", "last_n_month_eff_cvg", agent_metrics())


def agent_partials(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """The measures' monthly partials, to be stored by month; sales by their month, lapses by that of the end."""
    metrics = [replace(m, month="end_month" if m.month else None) for m in agent_metrics()]
    return monthly_partials(of_agents(fact, agents), "agt_cd", "cvg_month", metrics)


def kpis_from_partials(partials: DataFrame, as_of: DateLike) -> DataFrame:
    """:func:`agent_kpis` from stored :func:`agent_partials`, for windows that end in the month of ``as_of``."""
    return rolling_from_partials(partials, "agt_cd", month_number(day(as_of)), agent_metrics())


LABELS = ("last_mth", "last_yr", "last_3m", "last_6m")


def agent_ratios(kpis: DataFrame, *, matching_window: bool = False) -> DataFrame:
    """The KPI matrix with twenty ratios added.

    Premium per policy and per owner in each window; one less the share of not-taken,
    rejected and lapsed policies, 1 where there is nothing to divide. The shares of all
    windows are of the 3-month policy count, unless ``matching_window`` is set.
    """
    out = {}
    for w in LABELS:
        out[f"{w}_pol_size"] = ratio(f"{w}_ape", f"{w}_pol")
        out[f"{w}_po_size"] = ratio(f"{w}_ape", f"{w}_po")
    for m in ("NT", "rej", "lap"):
        for w in LABELS:
            base = f"{w}_pol" if matching_window else "last_3m_pol"
            out[f"{w}_{m}_per"] = F.coalesce(1 - ratio(f"{w}_{m}", base), F.lit(1.0))
    return kpis.withColumns(out)


def sales_mix(fact: DataFrame, agents: DataFrame, *, by: str = "month") -> DataFrame:
    """Last year's premium of each agent per month or product type, against all agents.

    ``by='month'``: (agt_cd, date, avg_ape_agt, avg_ape_tier, current_tier), months without
    sales as 0 and counted in the mean. ``by='type'``: (agt_cd, prd_type, sum_ape_agt,
    sum_ape_tier, current_tier).
    """
    if by not in ("month", "type"):
        raise ValueError(f"by is 'month' or 'type', not {by}")
    rows = of_agents(fact, agents).where(last_year() & counted())
    if by == "month":
        rows = rows.select("agt_cd", F.date_format("cvg_eff_dt", "yyyy-MM").alias("date"), "adjust_ape")
        own = densify(rows, "agt_cd", "date", "adjust_ape", 0)
        everyone = own.groupBy("date").agg(mean_of("adjust_ape").cast("bigint").alias("avg_ape_tier"))
        return own.join(everyone, "date").select(
            "agt_cd",
            "date",
            F.col("adjust_ape").alias("avg_ape_agt"),
            "avg_ape_tier",
            F.lit(v.BASE_TIER).alias("current_tier"),
        )
    rows = rows.select("agt_cd", F.col("type").alias("prd_type"), "adjust_ape")
    own = densify(rows, "agt_cd", "prd_type", "adjust_ape", 0)
    everyone = own.groupBy("prd_type").agg(F.sum("adjust_ape").alias("sum_ape_tier"))
    return own.join(everyone, "prd_type").select(
        "agt_cd",
        "prd_type",
        F.col("adjust_ape").alias("sum_ape_agt"),
        "sum_ape_tier",
        F.lit(v.BASE_TIER).alias("current_tier"),
    )


def claim_kpis(claims: DataFrame, fact: DataFrame, as_of: DateLike) -> DataFrame:
    """Claims on each agent's policies: three-year counts and amounts, one-year open claims.

    claims (clm_id, pol_num, clm_recv_dt, clm_stat_code, clm_prvd_amt, clm_aprov_amt); amounts
    are stored in thousands.
    """
    require(claims, "claims", "clm_id", "pol_num", "clm_recv_dt", "clm_stat_code")
    run = day(as_of)
    seller = fact.select("pol_num", F.col("wa_cd_1").alias("agt_cd")).distinct()
    recent = claims.where(
        F.col("clm_recv_dt").between(F.lit(month_shift(run, -36)), F.lit(run))
    ).join(seller, "pol_num")
    approved = F.col("clm_stat_code") == "A"
    open_1y = (F.col("clm_stat_code") == "I") & (F.col("clm_recv_dt") >= F.lit(month_shift(run, -12)))
    # A claim counts once per agent however many rows it has; amounts count per row.
    per_claim = recent.groupBy("agt_cd", "clm_id").agg(
        F.max(F.coalesce(approved, F.lit(False))).alias("approved"),
        F.max(F.coalesce(open_1y, F.lit(False))).alias("open_1y"),
        F.sum(F.col("clm_prvd_amt") * 1000).alias("amt"),
        F.sum(F.when(approved, F.col("clm_aprov_amt") * 1000)).alias("approved_amt"),
    )

    def amount(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return (
        per_claim.groupBy("agt_cd")
        .agg(
            F.count("clm_id").alias("claim_cnt_last_3_yr"),
            amount("amt").alias("claim_amt_last_3_yr"),
            count_if(F.col("approved"), "clm_id").alias("claim_appr_cnt_last_3_yr"),
            amount("approved_amt").alias("claim_appr_amt_last_3_yr"),
            count_if(F.col("open_1y"), "clm_id").alias("claim_wip_last_1_yr"),
        )
        .withColumns(
            {
                "claim_appr_rate_last_3_yr": ratio("claim_appr_cnt_last_3_yr", "claim_cnt_last_3_yr"),
                "chart": F.lit("3yr_claim"),
                "chart_kpi": F.lit("pol_cnt_or_amt"),
            }
        )
    )


def retention(
    fact: DataFrame,
    agents: DataFrame,
    external: DataFrame | None = None,
    *,
    months: Sequence[int] = (14, 20, 26),
) -> DataFrame:
    """Share of base policies kept past each number of months, and last year's not-taken rate.

    ``external`` (agt_cd, m19_per in percent) adds the 19-month figure measured elsewhere.
    Columns follow the month counts: lap_14m_pol, per_14m, ..
    """
    rows = of_agents(fact, agents).where(F.col("cvg_typ") == "B")
    kept = F.col("end_month") - F.col("pol_month")
    # One row per policy, so that no distinct pass is needed.
    per_policy = rows.groupBy("agt_cd", "pol_num").agg(
        F.max(counted()).alias("counted"),
        *[
            F.max(
                F.coalesce((F.col("lapsed") == 1) & kept.between(0, n), F.lit(False))
            ).alias(f"lap_{n}")
            for n in months
        ],
        F.max(last_year()).alias("in_year"),
        F.max(last_year() & (F.col("is_non_taken") == 1)).alias("refused"),
    )
    totals = per_policy.groupBy("agt_cd").agg(
        count_if(F.col("counted")).alias("all_pol_cnt"),
        *[count_if(F.col(f"lap_{n}")).alias(f"lap_{n}m_pol") for n in months],
        count_if(F.col("in_year")).alias("year_pol"),
        count_if(F.col("refused")).alias("year_refused"),
    )
    out = totals.withColumns(
        {f"per_{n}m": 1 - ratio(f"lap_{n}m_pol", "all_pol_cnt") for n in months}
        | {
            "nt_rate_12m": F.coalesce(ratio("year_refused", "year_pol"), F.lit(0.0)),
            "chart": F.lit("lapse_kpi"),
            "chart_kpi": F.lit("pol_cnt"),
        }
    ).drop("year_pol", "year_refused")
    if external is None:
        return out
    figure = external.select("agt_cd", (F.col("m19_per").cast("int") / 100).alias("per_19m_external"))
    return out.join(figure, "agt_cd", "left")


def policy_facts(fact: DataFrame) -> DataFrame:
    """One row per policy of the fact: agent, owner, dates, payment mode, base product type."""
    return fact.groupBy("pol_num").agg(
        F.max("wa_cd_1").alias("agt_cd"),
        F.max("po_num").alias("po_num"),
        F.max("pol_eff_dt").alias("pol_eff_dt"),
        F.max("pd_to_dt").alias("pd_to_dt"),
        F.max("pmt_mode_map").alias("pmt_mode"),
        F.max(F.when(F.col("cvg_typ") == "B", F.col("type"))).alias("type"),
    )


def lapse_risks(
    scores: DataFrame,
    fact: DataFrame,
    clients: DataFrame,
    as_of: DateLike,
    snapshot: str,
    *,
    n: int = 10,
    least: float = 0.05,
) -> DataFrame:
    """The ``n`` policies of each agent most likely to lapse, paid up to this year or later.

    scores (pol_num, month_snapshot, lapse_score), clients (cli_num, cli_nm).
    """
    named = clients.select(F.col("cli_num").alias("po_num"), "cli_nm")
    at_risk = (
        scores.where((F.col("month_snapshot") == snapshot) & (F.col("lapse_score") >= least))
        .select("pol_num", "lapse_score")
        .join(policy_facts(fact), "pol_num")
        .where(F.year("pd_to_dt") >= day(as_of).year)
    )
    top = top_n_by(at_risk, ["agt_cd"], [F.col("lapse_score").desc(), F.col("pol_num")], n)
    return top.join(named, "po_num", "left").select(
        "agt_cd", "pol_num", "po_num", "cli_nm", "pmt_mode", "lapse_score", "pol_eff_dt", "pd_to_dt"
    )


def top_policies(rows: DataFrame, score: str, n: int = 3) -> DataFrame:
    """Per agent, the policy numbers of its ``n`` best rows as an ordered array."""
    return top_list_by(rows, ["agt_cd"], [F.col(score).desc(), F.col("pol_num")], "pol_num", n, "pol_num")


SCORE_COLUMNS = ("health_base", "inv_base", "health_rider", "riders")


def next_leads(
    scores: DataFrame,
    products: DataFrame,
    fact: DataFrame,
    agents: DataFrame,
    links: DataFrame,
    image_date: DateLike,
    *,
    n: int = 10,
    least: float = 0.1,
) -> DataFrame:
    """The ``n`` owners of each agent most likely to buy again, with product marks.

    scores (po_num, image_date, p_1), products (po_num, deployment_approval_status and four
    scores: health_base, inv_base, health_rider, riders), links (pol_num, cli_num, link_typ,
    rec_status). ``*`` marks the investment product if it scores best and any other that
    scores above ``least``. Owners without product scores or policies are left out after the
    first cut.
    """
    seller = fact.where(F.col("po_num").isNotNull()).groupBy("po_num").agg(F.max("wa_cd_1").alias("agt_cd"))
    mine = (
        scores.where(F.col("image_date") == F.lit(day(image_date)))
        .select("po_num", "p_1")
        .join(seller, "po_num")
        .join(agents.select("agt_cd"), "agt_cd", "left_semi")
    )
    order = [F.col("p_1").desc(), F.col("po_num")]
    first_cut = top_n_by(mine, ["agt_cd"], order, n)

    def mark(test: Column) -> Column:
        return F.when(test, "*").otherwise("")

    marks = (
        products.where(F.col("deployment_approval_status") == "APPROVED")
        .withColumn("which_prd", argmax_name(SCORE_COLUMNS))
        .select(
            "po_num",
            "which_prd",
            mark(F.col("health_base") > least).alias("health_base"),
            mark(F.col("which_prd") == "inv_base").alias("inv_base"),
            mark(F.col("health_rider") > least).alias("health_rider"),
            mark(F.col("riders") > least).alias("riders"),
        )
    )
    owners = links.where((F.col("link_typ") == "O") & (F.col("rec_status") == "A"))
    newest = owners.groupBy(F.col("cli_num").alias("po_num")).agg(F.max("pol_num").alias("pol_num"))
    rows = (
        first_cut.join(marks.where(F.col("which_prd").isNotNull()), "po_num")
        .join(newest, "po_num")
        .select("agt_cd", "po_num", "pol_num", *SCORE_COLUMNS, "p_1")
    )
    return top_n_by(rows, ["agt_cd"], order, n)


def next_tier(tier: str = "tier") -> Column:
    return value_map(tier, v.NEXT_TIER)


def tier_target(tier: Column) -> Column:
    return value_map(tier, v.TIER_TARGETS).cast("bigint")


def qualification(agents: DataFrame, allowances: DataFrame) -> DataFrame:
    """Agents with allowance and the months they qualified in and are checked next.

    allowances (agt_cd, monthly_allowance in thousands, qualify_date as yyyyMM text). Agents
    without a date get the latest one; the next check is eleven months on.
    """
    own = latest_by(
        allowances.select(
            "agt_cd",
            (F.coalesce(F.col("monthly_allowance").cast("bigint"), F.lit(0)) * 1000).alias("monthly_allowance"),
            first_day_from_yyyymm("qualify_date").alias("qualified"),
        ),
        ["agt_cd"],
        [F.col("qualified").desc(), F.col("monthly_allowance").desc()],
    )
    listed = agents.join(own, "agt_cd", "left").withColumn(
        "monthly_allowance", F.coalesce("monthly_allowance", F.lit(0))
    )
    latest = listed.agg(F.max("qualified")).scalar()
    filled = listed.withColumn("__latest", latest).withColumn(
        "qualified", F.coalesce("qualified", "__latest")
    )
    return filled.withColumns(
        {
            "qualify_date": F.date_format("qualified", "yyyy-MM"),
            "next_qualify_check": F.date_format(F.add_months("qualified", 11), "yyyy-MM"),
        }
    ).drop("__latest")


def agent_page1(qualified: DataFrame, fact: DataFrame, as_of: DateLike) -> DataFrame:
    """First page: next tier and its target, tenure, allowance standing, report-month premium and rank.

    ``qualified`` from :func:`qualification`. The premium rank is among all agents of the
    fact; ties get the mean of their places, cut to an integer.
    """
    run = day(as_of)
    month = fact.where(F.col("last_n_month_eff_cvg") == -1).groupBy(F.col("wa_cd_1").alias("agt_cd")).agg(
        F.sum("adjust_ape").alias("last_mth_ape")
    )
    ranked = with_mean_rank(month, "last_mth_ape", "rank_of_last_mth_ape")
    page = qualified.join(ranked, "agt_cd", "left").withColumns(
        {
            "report_month": F.lit(run.strftime("%Y-%m")),
            "qualify_tenure": F.lit(month_number(run)) - month_index("qualified") + 1,
            "last_mth_ape": F.coalesce("last_mth_ape", F.lit(0)),
            "next_tier": next_tier(),
            "next_tier_benchmark": tier_target(next_tier()),
            "tenure_ym": tenure_text("tenure_mth"),
        }
    )
    return with_standing(page, "monthly_allowance", "monthly_allowance_rank").drop("qualified")


PAGE2 = ("last_3m_pol", "last_3m_ape", "last_3m_lap", "last_3m_rep", "last_3m_rid", "last_3m_po")


def agent_page2(kpis: DataFrame, tiers: DataFrame) -> DataFrame:
    """Second page: the agent's 3-month figures beside the means of its tier, the next tier and all.

    ``kpis`` with ratios, ``tiers`` (agt_cd, tier). Means are over agents, missing as 0;
    group sizes per owner are ratios of the group's sums.
    """
    sizes = ("last_3m_pol_size", "last_3m_po_size")
    own = kpis.select(
        "agt_cd", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in PAGE2], *sizes
    ).join(tiers.select("agt_cd", "tier"), "agt_cd", "left")
    own = own.withColumn("tier", F.coalesce("tier", F.lit(v.BASE_TIER))).withColumns(
        {"current_tier": F.col("tier"), "next_tier": next_tier()}
    )
    own = settle(own)
    premium, riders, owners = F.sum("last_3m_ape"), F.sum("last_3m_rid"), F.sum("last_3m_po")

    def means(prefix: str) -> list[Column]:
        return [
            *[mean_of(c).alias(f"{prefix}_{c}") for c in PAGE2],
            ratio(premium - riders, owners).alias(f"{prefix}_last_3m_pol_size"),
            ratio(premium, owners).alias(f"{prefix}_last_3m_po_size"),
        ]

    by_tier = own.groupBy("tier").agg(*means("current"))
    by_next = by_tier.toDF("next_tier", *[c.replace("current_", "next_", 1) for c in by_tier.columns[1:]])
    by_tier = by_tier.withColumnRenamed("tier", "current_tier")
    # One row over all agents, attached as a scalar.
    all_columns = [c for c in by_tier.columns if c != "current_tier"]
    everyone = own.agg(*means("platinum")).select(F.struct("*").alias("s")).scalar()
    wide = (
        own.join(by_tier, "current_tier", "left")
        .join(by_next, "next_tier", "left")
        .withColumn("__all", everyone)
    )
    names = [c.replace("current_", "platinum_", 1) for c in all_columns]
    return wide.withColumns({c: F.col("__all")[c] for c in names}).drop("__all")


# Advice texts by language and rule; {0} and {1} take the agent's and the group's figure.
ADVICE_TEXT = {
    "en": {
        "praise": ("Strong quarter.", "Premium is on target.", "Next check: {0}.", "See the customer lists."),
        "open": ("Premium is under target. Where to look:",),
        "riders": ("Rider share {0}, group {1}.",),
        "repeat": ("Repeat share {0}, group {1}.",),
        "size": ("Average case {0}M, group {1}M.",),
        "family": ("Kinds of relatives insured: {0}, group {1}.",),
        "quality": ("Lapsed after a year: {0}, group {1}.",),
        "fill": ("Review this with a manager.", "Pick a course.", "Set a date for the next review."),
        "missed": ("{0}: no premium in this quarter.", "The membership goes on.", "Ask a manager for a plan.", "See the customer lists."),
    },
    "vi": {
        "praise": ("Quý tốt.", "Doanh số đạt mục tiêu.", "Kỳ xét tới: {0}.", "Xem danh sách khách hàng."),
        "open": ("Doanh số dưới mục tiêu. Nên xem:",),
        "riders": ("Tỷ lệ bổ trợ {0}, nhóm {1}.",),
        "repeat": ("Tỷ lệ khách cũ {0}, nhóm {1}.",),
        "size": ("Hợp đồng trung bình {0} triệu, nhóm {1} triệu.",),
        "family": ("Số loại người thân: {0}, nhóm {1}.",),
        "quality": ("Mất hiệu lực sau một năm: {0}, nhóm {1}.",),
        "fill": ("Xem báo cáo với quản lý.", "Chọn một khóa học.", "Hẹn lần xem tới."),
        "missed": ("{0}: quý này chưa có doanh số.", "Danh hiệu vẫn còn.", "Hỏi quản lý về kế hoạch.", "Xem danh sách khách hàng."),
    },
}


def _say(template: str, *figures: Column) -> Column:
    """The template with its figures put in."""
    parts, rest = [], template
    for i, figure in enumerate(figures):
        before, found, rest = rest.partition("{%d}" % i)
        parts.append(F.lit(before))
        if found:
            parts.append(F.coalesce(figure, F.lit("")))
    return F.concat(*parts, F.lit(rest)) if parts else F.lit(rest)


def advice(
    kpis: DataFrame, kept: DataFrame, agents: DataFrame, *, lang: str = "en", text: dict | None = None
) -> DataFrame:
    """Exactly four messages for every agent: praise, up to three hints, or a call to return.

    ``kpis`` with ratios, ``kept`` from :func:`retention`, ``agents`` (agt_cd, agt_nm, tier,
    next_qualify_check). Figures of the group are shares of summed premium, the mean 3-month
    case, and medians of relation kinds and of 14-month retention. A missing figure never
    triggers its hint. ``text`` replaces the texts of the language.
    """
    words = text or ADVICE_TEXT[lang]
    kpis, kept = settle(kpis), settle(kept)
    benchmark = (
        kpis.agg(
            ratio(F.sum("last_3m_rid"), F.sum("last_3m_ape")).alias("riders"),
            ratio(F.sum("last_3m_rep"), F.sum("last_3m_ape")).alias("repeat"),
            F.expr("avg(last_3m_pol_size)").alias("size"),
        )
        .withColumn("family", median_of(kpis, "last_3m_fam"))
        .select(F.struct("*").alias("s"))
        .scalar()
    )
    kept_median = median_of(kept, "per_14m")
    rows = (
        agents.select("agt_cd", "agt_nm", "tier", "next_qualify_check")
        .join(kpis, "agt_cd", "left")
        .join(kept.select("agt_cd", "per_14m"), "agt_cd", "left")
        .withColumns({"__b": benchmark, "__kept": kept_median})
    )
    b = F.col("__b")
    premium, policies = F.coalesce("last_3m_ape", F.lit(0)), F.coalesce("last_3m_pol", F.lit(0))
    zero = F.lit(0)
    riders = ratio(F.coalesce("last_3m_rid", zero), "last_3m_ape")
    repeat = ratio(F.coalesce("last_6m_rep", zero), "last_6m_ape")
    size, family = F.col("last_6m_pol_size"), F.col("last_6m_fam")
    millions = ((size / 100000).cast("int") / 10).cast("decimal(12,1)").cast("string")
    hints = [
        (
            riders <= b["riders"] - 0.1,
            _say(words["riders"][0], cut_percent(riders), cut_percent(b["riders"])),
        ),
        (
            repeat <= b["repeat"] - 0.1,
            _say(words["repeat"][0], cut_percent(repeat), cut_percent(b["repeat"])),
        ),
        (
            size <= b["size"] * 0.7,
            _say(words["size"][0], millions, (b["size"] / 1000000).cast("int").cast("string")),
        ),
        (
            family < b["family"],
            _say(words["family"][0], family.cast("int").cast("string"), b["family"].cast("int").cast("string")),
        ),
        (
            F.col("per_14m") <= F.col("__kept") - 0.1,
            _say(words["quality"][0], cut_percent(1 - F.col("per_14m")), cut_percent(1 - F.col("__kept"))),
        ),
    ]
    fill = [F.lit(t) for t in words["fill"]]
    ideas = F.slice(
        F.array_compact(F.array(F.lit(words["open"][0]), *[F.when(t, m) for t, m in hints], *fill)), 1, 4
    )
    praise = F.array(*[_say(t, F.col("next_qualify_check")) for t in words["praise"]])
    missed = F.array(*[_say(t, F.col("agt_nm")) for t in words["missed"]])
    messages = (
        F.when(premium / 3 >= v.QUALIFY_PREMIUM / 12, praise)
        .when((premium / 3 > 0) & (policies > 0), ideas)
        .otherwise(missed)
    )
    listed = rows.withColumn("diag_list", messages)
    return listed.select(
        "agt_cd",
        F.col("tier").alias("level"),
        F.col("agt_nm").alias("agt_name"),
        "diag_list",
        *[F.element_at("diag_list", i + 1).alias(f"diag_{i}") for i in range(4)],
    )


def agent_overview(
    fact: DataFrame, qualified: DataFrame, as_of: DateLike, *, link: str | None = None
) -> DataFrame:
    """Overview: totals since qualification, lifetime totals, best month and case, gap to the next tier.

    ``qualified`` from :func:`qualification`. All listed agents appear; the counts since
    qualification are 0 where there is nothing, other figures null.
    """
    run = day(as_of)
    start = qualified.select("agt_cd", month_index("qualified").alias("qualify_month"))
    rows = of_agents(fact, qualified).where(F.col("cvg_eff_dt") <= F.lit(run)).join(start, "agt_cd")
    taken = rows.where(counted())
    since = F.col("cvg_month") >= F.col("qualify_month")
    base = F.col("cvg_typ") == "B"
    # Per policy and month once; every figure but the distinct owners follows from it.
    cells = taken.groupBy("agt_cd", "pol_num", "cvg_month").agg(
        F.sum("adjust_ape").alias("ape"),
        F.sum(F.when(since, F.col("adjust_ape"))).alias("ape_since"),
        F.max(since & base).alias("base_since"),
        F.max(since).alias("since"),
        F.max("po_num").alias("po_num"),
    )
    months = cells.groupBy("agt_cd", "cvg_month").agg(
        F.sum("ape").alias("ape"), F.sum("ape_since").alias("ape_since"), F.max("since").alias("since")
    )
    by_month = months.groupBy("agt_cd").agg(
        F.sum("ape_since").alias("ape_since_qualify"),
        count_if(F.col("since")).alias("active_month"),
        F.max("ape").alias("best_month"),
        F.max_by("cvg_month", F.struct(F.col("ape"), -F.col("cvg_month"))).alias("which"),
        F.sum("ape").alias("total_ape"),
        F.sum(F.when(F.col("cvg_month") > month_number(run) - run.month, F.col("ape"))).alias("ape_this_year"),
    )
    by_policy = (
        cells.groupBy("agt_cd", "pol_num")
        .agg(F.sum("ape").alias("case_ape"), F.max("base_since").alias("base_since"))
        .groupBy("agt_cd")
        .agg(
            count_if(F.col("base_since")).alias("pol_since_qualify"),
            F.max("case_ape").alias("best_case"),
        )
    )
    active = (F.col("pol_stat_cd") == "1") & F.col("pol_trmn_dt").isNull()
    by_owner = (
        rows.groupBy("agt_cd", "po_num")
        .agg(F.max(counted()).alias("taken"), F.max(active).alias("active"))
        .groupBy("agt_cd")
        .agg(
            F.when(count_if(F.col("taken")) > 0, count_if(F.col("taken"))).alias("total_custm"),
            F.when(count_if(F.col("active")) > 0, count_if(F.col("active"))).alias("active_custm"),
        )
    )
    # month_index of December is a multiple of 12
    which = F.format_string("%d-%02d", F.floor((F.col("which") - 1) / 12), F.pmod(F.col("which") - 1, F.lit(12)) + 1)
    wide = (
        qualified.select("agt_cd", "agt_nm", "agt_join_dt", "tier")
        .join(by_month, "agt_cd", "left")
        .join(by_policy, "agt_cd", "left")
        .join(by_owner, "agt_cd", "left")
    )
    gap = F.col("next_tier_benchmark") - F.coalesce("ape_this_year", F.lit(0))
    fixed = {
        "qualify_ape_min": 0,
        "qualify_ape_target": v.QUALIFY_PREMIUM,
        "qualify_ape_max": v.QUALIFY_PREMIUM,
        "qualify_pol_min": 0,
        "qualify_pol_target": v.QUALIFY_POLICIES,
        "qualify_pol_max": v.QUALIFY_POLICIES,
        "qualify_act_mth_min": 0,
        "qualify_act_target": v.QUALIFY_ACTIVE_MONTHS,
        "qualify_act_max": 12,
    }
    return (
        wide.withColumns(
            {
                "ape_since_qualify": F.coalesce("ape_since_qualify", F.lit(0)),
                "pol_since_qualify": F.coalesce("pol_since_qualify", F.lit(0)),
                "active_month": F.coalesce("active_month", F.lit(0)),
                "which_month_max": F.when(F.col("which").isNotNull(), which),
                "max_mth_ape": F.col("best_month"),
                "link_url": F.lit(link).cast("string"),
                "next_tier": next_tier(),
                "next_tier_benchmark": tier_target(next_tier()),
            }
            | {name: F.lit(value) for name, value in fixed.items()}
        )
        .withColumn("gap_to_next_tier", F.greatest(gap, F.lit(0)))
        .drop("which")
    )


def premium_rank(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """Rank of the report month's premium among all agents of the fact, and its share of ``agents``.

    ``agents`` is the list whose size the rank is divided by.
    """
    month = fact.where(F.col("last_n_month_eff_cvg") == -1).groupBy(F.col("wa_cd_1").alias("agt_cd")).agg(
        F.sum("adjust_ape").alias("premium")
    )
    total = agents.agg(F.count(F.lit(1))).scalar()
    return (
        with_rank(month, "premium", "rank_fyp_last_mth")
        .withColumn("total_inforce_agt", total)
        .withColumn("rank_per_fyp_last_mth", ratio("rank_fyp_last_mth", "total_inforce_agt"))
        .drop("premium")
    )


def title_dates(members: DataFrame, as_of: DateLike) -> DataFrame:
    """The agent selection list with the date its report is titled by, 15 days on."""
    return members.select(F.col("agt_cd").alias("agt"), F.lit(day_shift(as_of, 15)).alias("title_month"))
