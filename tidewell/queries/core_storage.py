"""Stored forms as queries: buckets, monthly partials, bitmaps, histories, changing schemas, lines that can't be read."""

from __future__ import annotations

import datetime
import math
import uuid

from pyspark.sql import functions as F

from .. import plans, sources
from ..functions import normalize_phone
from ..operators import (
    Metric, advance, as_of_join, densify_months, densify_within, distinct_count, distinct_state, merge_states,
    monthly_partials, rolling_from_partials, settle, split_join, stack,
)
from . import reports_agents as pack
from .core_io import MONTH_TOTALS, fresh, month_totals
from .entities import ORDERS_AS_OF, REPORT_DATE
from .registry import REGISTRY, Tables, query

# ---------------------------------------------------------------------------------------------
# buckets

#: At least; and rows of the largest table that one may hold, so that it fits a task.
BUCKETS, BUCKET_ROWS = 16, 1_000_000


def bucket_count(t: Tables) -> int:
    """Buckets of every table of a query, by the number of coverages, which is read from the files' footers.

    With fewer than the session shuffles into, Spark would shuffle a stored table again to spread it.
    """
    shuffled = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return max(BUCKETS, shuffled, math.ceil(t.e_coverage.count() / BUCKET_ROWS))


def bucketed(t: Tables, name: str, buckets: int, df=None):
    """An entity as a table in buckets of its policy number."""
    table = f"tidewell_{name}_{uuid.uuid4().hex}"
    return sources.write_buckets(getattr(t, name) if df is None else df, table, fresh(t, table), "pol_num", buckets)


def columns_of(name: str) -> str:
    return " ".join(f"{c}:{kind}" for c, kind in REGISTRY[name].columns)


@query("d53_fact_on_buckets", columns_of("d53_coverage_fact"), REGISTRY["d53_coverage_fact"].sql)
def fact_on_buckets(t: Tables):
    """Coverages, policies and links are stored by policy; coverages meet their policies where they lie."""
    n = bucket_count(t)
    return plans.coverage_fact(
        bucketed(t, "e_coverage", n), bucketed(t, "e_policy", n), t.e_agent, bucketed(t, "e_link", n), t.e_client, t.e_candidate,
        t.e_rate_quarter, t.e_tier, REPORT_DATE, single_plans=pack.SINGLE,
    )


@query("d04_balance_on_buckets", columns_of("d04_account_balance"), REGISTRY["d04_account_balance"].sql)
def balance_on_buckets(t: Tables):
    dated, old = t.e_ledger.where("extract_typ <> 'Z'"), t.e_ledger.where("extract_typ = 'Z'")
    ledgers = (dated.where("trxn_dt > date '1998-01-01'"), dated.where("trxn_dt <= date '1998-01-01'"), old)
    n = bucket_count(t)
    stored = [bucketed(t, "ledger", n, ledger) for ledger in ledgers]
    return plans.account_balance(*stored, bucketed(t, "e_policy", n), bucketed(t, "e_coverage", n), ORDERS_AS_OF)


# ---------------------------------------------------------------------------------------------
# monthly partials

LAST = 2000 * 12 + 5
MEASURES = [Metric("ape", "sum", "mode_prem"), Metric("cus", "distinct", "po_num")]


@query("a28_stepped_partials", columns_of("a28_rolling_kpis"), REGISTRY["a28_rolling_kpis"].sql)
def stepped(t: Tables):
    """Thirteen months are added one by one, as monthly runs do; each run lets go of what twelve months don't need."""
    path = fresh(t, "partials")
    sold = t.e_policy.join(t.e_policy_mart.select("pol_num", "po_num"), "pol_num")
    for month in range(LAST - 12, LAST + 1):
        first = datetime.date((month - 1) // 12, (month - 1) % 12 + 1, 1)
        rows = sold.where((F.col("pol_iss_dt") >= first) & (F.col("pol_iss_dt") < F.add_months(F.lit(first), 1)))
        advance(monthly_partials(rows.withColumn("m", F.lit(month)), "agt_code", "m", MEASURES), path, month)
    return rolling_from_partials(sources.read_table(t.spark, path), "agt_code", LAST, MEASURES)


@query("d40_kpis_from_partials", columns_of("d40_agent_kpis"), REGISTRY["d40_agent_kpis"].sql)
def kpis_from_partials(t: Tables):
    path = fresh(t, "agent-partials")
    sources.write_partitions(plans.agent_partials(pack.stored_fact(t), pack.agents(t)), path, "month")
    return plans.kpis_from_partials(sources.read_table(t.spark, path), REPORT_DATE)


_MATCHING = [f'cast("{w}_ape" as double) / "{w}_{d}" as "{w}_{d}_size"' for w in pack.WINDOWS for d in ("pol", "po")] + [
    f'coalesce(1 - cast("{w}_{m}" as double) / "{w}_pol", 1) as "{w}_{m}_per"' for m in ("NT", "rej", "lap") for w in pack.WINDOWS
]


@query(
    "d41_ratios_matching_window", columns_of("d41_agent_ratios"), f"with {pack.KPI_CTE} select agt_cd, {', '.join(_MATCHING)} from k"
)
def matching_window(t: Tables):
    """Shares of each window's own policy count."""
    return plans.agent_ratios(pack.kpis(t, pack.stored_fact(t)), matching_window=True)


# ---------------------------------------------------------------------------------------------
# bitmaps

_LEVELS = {
    "all": "null, null, null", "channel": "dist_chnl_cd, null, null", "channel and bank": "dist_chnl_cd, wa_code, null",
    "channel and month": "dist_chnl_cd, null, last_day(pol_iss_dt)",
}


@query(
    "a02_rolled_up_distinct", "level:s channel:s bank:s month:D n:l",
    " union all ".join(
        f"select '{level}' as level, c as channel, b as bank, m as month, count(distinct po_num) as n "
        f"from (select po_num, {', '.join(f'{e} as {x}' for e, x in zip(dims.split(', '), 'cbm', strict=True))} from e_policy_mart) group by c, b, m"
        for level, dims in _LEVELS.items()
    ),
)
def rolled_up(t: Tables):
    """Distinct owners at four levels from one stored state, which was brought up to date once."""
    rows = t.e_policy_mart.select(
        F.col("dist_chnl_cd").alias("channel"), F.col("wa_code").alias("bank"), F.last_day("pol_iss_dt").alias("month"), "po_num"
    )
    dims, year = ["channel", "bank", "month"], F.year("month") < 1998
    path, new = fresh(t, "distinct"), rows.where(~year)
    sources.write_table(distinct_state(rows.where(year), dims, "po_num"), path)
    state = settle(merge_states(sources.read_table(t.spark, path), distinct_state(new, dims, "po_num")))
    levels = {"all": [], "channel": ["channel"], "channel and bank": ["channel", "bank"], "channel and month": ["channel", "month"]}
    out = []
    for level, kept in levels.items():
        counted = distinct_count(state, kept)
        others = {d: F.lit(None).cast(rows.schema[d].dataType) for d in dims if d not in kept}
        out.append(counted.withColumns({"level": F.lit(level), **others}).select("level", *dims, "n"))
    return stack(out)


# ---------------------------------------------------------------------------------------------
# joins

PLACEHOLDER = "000000000"


@query(
    "j15_split_join", "event_id:l cli_num:l",
    f"""with lead as (select event_id, case when event_id % 3 = 0 then '{PLACEHOLDER}' else lpad(cast(user_id as varchar), 9, '0') end as phone from events),
person as (select c_custkey as cli_num, case when c_custkey % 50 = 0 then '{PLACEHOLDER}' else lpad(cast(c_custkey as varchar), 9, '0') end as mobile from customer)
select event_id, cli_num from lead left join person on phone = mobile""",
)
def split(t: Tables):
    """A placeholder phone holds a third of the leads and stands with some clients, too."""
    phone = F.when(F.col("event_id") % 3 == 0, PLACEHOLDER).otherwise(F.lpad(F.col("user_id").cast("string"), 9, "0"))
    mobile = F.when(F.col("c_custkey") % 50 == 0, PLACEHOLDER).otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    leads = t.events.select("event_id", normalize_phone(phone).alias("phone"))
    people = t.customer.select(F.col("c_custkey").alias("cli_num"), normalize_phone(mobile).alias("mobile"))
    return split_join(leads, people, ("phone", "mobile"), how="left", target=500)


@query(
    "j19_as_of_join", "pol_num:l pol_iss_dt:D effective_date:D nbv_factor_group:s nbv_margin_agency:d",
    """with r as (select plan_code, effective_date as d, nbv_factor_group, nbv_margin_agency from e_rate_quarter qualify row_number()
  over (partition by plan_code, effective_date order by nbv_factor_group, nbv_margin_agency) = 1)
select pol_num, pol_iss_dt, r.d as effective_date, r.nbv_factor_group, r.nbv_margin_agency
from e_policy p asof left join r on p.plan_code_base = r.plan_code and p.pol_iss_dt >= r.d""",
)
def as_of(t: Tables):
    """The newest rate of the plan on each policy's issue date."""
    rates = t.e_rate_quarter.select("plan_code", F.col("effective_date").alias("start"), "effective_date", "nbv_factor_group", "nbv_margin_agency")
    return as_of_join(
        t.e_policy.select("pol_num", "plan_code_base", "pol_iss_dt"), rates, [("plan_code_base", "plan_code")], "pol_iss_dt", "start",
        ["effective_date", "nbv_factor_group", "nbv_margin_agency"],
    )


_IMAGES = "(select unnest(generate_series(timestamp '1995-01-31', timestamp '2000-05-31', interval 1 month)) as t)"


@query(
    "j18_rates_of_each_snapshot", "plan_code:s image_date:D effective_date:D margin:d",
    f"""with i as (select distinct last_day(cast(t as date)) as image_date from {_IMAGES}),
p as (select distinct plan_code from e_rate_quarter),
r as (select plan_code, effective_date, min(nbv_margin_agency) as margin from e_rate_quarter group by 1, 2)
select x.plan_code, x.image_date, r.effective_date, r.margin from (select plan_code, image_date from p cross join i) x
asof left join r on x.plan_code = r.plan_code and x.image_date >= r.effective_date""",
)
def rates_of_each_snapshot(t: Tables):
    """The rate in force at every month end, for all snapshots at once."""
    images = t.spark.range(65).select(
        F.last_day(F.add_months(F.lit("1995-01-31").cast("date"), F.col("id").cast("int"))).alias("image_date"), F.lit(1).alias("one")
    )
    plans_listed = t.e_rate_quarter.select("plan_code").distinct().withColumn("one", F.lit(1))
    rows = plans_listed.join(images, "one").select("plan_code", "image_date")
    rates = t.e_rate_quarter.groupBy("plan_code", F.col("effective_date").alias("start")).agg(F.min("nbv_margin_agency").alias("margin"))
    rates = rates.withColumn("effective_date", F.col("start"))
    return as_of_join(rows, rates, [("plan_code", "plan_code")], "image_date", "start", ["effective_date", "margin"])


# ---------------------------------------------------------------------------------------------
# spines


@query("a26_densify_months", "agt_code:l month:D premium:d",
       """with s as (select agt_code, cast(date_trunc('month', pol_iss_dt) as date) as month, sum(mode_prem) as premium from e_policy
  where pol_iss_dt between date '1998-11-01' and date '2000-02-29' group by 1, 2),
m as (select cast(unnest(generate_series(timestamp '1998-11-01', timestamp '2000-02-01', interval 1 month)) as date) as month)
select x.agt_code, m.month, coalesce(s.premium, 0) as premium from (select distinct agt_code from s) x cross join m
left join s on s.agt_code = x.agt_code and s.month = m.month""")  # fmt: skip
def months_filled(t: Tables):
    rows = t.e_policy.where("pol_iss_dt between date '1998-11-01' and date '2000-02-29'")
    return densify_months(
        rows.withColumnRenamed("mode_prem", "premium"), "agt_code", "pol_iss_dt", "premium", datetime.date(1998, 11, 1), datetime.date(2000, 2, 1)
    )


@query("a26_densify_within", "channel:s agt_code:l plan_code:s premium:d",
       """with s as (select dist_chnl_cd as channel, agt_code, plan_code_base as plan_code, sum(mode_prem) as premium from e_policy
  where dist_chnl_cd is not null and agt_code is not null and plan_code_base is not null group by 1, 2, 3)
select e.channel, e.agt_code, d.plan_code, coalesce(s.premium, 0) as premium from (select distinct channel, agt_code from s) e
join (select distinct channel, plan_code from s) d on e.channel = d.channel
left join s on s.channel = e.channel and s.agt_code = e.agt_code and s.plan_code = d.plan_code""")  # fmt: skip
def plans_filled(t: Tables):
    rows = t.e_policy.select(F.col("dist_chnl_cd").alias("channel"), "agt_code", F.col("plan_code_base").alias("plan_code"), F.col("mode_prem").alias("premium"))
    return densify_within(rows, "channel", "agt_code", "plan_code", "premium")


# ---------------------------------------------------------------------------------------------
# history, changing schemas, lines


@query("s12_history_replace", "l_returnflag:s month:D n:l amt:d",
       f"""select l_returnflag, month, case when month >= date '1995-01-01' and l_returnflag = 'N' then n + 1 else n end as n, amt
from ({MONTH_TOTALS})""")  # fmt: skip
def history_replace(t: Tables):
    """Runs add partitions and replace rows by key; one stops before it publishes and leaves no trace."""
    history = sources.History(t.spark, fresh(t, "published"), "l_returnflag", ["month"])
    totals = month_totals(t)
    history.replace(totals.where("l_returnflag <> 'R' and month < date '1996-01-01'"))
    history.replace(totals.where("l_returnflag <> 'A' and month >= date '1994-01-01'"))
    history.stage(totals.withColumn("amt", F.col("amt") * 0))
    history.replace(totals)
    history.replace(totals.where("l_returnflag = 'N' and month >= date '1995-01-01'").withColumn("n", F.col("n") + 1))
    return history.read()


@query("s01_changing_columns", "o_orderkey:l o_totalprice:d o_clerk:s o_shippriority:l year:l",
       """select o_orderkey, case when year(o_orderdate) = 1996 then floor(o_totalprice) else o_totalprice end as o_totalprice,
  case when year(o_orderdate) = 1998 then o_orderpriority end as o_clerk,
  case when year(o_orderdate) > 1996 then o_orderkey % 100 end as o_shippriority, year(o_orderdate) as year
from orders where year(o_orderdate) between 1996 and 1998""")  # fmt: skip
def changing_columns(t: Tables):
    """Three years' folders: an added column, widened types, other case."""
    base, key = fresh(t, "years"), F.col("o_orderkey")
    price = F.col("o_totalprice")
    years = {
        1996: [key.cast("int"), F.floor(price).cast("int").alias("O_TOTALPRICE")],
        1997: [key.cast("bigint"), price.cast("decimal(12,2)").alias("o_totalprice"), (key % 100).cast("tinyint").alias("o_shippriority")],
        1998: [
            (key % 100).cast("bigint").alias("O_ShipPriority"), key.cast("bigint"), price.cast("double").alias("o_totalprice"),
            F.col("o_orderpriority").alias("o_clerk"),
        ],
    }
    for year, columns in years.items():
        rows = t.orders.where(F.year("o_orderdate") == year)
        sources.write_table(rows.select(*columns, F.lit(year).cast("smallint" if year < 1998 else "int").alias("year")), f"{base}/{year}")
    return sources.read_reconciled(
        t.spark, [f"{base}/{y}" for y in years], columns=["o_orderkey", "o_totalprice", "o_clerk", "o_shippriority", "year"]
    )


LINE_KINDS = """case when o_orderkey % 17 = 0 then 'cut' when o_orderkey % 19 = 0 then 'date' when o_orderkey % 23 = 0 then 'long' else 'good' end"""


@query("s05_bad_lines", "source:s lines:l amount:d",
       f"""select case when k = 'good' then 'good' else 'bad' end as source, count(*) as lines,
  sum(case when k = 'good' then cast(o_totalprice as decimal(18,2)) end) as amount
from (select *, {LINE_KINDS} as k from orders) group by 1 union all select 'all', count(*), null from orders""")  # fmt: skip
def bad_lines(t: Tables):
    """Lines cut short, too long or with a date that is none go to the quarantine table; the counts add up."""
    path, kept = fresh(t, "lines"), fresh(t, "quarantine")
    schema = "o_orderkey bigint, o_orderdate date, amt decimal(18,2)"
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    line = (
        F.when(F.expr(f"{LINE_KINDS} = 'cut'"), F.concat_ws(",", key, date))
        .when(F.expr(f"{LINE_KINDS} = 'date'"), F.concat_ws(",", key, F.lit("31/02"), amount))
        .when(F.expr(f"{LINE_KINDS} = 'long'"), F.concat_ws(",", key, date, amount, F.lit("more")))
        .otherwise(F.concat_ws(",", key, date, amount))
    )
    t.orders.select(line.alias("o_orderkey,o_orderdate,amt")).write.option("quote", "").option("header", True).option("sep", "\x01").csv(path)
    good, bad = sources.read_checked(t.spark, path, schema)
    sources.quarantine(bad, kept, source="orders")
    counted = sources.line_counts(t.spark, path, schema)
    none = F.lit(None).cast("decimal(28,2)")
    return stack(
        [
            good.agg(F.lit("good").alias("source"), F.count(F.lit(1)).alias("lines"), F.sum("amt").cast("decimal(28,2)").alias("amount")),
            sources.read_partition(t.spark, kept, "source", "orders").agg(F.lit("bad").alias("source"), F.count(F.lit(1)).alias("lines"), none.alias("amount")),
            counted.select(F.lit("all").alias("source"), F.col("n_lines").alias("lines"), none.alias("amount")),
        ]
    )


@query("s14_list_round_trip", "o_custkey:l years:l newest:l n:l",
       """select o_custkey, count(distinct year(o_orderdate)) as years, max(year(o_orderdate)) as newest, count(*) as n from orders group by 1""")  # fmt: skip
def list_round_trip(t: Tables):
    """Lists are written as one field each and read back as lists of numbers."""
    path = fresh(t, "lists")
    listed = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_set(F.year("o_orderdate"))).alias("years"), F.count(F.lit(1)).alias("n"))
    sources.write_csv(listed, path)
    good, _ = sources.read_checked(t.spark, path, "o_custkey bigint, years array<int>, n bigint")
    return good.select("o_custkey", F.size("years").alias("years"), F.element_at("years", -1).alias("newest"), "n")
