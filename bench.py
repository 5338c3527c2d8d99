"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_ONLY`` limits the queries by name part, ``BENCH_RUNS`` is the number of runs of which the
median counts (default 3), after one that warms the query up. ``--pairs`` times plain forms against rewrites.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidewell.queries import REGISTRY
from tidewell.queries.plain_forms import PAIRS
from tidewell.queries.registry import Tables
from tidewell.session import build_session

HEADLINE = (
    "d24_status_movement",
    "d04_account_balance",
    "d05_ledger_summary",
    "d07_sales_report_submit",
    "d08_payment_reconciliation",
    "d10_new_business_value",
    "d11_attribute_leads",
    "d13_ecommerce_sales",
    "d20_agent_campaign",
    "d21_monthly_app_premium",
    "d22_collections",
    "d26_claim_turnaround",
    "d28_weekly_detail",
    "d30_campaign_tracking",
    "d32_customer_holdings",
    "d35_company_kpis",
    "d40_agent_kpis",
    "d42_sales_by_month",
    "d44_retention",
    "d47_agent_page1",
    "d49_advice_en",
    "d50_agent_overview",
    "d51_premium_rank",
    "d53_coverage_fact",
    "j12_month_range_join",
    "j13_interval_join",
    "w08_top_n_per_group",
    "w05_rank_rows",
    "a28_rolling_kpis",
    "p11_semi_or",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build) -> float:
    start = time.perf_counter()
    run(build())
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY", "")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "--pairs" in sys.argv:
        out = {}
        for name, plain in PAIRS.items():
            for _ in range(2):  # the second round is the warm one
                rewrite = timed(lambda: REGISTRY[name].run(spark, sf_dir))
                form = timed(lambda: plain(Tables(spark, sf_dir)))
            out[name] = {"plain": form, "rewrite": rewrite}
        print(json.dumps({"metric": "plain_against_rewrite", "unit": "sec", "pairs": out, "sf": sf_dir}))
        return
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    times = {}
    for name in HEADLINE:
        if only in name:
            # Start-up and compilation are not counted; they need no large input.
            run(REGISTRY[name].run(spark, small if os.path.isdir(small) else sf_dir))
            times[name] = statistics.median(timed(lambda: REGISTRY[name].run(spark, sf_dir)) for _ in range(runs))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
