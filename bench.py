"""Time the pipeline steps and the deepest queries; print one JSON line.

``BENCH_SF_DIR`` names the folder of order tables, ``BENCH_CPUS`` the number of local threads.
Each pipeline step is timed with its inputs stored, as in a build; the other queries are timed on
the stored metric tables. Results are computed whole and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tradeloom.plans.queries import BENCH_QUERIES
from tradeloom.plans.workbench import workbench

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# In the order in which a build runs them; reading one of these properties stores the table.
STEPS = [
    "fact",
    "by_product",
    "by_partner",
    "country_year",
    "product_year",
    "complexity",
    "portfolio",
    "diversification",
    "growth",
    "tier_trade",
    "leaders",
]

HEADLINE = [
    "combined_trade_data",
    "merge_combined",
    "merge_combined_null_safe",
    "bilateral_flows",
    "export_specialization",
    "country_year_metrics",
    "product_year_metrics",
    "product_complexity",
    "export_portfolio",
    "partner_diversification",
    "coi_growth_analysis",
    "complexity_dynamics",
    "v_global_yearly_metrics",
    "v_export_complexity_portfolio",
    "v_diversification_complexity",
    "v_coi_predictive_power",
    "v_portfolio_evolution",
    "combined_score_top20",
    "coi_quartile_fit",
    "evolution_long",
    "v_top_trading_partners",
    "v_product_complexity_leaders",
    "rpt_compare_countries",
    "rpt_both_improving",
    "rpt_rank_improvers",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tradeloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)

    # The first job of a session pays for starting it.
    run(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    bench = workbench(spark, FOLDER)
    for step in STEPS:
        timed(f"build_{step}", lambda: getattr(bench, step))
    for name in HEADLINE:
        timed(name, lambda: run(BENCH_QUERIES[name](bench)))
    print(
        json.dumps(
            {
                "metric": "trade_tables_and_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
