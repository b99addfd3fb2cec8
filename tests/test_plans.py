"""Physical plans: what must not be in them, and what must."""

from __future__ import annotations

import pytest
from compare import SMALL

from tradeloom.operators import insights, metrics, reports
from tradeloom.plans import sample
from tradeloom.plans.queries import BENCH_QUERIES
from tradeloom.plans.workbench import workbench

SOURCES = {
    "landing_report", "raw_csv_rows", "load_report", "load_counts", "source_discovery",
    "full_build", "incremental_ingest",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in BENCH_QUERIES if n not in SOURCES])
def test_no_pairs_and_no_python(bench, name):
    plan = plan_of(BENCH_QUERIES[name](bench))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in plan


def test_fact_has_one_aggregate_shuffle(spark):
    plan = plan_of(sample.fact_table(spark, SMALL))
    assert plan.count("Exchange hashpartitioning(a#") == 1


def test_fact_is_gathered_by_year_before_its_ends_are_read(spark):
    """The shuffle by year has a row per pair of countries, not one per end."""
    plan = plan_of(sample.fact_table(spark, SMALL, by_year=True))
    # Above stands what comes later.
    assert plan.index("Generate") < plan.index("REBALANCE_PARTITIONS_BY_COL")


def test_small_files_by_default(spark):
    name = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(name)
    try:
        for given, used in (("snappy", "zstd"), ("lz4", "lz4")):
            spark.conf.set(name, given)
            workbench(spark, SMALL)
            assert spark.conf.get(name) == used
    finally:
        spark.conf.set(name, before)


def test_year_filter_reaches_the_fact_files(bench):
    """Through the rank within a country-year, whose partition keys it is on."""
    plan = plan_of(reports.rpt_top_partners(reports.v_top_trading_partners(bench.fact), 1))
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "= 2022" in filters
    assert "EqualTo(country_id,1)" in plan


def test_scan_reads_only_needed_columns(bench):
    plan = plan_of(insights.available_countries(bench.fact))
    assert "ReadSchema: struct<country_id:bigint>" in plan


def test_top_flows_are_limited_before_the_shuffle(bench):
    plan = plan_of(bench.new_portfolio())
    assert plan.count("WindowGroupLimit") == 2


def test_small_totals_are_broadcast_and_the_fact_is_not_shuffled(bench):
    plan = plan_of(bench.specialization)
    assert "Exchange hashpartitioning" not in plan
    assert plan.count("BroadcastHashJoin") == 2


def test_large_totals_are_not_broadcast(spark, bench):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(bench.specialization)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan
    assert plan.count("SortMergeJoin") == 2


def test_top_k_does_not_sort_everything(bench):
    plan = plan_of(insights.top_countries(bench.country_year, 2022))
    assert "TakeOrderedAndProject" in plan


def test_flows_need_no_shuffle(bench):
    assert "Exchange" not in plan_of(metrics.bilateral_flows(bench.fact))


def test_workbench_is_shared_until_files_change(spark):
    assert workbench(spark, SMALL) is workbench(spark, SMALL)


@pytest.mark.parametrize("given, used", [(None, "16777216b"), ("64m", "64m")])
def test_tasks_read_bounded_splits(spark, given, used):
    """Unless the session has a size of its own, a task reads an eighth of what it would by default."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        if given:
            spark.conf.set(name, given)
        workbench(spark, SMALL)
        assert spark.conf.get(name) == used
    finally:
        spark.conf.set(name, before)


def test_shuffle_partitions_grow_with_the_input(spark):
    from tradeloom.sources import shared

    advisory, initial = shared._ADVISORY, shared._INITIAL
    shared.bounded_splits(spark, 1 << 30)
    assert (spark.conf.get(advisory), spark.conf.get(initial)) == ("16777216b", "512")
    shared.bounded_splits(spark, 1)
    assert spark.conf.get(initial) == "8"
    spark.conf.set(initial, "77")
    try:
        shared.bounded_splits(spark, 1 << 30)
        assert spark.conf.get(initial) == "77"
    finally:
        spark.conf.set(initial, "8")
