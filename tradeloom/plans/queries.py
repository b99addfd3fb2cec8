"""Every operator as a query over a folder of order tables.

Shares, slopes and other quotients are rounded, as their last bits depend on the order of a sum.
Large slopes are given in millions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import fixed_text, percent_text
from ..operators import complexity, hierarchy, ingest, insights, metrics, reports, views
from ..operators.views import SHARES
from ..sources import raw_csv, snapshots, tables
from ..sources.shared import new_path
from ..streaming import ledger
from ..streaming.incremental import ingest_new_files
from . import build, sample
from .workbench import Workbench, workbench

YEAR = 2022
BASE_YEAR = 2016
COUNTRIES = [1, 2, 3, 4, 5]
PRODUCTS = [7, 60, 150]
COUNTRY, OTHER_COUNTRY = 1, 2
SOURCES = ("one_country_country_product_year_6", "two_country_country_product_year_6")

GROWTH = ["high_complexity_growth", "medium_high_growth"]
SPREAD = [f"{kind}_{name}" for kind in ("avg", "std") for name in GROWTH]
TREND_COLUMNS = [
    "balance_trend",
    "high_complexity_balance_trend",
    "medium_complexity_balance_trend",
    "low_complexity_balance_trend",
]


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns if c in df.columns})


def in_millions(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns(
        {c: F.round(F.col(c) / F.lit(1e6), 3) for c in columns if c in df.columns}
    )


# Ingest


def combined(w: Workbench) -> DataFrame:
    return ingest.combined_trade_data(w.raw)


def cleaned_sources(w: Workbench) -> DataFrame:
    parts = [
        ingest.clean_source(raw).withColumn("table_name", F.lit(name))
        for name, raw in zip(SOURCES, w.raw)
    ]
    return parts[0].unionByName(parts[1])


def merged_in_turn(w: Workbench) -> DataFrame:
    """The early years of one source, then the other one, then all years of the first."""
    first, second = w.raw
    early = ingest.clean_source(first).filter(F.col("year") < BASE_YEAR + 2)
    return ingest.merge_combined(early, [second, first])


def merged_by_index(w: Workbench, *, null_safe: bool) -> DataFrame:
    """The early years of one source, then both sources, merged into a fact table with a key index."""
    first, second = w.raw
    table = f"{new_database(w)}.combined_trade_data"
    early = ingest.clean_source(first).filter(F.col("year") < BASE_YEAR + 2)
    tables.write_fact_table(early, table)
    tables.write_key_index(w.spark, table)
    tables.merge_into(w.spark, table, second, first, null_safe=null_safe)
    return tables.fact_in(w.spark, table)


def merged(w: Workbench, *, null_safe: bool) -> DataFrame:
    first, second = w.raw
    return ingest.merge_combined(ingest.clean_source(first), [second], null_safe=null_safe)


def _landed(w: Workbench) -> tuple[str, DataFrame]:
    """Both source tables as plain CSV, then landed as gzip; the landing folder and report."""

    def make() -> tuple[str, DataFrame]:
        plain, landing = new_path(w.spark, "csv"), new_path(w.spark, "landing")
        for name, rows in zip(SOURCES, w.raw):
            rows.write.option("header", True).csv(f"{plain}/{name}.csv")
        return landing, raw_csv.land_csv(w.spark, plain, landing)

    return w.once("landed", make)


def landing_report(w: Workbench) -> DataFrame:
    """What landing reports, with the rows and exports that arrived."""
    landing, report = _landed(w)
    return report.select("table_name", "status").join(
        _landed_rows(w, landing)
        .groupBy("table_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.sum("export_value") / F.lit(1e6), 3).alias("exports_in_millions"),
        ),
        "table_name",
    )


def _landed_rows(w: Workbench, landing: str) -> DataFrame:
    parts = [
        raw_csv.read_raw_csv(w.spark, f"{landing}/{name}").withColumn("table_name", F.lit(name))
        for name in SOURCES
    ]
    return parts[0].unionByName(parts[1])


def landed_mixed_headers(w: Workbench) -> DataFrame:
    """One table from parts with other columns and orders, one with line breaks in quoted text."""

    def make() -> str:
        plain, landing = new_path(w.spark, "csv"), new_path(w.spark, "landing")
        rows, path = w.raw[0], f"{plain}/{SOURCES[0]}.csv"
        even = F.col("product_id") % 2 == 0
        text = F.concat(F.lit('line "'), F.col("product_id"), F.lit('",\n'), F.col("country_id"))
        noted = rows.filter(even).withColumn("note", text).select("note", *reversed(rows.columns))
        for part in (rows.filter(~even), noted):
            out = part.write.mode("append").option("header", True).option("escape", '"')
            out.csv(path)
        raw_csv.land_csv(w.spark, plain, landing)
        return f"{landing}/{SOURCES[0]}"

    return raw_csv.read_raw_csv(w.spark, w.once("landed-mixed", make)).select(*S.FACT_COLUMNS, "note")


def detected_csv_types(w: Workbench) -> DataFrame:
    """Types of all columns of the orders, written as CSV with values that widen some of them."""

    def make() -> str:
        path = new_path(w.spark, "csv")
        orders = sample.read_table(w.spark, w.folder, "orders")
        price, key = F.col("o_totalprice"), F.col("o_orderkey")
        rows = orders.select(
            "o_orderkey",
            F.when(key % 7 != 0, F.col("o_custkey")).alias("o_custkey"),
            F.when(key % 2 == 0, F.floor(price).cast("string")).otherwise(price.cast("string")).alias("price"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
            F.when(key % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .alias("moment"),
            (key % 2 == 0).cast("string").alias("even"),
            F.when(key % 5 == 0, "n/a").otherwise(key.cast("string")).alias("mixed"),
            F.when(key % 5 == 0, "1").otherwise("true").alias("flag_or_number"),
            F.lit(None).cast("string").alias("nothing"),
        )
        rows.write.option("header", True).csv(path)
        return path

    path = w.once("types-csv", make)
    return raw_csv.detected_types(raw_csv.csv_rows(w.spark, path))


def bitmap_counts(w: Workbench) -> DataFrame:
    """Distinct products and partners per country and year, from bitmaps of two parts of the fact put together."""
    keys = ["country_id", "year"]
    early, late = w.fact.filter(F.col("product_id") % 2 == 0), w.fact.filter(F.col("product_id") % 2 == 1)

    def counts(column: str, name: str) -> DataFrame:
        parts = metrics.distinct_bitmaps(early, keys, column).unionByName(
            metrics.distinct_bitmaps(late, keys, column)
        )
        return metrics.distinct_counts(metrics.added_bitmaps(parts, keys), keys, name)

    return counts("product_id", "product_count").join(counts("partner_country_id", "partner_count"), keys)


def reconciled_levels(w: Workbench) -> DataFrame:
    """Codes, headings and chapters loaded together, without counting trade twice."""
    return w.once("reconciled", lambda: hierarchy.reconciled(sample.level_tables(w.fact)))


def mixed_level_build(w: Workbench) -> DataFrame:
    """Country totals of a database whose source tables have three levels."""

    def make() -> str:
        database = new_database(w)
        for level, rows in sample.level_tables(w.fact).items():
            rows.write.saveAsTable(f"{database}.hs_{S.SOURCE_TABLE_MARK}_{level}")
        build.build_all(w.spark, database, levels=(2, 4, 6))
        return database

    found = w.spark.table(f"{w.once('mixed-levels', make)}.country_year_metrics")
    return found.select("country_id", "year", "total_exports", "total_imports", "trade_balance")


def raw_csv_rows(w: Workbench) -> DataFrame:
    return _landed_rows(w, _landed(w)[0])


def new_database(w: Workbench) -> str:
    path = new_path(w.spark, "database")
    name = "tradeloom_" + path.rsplit("-", 1)[-1]
    w.spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@contextmanager
def _loaded(w: Workbench) -> Iterator[tuple[str, DataFrame]]:
    """A database with both source tables, as long as it is needed, and the load report."""
    landing, _ = _landed(w)
    database = new_database(w)
    try:
        yield database, raw_csv.load_raw_tables(w.spark, landing, database)
    finally:
        w.spark.sql(f"DROP DATABASE {database} CASCADE")


def load_report(w: Workbench) -> DataFrame:
    with _loaded(w) as (_, report):
        return report.select("table_name", "rows", "rejected", "status")


def load_counts(w: Workbench) -> DataFrame:
    with _loaded(w) as (_, report):
        return raw_csv.load_summary(report)


def source_discovery(w: Workbench) -> DataFrame:
    with _loaded(w) as (database, _):
        return _discovered(w, database)


def _discovered(w: Workbench, database: str) -> DataFrame:
    names = tables.source_tables(w.spark, database)
    rows = [(name, *tables.table_status(w.spark, f"{database}.{name}")) for name in names]
    combined_table = f"{database}.{build.COMBINED}"
    rows.append((build.COMBINED, *tables.table_status(w.spark, combined_table)))
    build.build_combined(w.spark, database)
    rows.append((f"{build.COMBINED} built", *tables.table_status(w.spark, combined_table)))
    return w.spark.createDataFrame(
        rows, "table_name string, table_exists boolean, has_data boolean"
    )


def _built_twice(w: Workbench) -> str:
    """A database built from the first source, then again with the second one merged in."""

    def make() -> str:
        database = new_database(w)
        for name, rows in zip(SOURCES, w.raw):
            rows.write.saveAsTable(f"{database}.{name}")
            build.build_all(w.spark, database, null_safe=True)
        return database

    return w.once("built-twice", make)


def built_table(name: str, digits: dict[str, int], w: Workbench) -> DataFrame:
    """A table or view of the database by its full name, as another session would read it."""
    found = w.spark.table(f"{_built_twice(w)}.{name}")
    for column, places in digits.items():
        found = rounded(found, [column], places)
    return found


def _published_twice(w: Workbench) -> str:
    """A folder with two versions: of the first source, and with the second one merged in."""

    def make() -> str:
        database, root = new_database(w), new_path(w.spark, "published")
        for name, rows in zip(SOURCES, w.raw):
            rows.write.saveAsTable(f"{database}.{name}")
            build.build_combined(w.spark, database, null_safe=True)
            build.publish_metrics(w.spark, database, root)
        return root

    return w.once("published-twice", make)


def published_versions(w: Workbench) -> DataFrame:
    """Country totals of both versions."""
    root = _published_twice(w)
    of = [
        build.published(w.spark, root, n)["country_year_metrics"].withColumn("version", F.lit(n))
        for n in snapshots.versions(w.spark, root)
    ]
    return of[0].unionByName(of[1])


def published_table(name: str, digits: dict[str, int], w: Workbench) -> DataFrame:
    found = build.published(w.spark, _published_twice(w))[name]
    for column, places in digits.items():
        found = rounded(found, [column], places)
    return found


def _fact_by_curve(w: Workbench) -> DataFrame:
    def make() -> DataFrame:
        return tables.write_fact_table(w.fact, f"{new_database(w)}.combined_trade_data", curve=True)

    return w.once("fact-by-curve", make)


def curve_filter(column: str, values: list[int], w: Workbench) -> DataFrame:
    """Rows of some countries or some products of a fact laid out along a curve."""
    return _fact_by_curve(w).filter(F.col(column).isin(values))


def full_build(w: Workbench) -> DataFrame:
    """Row counts of all tables and views after building a database from landed files."""
    with _loaded(w) as (database, _):
        built = build.build_all(w.spark, database)
        counts = [(name, df.count()) for name, df in built.items()]
    return w.spark.createDataFrame(counts, "table_name string, row_count long")


def incremental_ingest(w: Workbench) -> DataFrame:
    """The fact table after two runs of the file stream, the second with one more source."""
    landing, progress = new_path(w.spark, "landing"), new_path(w.spark, "progress")
    table = f"{new_database(w)}.combined_trade_data"
    for name, rows in zip(SOURCES, w.raw):
        raw_csv.write_raw_csv(rows, f"{landing}/{name}")
        run = ingest_new_files(w.spark, landing, table, progress)
        run.awaitTermination()
    return tables.fact_in(w.spark, table)


def _ingested_in_batches(w: Workbench) -> str:
    """A database filled by two batches, the second of which is then repeated as after a failure."""

    def make() -> str:
        landing, progress = new_path(w.spark, "landing"), new_path(w.spark, "progress")
        database = new_database(w)
        for name, rows in zip(SOURCES, w.raw):
            raw_csv.write_raw_csv(rows, f"{landing}/{name}")
            ledger.ingest_batches(w.spark, landing, database, progress).awaitTermination()
        table = f"{database}.{build.COMBINED}"
        batches = w.spark.table(ledger.ledger_of(table))
        last = batches.agg(F.max(ledger.BATCH)).first()[0]
        again = w.raw[1].withColumn(ledger.FILE, F.lit("again"))
        assert ledger.add_batch(w.spark, table, last, again) is None
        return database

    return w.once("batches", make)


def batch_ingest(w: Workbench) -> DataFrame:
    return tables.fact_in(w.spark, f"{_ingested_in_batches(w)}.{build.COMBINED}")


def batch_metrics(w: Workbench) -> DataFrame:
    return w.spark.table(f"{_ingested_in_batches(w)}.country_year_metrics")


# Dashboard


def _year(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("year") == YEAR)


def _corrected_dynamics(w: Workbench) -> DataFrame:
    return metrics.complexity_dynamics(w.country_year, corrected=True)


def eci_balance_fit(w: Workbench) -> DataFrame:
    fit = insights.eci_balance_fit(insights.eci_balance_for_year(w.trends, YEAR))
    return in_millions(fit, ["slope", "intercept", "y_min", "y_max"])


def _coi(w: Workbench) -> DataFrame:
    return insights.coi_for_base_year(w.predictive, BASE_YEAR)


def _chosen_portfolio(w: Workbench) -> DataFrame:
    return insights.export_portfolio_for_countries(w.portfolio_view, YEAR, COUNTRIES)


def _chosen_evolution(w: Workbench) -> DataFrame:
    return insights.portfolio_evolution_for_countries(w.evolution, COUNTRIES)


def _scored(w: Workbench) -> DataFrame:
    return insights.diversification_score(
        insights.partner_diversification_for_year(w.diversification_view, YEAR)
    )


SCORES = ["partner_hhi", "diversification_score", "combined_score"]
PORTFOLIO = [*SHARES, "weighted_complexity", "top10_concentration"]

_SIX = dict.fromkeys([*PORTFOLIO, "partner_hhi"], 6)
_NINE = dict.fromkeys(["export_share", "global_market_share"], 9)
_FOUR = dict.fromkeys([*GROWTH, *SPREAD], 4)
BUILT = [
    "combined_trade_data",
    "country_year_metrics",
    "product_year_metrics",
    "bilateral_flows",
    "export_specialization",
    "complexity_dynamics",
    "product_complexity",
    "export_portfolio",
    "partner_diversification",
    "coi_growth_analysis",
    "v_global_yearly_metrics",
    "v_eci_balance_trends",
    "v_export_complexity_portfolio",
    "v_diversification_complexity",
    "v_coi_predictive_power",
    "v_portfolio_evolution",
]

#: Of the published tables those that depend on all others.
PUBLISHED = ["export_specialization", "v_coi_predictive_power", "v_portfolio_evolution"]

BENCH_QUERIES: dict[str, Callable[[Workbench], DataFrame]] = {
    # Sources
    "landing_report": landing_report,
    "raw_csv_rows": raw_csv_rows,
    "landed_mixed_headers": landed_mixed_headers,
    "detected_csv_types": detected_csv_types,
    "bitmap_counts": bitmap_counts,
    "load_report": load_report,
    "load_counts": load_counts,
    "source_discovery": source_discovery,
    "full_build": full_build,
    **{f"built_{name}": partial(built_table, name, _SIX | _NINE | _FOUR) for name in BUILT},
    "products_by_curve": partial(curve_filter, "product_id", PRODUCTS),
    "countries_by_curve": partial(curve_filter, "country_id", COUNTRIES),
    "published_versions": published_versions,
    **{f"published_{name}": partial(published_table, name, _SIX | _NINE | _FOUR) for name in PUBLISHED},
    "incremental_ingest": incremental_ingest,
    "batch_ingest": batch_ingest,
    "batch_metrics": batch_metrics,
    # Levels of product codes
    "reconciled_levels": reconciled_levels,
    "level_coverage": lambda w: hierarchy.coverage(sample.level_tables(w.fact)),
    "chapter_totals": lambda w: hierarchy.rolled_up(reconciled_levels(w), 2),
    "heading_totals": lambda w: hierarchy.rolled_up(reconciled_levels(w), 4),
    "mixed_level_build": mixed_level_build,
    # Pipeline tables
    "clean_source": cleaned_sources,
    "combined_trade_data": combined,
    "merge_combined": partial(merged, null_safe=False),
    "merge_combined_null_safe": partial(merged, null_safe=True),
    "merge_three_sources": merged_in_turn,
    "merge_by_index": partial(merged_by_index, null_safe=False),
    "merge_by_index_null_safe": partial(merged_by_index, null_safe=True),
    "country_year_metrics": Workbench.new_country_year,
    "product_year_metrics": Workbench.new_product_year,
    "bilateral_flows": lambda w: w.flows,
    "export_specialization": lambda w: rounded(
        w.specialization, ["export_share", "global_market_share"], 9
    ),
    "complexity_dynamics": lambda w: w.dynamics,
    "complexity_dynamics_corrected": _corrected_dynamics,
    "product_complexity": lambda w: complexity.product_complexity(w.product_year),
    "export_portfolio": lambda w: rounded(w.new_portfolio(), PORTFOLIO),
    "export_portfolio_by_product": lambda w: rounded(
        w.new_portfolio(by_product=True), PORTFOLIO
    ),
    "partner_diversification": lambda w: rounded(
        w.new_diversification(), ["partner_hhi"]
    ),
    "coi_growth_analysis": lambda w: rounded(w.new_growth(), GROWTH, 4),
    "coi_growth_by_product": lambda w: rounded(
        w.new_growth(by_product=True, last_base_year=None), GROWTH, 4
    ),
    # Views
    "v_global_yearly_metrics": lambda w: w.global_yearly,
    "v_eci_balance_trends": lambda w: w.trends,
    "v_export_complexity_portfolio": lambda w: rounded(w.portfolio_view, PORTFOLIO),
    "v_diversification_complexity": lambda w: rounded(w.diversification_view, SCORES),
    "v_coi_predictive_power": lambda w: rounded(w.predictive, SPREAD, 4),
    "v_portfolio_evolution": lambda w: rounded(w.evolution, SHARES),
    # Dashboard
    "available_years": lambda w: insights.available_years(w.fact),
    "available_countries": lambda w: insights.available_countries(w.fact),
    "global_metrics": lambda w: insights.global_metrics(w.global_yearly),
    "global_metrics_yoy": lambda w: insights.global_metrics_yoy(w.global_yearly),
    "top_countries": lambda w: insights.top_countries(w.country_year, YEAR),
    "eci_balance_for_year": lambda w: insights.eci_balance_for_year(w.trends, YEAR),
    "export_portfolio_for_year": lambda w: rounded(
        insights.export_portfolio_for_year(w.portfolio_view, YEAR), PORTFOLIO
    ),
    "export_portfolio_for_countries": lambda w: rounded(_chosen_portfolio(w), PORTFOLIO),
    "partner_diversification_for_year": lambda w: rounded(
        insights.partner_diversification_for_year(w.diversification_view, YEAR), SCORES
    ),
    "coi_predictive_power": lambda w: rounded(
        insights.coi_predictive_power(w.predictive), SPREAD, 4
    ),
    "top_ranked_countries": lambda w: rounded(
        insights.top_ranked_countries(w.evolution), ["avg_rank"]
    ),
    "portfolio_evolution_for_countries": lambda w: rounded(_chosen_evolution(w), SHARES),
    "portfolio_evolution_of_leaders": lambda w: rounded(
        insights.portfolio_evolution_for_countries(
            w.evolution, insights.top_ranked_countries(w.evolution, 6)
        ),
        SHARES,
    ),
    "eci_text_of_all": lambda w: w.evolution.select(
        "country_id", "year", fixed_text(F.col("eci")).alias("eci_text")
    ),
    "share_text_of_all": lambda w: w.portfolio.select(
        "country_id", "year", *[percent_text(F.round(c, 6)).alias(c) for c in SHARES]
    ),
    "trend_split_with_change": lambda w: insights.trend_split(w.trends, with_change=True),
    "trend_split_no_change": lambda w: insights.trend_split(
        views.v_eci_balance_trends(_corrected_dynamics(w)), with_change=False
    ),
    "eci_balance_fit": eci_balance_fit,
    "trend_category_counts": lambda w: rounded(
        insights.trend_category_counts(_year(w.trends)), ["percent"]
    ),
    "single_year_countries": lambda w: insights.single_year_countries(w.country_year),
    "portfolio_long": lambda w: rounded(
        insights.portfolio_long(_chosen_portfolio(w)), ["share"]
    ),
    "portfolio_table": lambda w: rounded(
        insights.portfolio_table(_chosen_portfolio(w)), ["Weighted Complexity"]
    ),
    "diversification_score": lambda w: rounded(_scored(w), SCORES),
    "combined_score_top20": lambda w: rounded(insights.combined_score_top(_scored(w)), SCORES),
    "concentration_category_counts": lambda w: rounded(
        insights.concentration_category_counts(_year(w.diversification_view)), ["percent"]
    ),
    "base_years": lambda w: insights.base_years(w.predictive),
    "coi_for_base_year": lambda w: rounded(_coi(w), SPREAD, 4),
    "coi_growth_long": lambda w: rounded(insights.coi_growth_long(_coi(w)), ["growth_rate"], 4),
    "coi_growth_error_bars": lambda w: rounded(
        insights.coi_growth_error_bars(_coi(w)), ["growth_avg", "growth_std"], 4
    ),
    "coi_quartile_fit": lambda w: rounded(
        insights.coi_quartile_fit(_coi(w)), ["slope", "intercept", "fitted"], 4
    ),
    "coi_table": lambda w: insights.coi_table(_coi(w)),
    "latest_rank": lambda w: insights.latest_rank(_chosen_evolution(w)),
    "evolution_long": lambda w: rounded(insights.evolution_long(_chosen_evolution(w)), ["share"]),
    "evolution_long_all": lambda w: rounded(
        insights.evolution_long(_chosen_evolution(w), with_rank=False), ["share"]
    ),
    "latest_eci": lambda w: insights.latest_eci(_chosen_evolution(w)),
    # Report views
    "v_global_trade_metrics": lambda w: rounded(
        w.global_trade, ["trade_volume_pct_change", "eci_pct_change"]
    ),
    "v_top_traded_products": lambda w: rounded(w.products, ["volume_pct_change"], 4),
    "v_top_trading_partners": lambda w: w.partners,
    "mv_country_annual_trade": lambda w: w.annual,
    "v_eci_trade_balance_correlation": lambda w: in_millions(
        rounded(w.correlation, ["eci_trend", "complexity_concentration"]), TREND_COLUMNS
    ),
    "v_product_complexity_balance_trends": lambda w: in_millions(
        rounded(w.segments, ["trend_strength"]), ["segment_balance_trend", "avg_segment_balance"]
    ),
    "v_product_complexity_leaders": lambda w: rounded(
        w.new_leaders(), ["high_complexity_export_pct", "leadership_score"]
    ),
    # Reports
    "rpt_volume_yoy": lambda w: rounded(
        reports.rpt_volume_yoy(w.global_trade), ["trade_volume_pct_change"]
    ),
    "rpt_eci_yoy": lambda w: rounded(reports.rpt_eci_yoy(w.global_trade), ["eci_pct_change"]),
    "rpt_top_products": lambda w: rounded(
        reports.rpt_top_products(w.products), ["volume_pct_change"], 4
    ),
    "rpt_top_partners": lambda w: reports.rpt_top_partners(w.partners, COUNTRY),
    "rpt_balance_over_time": lambda w: reports.rpt_balance_over_time(w.partners, COUNTRY),
    "rpt_complex_among_top": lambda w: reports.rpt_complex_among_top(w.products),
    "rpt_compare_countries": lambda w: reports.rpt_compare_countries(
        w.global_trade, w.annual, COUNTRY, OTHER_COUNTRY
    ),
    "rpt_both_improving": lambda w: in_millions(
        rounded(
            reports.rpt_both_improving(w.correlation), ["eci_trend", "complexity_concentration"]
        ),
        TREND_COLUMNS,
    ),
    "rpt_eci_up_balance_down": lambda w: in_millions(
        rounded(
            reports.rpt_eci_up_balance_down(w.correlation),
            ["eci_trend", "complexity_concentration"],
        ),
        TREND_COLUMNS,
    ),
    "rpt_segment_trends": lambda w: in_millions(
        rounded(reports.rpt_segment_trends(w.segments, COUNTRY), ["trend_strength"]),
        ["segment_balance_trend", "avg_segment_balance"],
    ),
    "rpt_high_complexity_leaders": lambda w: rounded(
        reports.rpt_high_complexity_leaders(w.leaders), ["high_complexity_export_pct"]
    ),
    "rpt_consistent_leaders": lambda w: rounded(
        reports.rpt_consistent_leaders(w.leaders), ["leadership_score"]
    ),
    "rpt_category_specialists": lambda w: rounded(
        reports.rpt_category_specialists(w.leaders), ["high_complexity_export_pct"]
    ),
    "rpt_rank_improvers": lambda w: reports.rpt_rank_improvers(w.leaders),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def over_folder(query: Callable[[Workbench], DataFrame]):
        return lambda spark, folder: query(workbench(spark, folder))

    found = {name: over_folder(query) for name, query in BENCH_QUERIES.items()}
    found["directed_flows"] = sample.directed_flows
    found["fact_table"] = sample.fact_table
    return found
