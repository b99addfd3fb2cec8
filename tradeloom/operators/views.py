"""Presentation views over the metric tables. Row order is left to the reader of a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARES = [
    "high_complexity_share",
    "medium_high_share",
    "medium_low_share",
    "low_complexity_share",
]


def v_global_yearly_metrics(country_year: DataFrame) -> DataFrame:
    """World totals and mean complexity per year; exports are the measure of trade volume."""
    return country_year.groupBy("year").agg(
        F.sum("total_exports").alias("global_exports"),
        F.sum("total_imports").alias("global_imports"),
        F.sum("total_exports").alias("global_trade_volume"),
        F.avg("eci").alias("avg_eci"),
    )


def v_eci_balance_trends(dynamics: DataFrame) -> DataFrame:
    return dynamics.select(
        "country_id",
        "year",
        "eci",
        "eci_change",
        "trade_balance",
        "balance_change",
        "trend_category",
    )


def v_export_complexity_portfolio(portfolio: DataFrame, dynamics: DataFrame) -> DataFrame:
    """Portfolio with the country's index; like the dynamics, without each country's first year."""
    return portfolio.join(dynamics, ["country_id", "year"]).select(
        "country_id", "year", *SHARES, "weighted_complexity", "eci"
    )


def v_diversification_complexity(diversification: DataFrame, dynamics: DataFrame) -> DataFrame:
    return diversification.join(dynamics, ["country_id", "year"]).select(
        "country_id",
        "year",
        "partner_count",
        "partner_hhi",
        "concentration_category",
        "eci",
        "eci_change",
    )


def v_coi_predictive_power(growth: DataFrame) -> DataFrame:
    """Mean and sample deviation of growth per outlook quartile; one country gives no deviation."""
    return growth.groupBy("coi_quartile", "base_year").agg(
        F.avg("high_complexity_growth").alias("avg_high_complexity_growth"),
        F.avg("medium_high_growth").alias("avg_medium_high_growth"),
        F.stddev_samp("high_complexity_growth").alias("std_high_complexity_growth"),
        F.stddev_samp("medium_high_growth").alias("std_medium_high_growth"),
        F.count(F.lit(1)).alias("country_count"),
    )


def v_portfolio_evolution(portfolio: DataFrame, dynamics: DataFrame) -> DataFrame:
    """Portfolio shares with the country's rank by complexity among the countries of the year."""
    by_year = Window.partitionBy("year").orderBy(F.col("eci").desc_nulls_last())
    return portfolio.join(dynamics, ["country_id", "year"]).select(
        "country_id", "year", *SHARES, "eci", F.rank().over(by_year).cast("long").alias("eci_rank")
    )


def catalog_views(database: str) -> dict[str, str]:
    """SQL of the views that the catalog keeps, over the metric tables of ``database``."""
    table = f"{database}.".__add__
    shares = ", ".join(f"p.{c}" for c in SHARES)
    dynamics = table("complexity_dynamics")
    return {
        "v_eci_balance_trends": f"""
            SELECT country_id, year, eci, eci_change, trade_balance, balance_change, trend_category
            FROM {dynamics}""",
        "v_export_complexity_portfolio": f"""
            SELECT p.country_id, p.year, {shares}, p.weighted_complexity, d.eci
            FROM {table("export_portfolio")} p JOIN {dynamics} d
            ON p.country_id = d.country_id AND p.year = d.year""",
        "v_diversification_complexity": f"""
            SELECT p.country_id, p.year, p.partner_count, p.partner_hhi, p.concentration_category,
                   d.eci, d.eci_change
            FROM {table("partner_diversification")} p JOIN {dynamics} d
            ON p.country_id = d.country_id AND p.year = d.year""",
        "v_coi_predictive_power": f"""
            SELECT coi_quartile, base_year,
                   avg(high_complexity_growth) AS avg_high_complexity_growth,
                   avg(medium_high_growth) AS avg_medium_high_growth,
                   stddev_samp(high_complexity_growth) AS std_high_complexity_growth,
                   stddev_samp(medium_high_growth) AS std_medium_high_growth,
                   count(*) AS country_count
            FROM {table("coi_growth_analysis")} GROUP BY coi_quartile, base_year""",
        "v_portfolio_evolution": f"""
            SELECT p.country_id, p.year, {shares}, d.eci,
                   CAST(rank() OVER (PARTITION BY p.year ORDER BY d.eci DESC NULLS LAST) AS BIGINT)
                       AS eci_rank
            FROM {table("export_portfolio")} p JOIN {dynamics} d
            ON p.country_id = d.country_id AND p.year = d.year""",
    }
