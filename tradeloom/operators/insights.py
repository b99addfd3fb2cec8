"""Data steps behind the dashboard pages. Each takes a table or view and stays lazy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import fixed_text, label_of, percent_text, quartile_text, ratio
from .views import SHARES


# Selectors


def available_years(fact: DataFrame) -> DataFrame:
    return fact.select("year").distinct().orderBy("year")


def available_countries(fact: DataFrame) -> DataFrame:
    return fact.select("country_id").distinct().orderBy("country_id")


# Overview


def global_metrics(global_yearly: DataFrame) -> DataFrame:
    return global_yearly.orderBy("year")


def global_metrics_yoy(global_yearly: DataFrame) -> DataFrame:
    """Each year's metrics beside those of the calendar year before, NULL where that is missing."""
    columns = [c for c in global_yearly.columns if c != "year"]
    before = global_yearly.select(
        (F.col("year") + 1).alias("year"), *[F.col(c).alias(f"prev_{c}") for c in columns]
    )
    return global_yearly.join(before, "year", "left")


def top_countries(country_year: DataFrame, year: int, n: int = 15) -> DataFrame:
    return (
        country_year.filter(F.col("year") == year)
        .select(
            "country_id",
            (F.col("total_exports") + F.col("total_imports")).alias("trade_volume"),
            "total_exports",
            "total_imports",
            "eci",
        )
        .orderBy(F.col("trade_volume").desc(), "country_id")
        .limit(n)
    )


# Complexity against trade balance


def eci_balance_for_year(trends: DataFrame, year: int) -> DataFrame:
    return trends.select("*").filter(F.col("year") == year)


def trend_split(trends: DataFrame, *, with_change: bool) -> DataFrame:
    no_change = F.col("trend_category") == S.NO_CHANGE_DATA
    return trends.filter(~no_change if with_change else no_change)


def eci_balance_fit(trends: DataFrame) -> DataFrame:
    """Least-squares line of balance change on complexity change, with its end points.

    No row unless there are two points with different x.
    """
    x, y = F.col("eci_change"), F.col("balance_change")
    both = x.isNotNull() & y.isNotNull()
    fit = trends.filter(both).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
        F.count(F.lit(1)).alias("points"),
    )
    slope, intercept = F.col("slope"), F.col("intercept")
    return fit.filter((F.col("points") > 1) & slope.isNotNull()).select(
        "slope",
        "intercept",
        "x_min",
        (slope * F.col("x_min") + intercept).alias("y_min"),
        "x_max",
        (slope * F.col("x_max") + intercept).alias("y_max"),
    )


def category_counts(rows: DataFrame, category: str) -> DataFrame:
    """Frequency and percent of each category. The window sees one row per category."""
    counts = rows.groupBy(category).agg(F.count(F.lit(1)).alias("country_count"))
    share = F.col("country_count") / F.sum("country_count").over(Window.partitionBy())
    return counts.withColumn("percent", F.lit(100.0) * share).orderBy(
        F.col("country_count").desc(), category
    )


def trend_category_counts(trends: DataFrame) -> DataFrame:
    return category_counts(trends, "trend_category")


def concentration_category_counts(diversification: DataFrame) -> DataFrame:
    return category_counts(diversification, "concentration_category")


def single_year_countries(country_year: DataFrame) -> DataFrame:
    """Countries with one year of data, which have no change to show."""
    return (
        country_year.groupBy("country_id")
        .agg(F.count(F.lit(1)).alias("years"), F.max("eci").alias("eci"))
        .filter(F.col("years") == 1)
        .select("country_id", "eci")
    )


# Export portfolio


def export_portfolio_for_year(portfolio_view: DataFrame, year: int) -> DataFrame:
    return portfolio_view.filter(F.col("year") == year).orderBy(F.col("eci").desc(), "country_id")


def of_countries(rows: DataFrame, countries: Sequence[int] | DataFrame) -> DataFrame:
    """Rows of the listed countries, or of those in the ``country_id`` column of a DataFrame."""
    if isinstance(countries, DataFrame):
        return rows.join(countries.select("country_id"), "country_id", "left_semi")
    return rows.filter(F.col("country_id").isin(*countries))


def export_portfolio_for_countries(
    portfolio_view: DataFrame, year: int, countries: Sequence[int] | DataFrame
) -> DataFrame:
    return export_portfolio_for_year(of_countries(portfolio_view, countries), year)


def shares_long(rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per complexity tier, with the tier's display name."""
    long = rows.unpivot(list(ids), SHARES, "complexity_tier", "share")
    return long.withColumn("complexity_tier", label_of(F.col("complexity_tier"), S.SHARE_LABELS))


def portfolio_long(portfolio_rows: DataFrame) -> DataFrame:
    return shares_long(portfolio_rows, ["country_id", "eci"])


def portfolio_table(portfolio_rows: DataFrame) -> DataFrame:
    return portfolio_rows.withColumns({c: percent_text(F.col(c)) for c in SHARES}).select(
        F.col("country_id").alias("Country"),
        F.col("eci").alias("ECI"),
        F.col("high_complexity_share").alias("High Complexity"),
        F.col("medium_high_share").alias("Medium-High"),
        F.col("medium_low_share").alias("Medium-Low"),
        F.col("low_complexity_share").alias("Low Complexity"),
        F.col("weighted_complexity").alias("Weighted Complexity"),
    )


# Partner diversification


def partner_diversification_for_year(diversification_view: DataFrame, year: int) -> DataFrame:
    return diversification_view.filter(F.col("year") == year).orderBy("partner_hhi", "country_id")


def diversification_score(rows: DataFrame) -> DataFrame:
    """Mean of diversification (1 - HHI) and complexity scaled to 0..1 within the year.

    The combined score is NULL in a year in which all countries have the same index.
    """
    countries = Window.partitionBy("year")
    low, high = F.min("eci").over(countries), F.max("eci").over(countries)
    return (
        rows.withColumn("diversification_score", F.lit(1.0) - F.col("partner_hhi"))
        .withColumn("eci_scaled", ratio(F.col("eci") - low, high - low))
        .withColumn(
            "combined_score", (F.col("diversification_score") + F.col("eci_scaled")) / F.lit(2.0)
        )
        .drop("eci_scaled")
    )


def combined_score_top(scored: DataFrame, n: int = 20) -> DataFrame:
    """Mean score of the countries that hold the ``n`` best rows, best first.

    ``scored`` has one row per country and year, so one task can put them in order.
    """
    best = Window.orderBy(F.col("combined_score").desc_nulls_last(), "country_id")
    return (
        scored.withColumn("place", F.row_number().over(best))
        .groupBy("country_id")
        .agg(F.avg("combined_score").alias("combined_score"), F.min("place").alias("place"))
        .filter(F.col("combined_score").isNotNull() & (F.col("place") <= n))
        .orderBy(F.col("combined_score").desc(), "country_id")
        .drop("place")
    )


# Complexity outlook


def coi_predictive_power(predictive: DataFrame) -> DataFrame:
    return predictive.orderBy("base_year", "coi_quartile")


def base_years(predictive: DataFrame) -> DataFrame:
    return predictive.select("base_year").distinct().orderBy("base_year")


def coi_for_base_year(predictive: DataFrame, base_year: int) -> DataFrame:
    return predictive.filter(F.col("base_year") == base_year)


def coi_growth_long(coi_rows: DataFrame) -> DataFrame:
    long = coi_rows.unpivot(
        ["coi_quartile", "base_year"], list(S.GROWTH_LABELS), "growth_type", "growth_rate"
    )
    return long.withColumn(
        "growth_type", label_of(F.col("growth_type"), S.GROWTH_LABELS)
    ).withColumn("coi_quartile", quartile_text(F.col("coi_quartile")))


def coi_growth_error_bars(coi_rows: DataFrame) -> DataFrame:
    """Mean and deviation of both growth measures side by side, one row per measure."""
    bars = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(label).alias("growth_type"),
                    F.col(average).alias("growth_avg"),
                    F.col(average.replace("avg_", "std_")).alias("growth_std"),
                )
                for average, label in S.GROWTH_LABELS.items()
            ]
        )
    )
    return coi_rows.select(
        quartile_text(F.col("coi_quartile")).alias("coi_quartile"), "base_year", bars.alias("bar")
    ).select("coi_quartile", "base_year", "bar.*")


def coi_quartile_fit(coi_rows: DataFrame) -> DataFrame:
    """Line of mean high-complexity growth over quartiles 1 to 4, with its four points.

    Only for base years that have all four quartiles.
    """
    x, y = F.col("coi_quartile"), F.col("avg_high_complexity_growth")
    fit = (
        coi_rows.groupBy("base_year")
        .agg(
            F.regr_slope(y, x).alias("slope"),
            F.regr_intercept(y, x).alias("intercept"),
            F.count(y).alias("quartiles"),
        )
        .filter(F.col("quartiles") == 4)
    )
    quartile = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long")))
    return fit.select("base_year", "slope", "intercept", quartile.alias("q")).select(
        "base_year",
        "slope",
        "intercept",
        quartile_text(F.col("q")).alias("coi_quartile"),
        (F.col("slope") * F.col("q") + F.col("intercept")).alias("fitted"),
    )


def coi_table(coi_rows: DataFrame) -> DataFrame:
    return coi_rows.select(
        quartile_text(F.col("coi_quartile")).alias("COI Quartile"),
        F.col("base_year").alias("Base Year"),
        percent_text(F.col("avg_high_complexity_growth")).alias("High Complexity Growth"),
        percent_text(F.col("avg_medium_high_growth")).alias("Medium-High Growth"),
        F.col("country_count").alias("Number of Countries"),
    )


# Portfolio evolution


def top_ranked_countries(evolution: DataFrame, n: int = 16) -> DataFrame:
    return (
        evolution.groupBy("country_id")
        .agg(F.avg("eci_rank").alias("avg_rank"))
        .orderBy("avg_rank", "country_id")
        .limit(n)
    )


def portfolio_evolution_for_countries(
    evolution: DataFrame, countries: Sequence[int] | DataFrame
) -> DataFrame:
    return of_countries(evolution, countries).orderBy("year", "country_id")


def evolution_long(evolution_rows: DataFrame, *, with_rank: bool = True) -> DataFrame:
    ids = ["country_id", "year", "eci"] + (["eci_rank"] if with_rank else [])
    return shares_long(evolution_rows, ids)


def latest_rank(evolution_rows: DataFrame) -> DataFrame:
    return evolution_rows.groupBy("country_id").agg(F.max_by("eci_rank", "year").alias("eci_rank"))


def latest_eci(evolution_rows: DataFrame) -> DataFrame:
    """Index text of the countries that have data in the latest year of all given rows."""
    latest = evolution_rows.agg(F.max("year").alias("year"))  # one row
    return evolution_rows.join(F.broadcast(latest), "year", "left_semi").select(
        "country_id", "year", fixed_text(F.col("eci")).alias("eci_text")
    )
