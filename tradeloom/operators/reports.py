"""Analyst reports and the views they read.

The column names of these views are given; their definitions are our own reading of the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import pct_change, ratio

ECI_UP_BALANCE_DOWN = "ECI improving, balance worsening"
ECI_DOWN_BALANCE_UP = "ECI worsening, balance improving"
SPECIALIST = "High-complexity specialist"
BALANCED = "Balanced high-complexity exporter"
UNKNOWN_CATEGORY = "Unknown"
LOW_EXPORTER = "Low-complexity exporter"


# Views


def v_global_trade_metrics(global_yearly: DataFrame) -> DataFrame:
    """World volume and mean complexity with their change against the previous available year."""
    by_year = Window.orderBy("year")  # one row per year
    volume, eci = F.col("global_trade_volume"), F.col("avg_eci")
    return global_yearly.select(
        "year",
        "global_trade_volume",
        pct_change(volume, F.lag(volume).over(by_year)).alias("trade_volume_pct_change"),
        eci.alias("avg_economic_complexity"),
        pct_change(eci, F.lag(eci).over(by_year), signed_base=True).alias("eci_pct_change"),
    )


def v_top_traded_products(complexity: DataFrame) -> DataFrame:
    """Products with volume, change against their previous available year, and rank in the year."""
    by_product = Window.partitionBy("product_id").orderBy("year")
    volume = F.col("global_export_value")
    return complexity.select(
        "product_id",
        "year",
        volume.alias("global_trade_volume"),
        pct_change(volume, F.lag(volume).over(by_product)).alias("volume_pct_change"),
        F.col("avg_pci").alias("product_complexity_index"),
        F.col("export_rank").alias("rank"),
    )


def v_top_trading_partners(fact: DataFrame) -> DataFrame:
    """Trade of each country with each of its partners, ranked by total within the year."""
    total = F.col("total_trade_with_partner")
    by_total = Window.partitionBy("country_id", "year").orderBy(total.desc())
    return (
        fact.groupBy("country_id", "year", "partner_country_id")
        .agg(
            F.sum("export_value").alias("exports_to_partner"),
            F.sum("import_value").alias("imports_from_partner"),
        )
        .withColumn(
            "total_trade_with_partner", F.col("exports_to_partner") + F.col("imports_from_partner")
        )
        .withColumn("rank", F.rank().over(by_total).cast("long"))
    )


def mv_country_annual_trade(country_year: DataFrame) -> DataFrame:
    return country_year.withColumnRenamed("eci", "economic_complexity_index")


def tier_year_trade(fact: DataFrame, complexity: DataFrame) -> DataFrame:
    """Exports and imports per country, year and complexity tier of the product.

    This is the only step of the segment views that reads the fact; it leaves at most one row per
    tier of a country-year.
    """
    tiers = complexity.select("product_id", "year", "complexity_tier")
    return (
        fact.select("country_id", "product_id", "year", "export_value", "import_value")
        .join(tiers, ["product_id", "year"])
        .groupBy("country_id", "year", "complexity_tier")
        .agg(F.sum("export_value").alias("exports"), F.sum("import_value").alias("imports"))
    )


def _segment(tier: Column) -> Column:
    return F.when(tier == S.HIGH, "high").when(tier == S.LOW, "low").otherwise("medium")


def segment_year_balance(tier_trade: DataFrame) -> DataFrame:
    return (
        tier_trade.groupBy(
            "country_id",
            "year",
            _segment(F.col("complexity_tier")).alias("product_complexity_segment"),
        )
        .agg(F.sum(F.col("exports") - F.col("imports")).alias("balance"))
    )


def v_eci_trade_balance_correlation(country_year: DataFrame, tier_trade: DataFrame) -> DataFrame:
    """Linear trends over the years of a country: index, balance, and balance by segment."""
    trends = country_year.groupBy("country_id").agg(
        F.regr_slope("trade_balance", "year").alias("balance_trend"),
        F.regr_slope("eci", "year").alias("eci_trend"),
    )

    def slope(segment: str) -> Column:
        inside = F.when(F.col("product_complexity_segment") == segment, F.col("balance"))
        return F.regr_slope(inside, F.col("year")).alias(f"{segment}_complexity_balance_trend")

    segments = (
        segment_year_balance(tier_trade)
        .groupBy("country_id")
        .agg(slope("high"), slope("medium"), slope("low"))
    )
    high_exports = F.sum(
        F.when(F.col("complexity_tier") == S.HIGH, F.col("exports")).otherwise(F.lit(0.0))
    )
    concentration = tier_trade.groupBy("country_id").agg(
        ratio(high_exports, F.sum("exports")).alias("complexity_concentration")
    )
    eci, balance = F.col("eci_trend"), F.col("balance_trend")
    category = (
        F.when((eci > 0) & (balance > 0), S.BOTH_IMPROVING)
        .when((eci > 0) & (balance < 0), ECI_UP_BALANCE_DOWN)
        .when((eci < 0) & (balance > 0), ECI_DOWN_BALANCE_UP)
        .when((eci < 0) & (balance < 0), S.BOTH_WORSENING)
    )
    return (
        trends.join(segments, "country_id", "left")
        .join(concentration, "country_id", "left")
        .withColumn("trend_category", category)
    )


def v_product_complexity_balance_trends(tier_trade: DataFrame) -> DataFrame:
    """Slope, mean and correlation with time of each country's balance in each segment."""
    return (
        segment_year_balance(tier_trade)
        .groupBy("country_id", "product_complexity_segment")
        .agg(
            F.regr_slope("balance", "year").alias("segment_balance_trend"),
            F.avg("balance").alias("avg_segment_balance"),
            F.corr("balance", "year").alias("trend_strength"),
        )
    )


def hs_category(fact: DataFrame, digits: int = 6) -> DataFrame:
    """Chapter (leading two digits) of each product code of ``digits`` digits."""
    code = F.lpad(F.col("product_id").cast("string"), digits, "0")
    return (
        fact.select("product_id")
        .distinct()
        .select("product_id", F.substring(code, 1, 2).alias("product_category"))
    )


def v_product_complexity_leaders(
    fact: DataFrame,
    complexity: DataFrame,
    categories: DataFrame,
    tier_trade: DataFrame,
    *,
    specialist_pct: float = 50.0,
    balanced_pct: float = 25.0,
) -> DataFrame:
    """Countries' trade in high-complexity products, rank by its balance, and leading categories.

    ``categories`` maps ``product_id`` to ``product_category``; products that it lacks share the
    category ``UNKNOWN_CATEGORY``. ``leadership_score`` is the mean
    rank of a country over its years.
    """
    high = F.col("complexity_tier") == S.HIGH

    def high_sum(c: str) -> Column:
        return F.sum(F.when(high, F.col(c)))

    trade = (
        tier_trade.groupBy("country_id", "year")
        .agg(
            high_sum("exports").alias("high_complexity_exports"),
            high_sum("imports").alias("high_complexity_imports"),
            F.sum("exports").alias("all_exports"),
        )
        .filter(F.col("high_complexity_exports").isNotNull())
        .withColumn(
            "high_complexity_trade_balance",
            F.col("high_complexity_exports") - F.col("high_complexity_imports"),
        )
        .withColumn(
            "high_complexity_export_pct",
            F.lit(100.0) * ratio(F.col("high_complexity_exports"), F.col("all_exports")),
        )
    )
    # From here on one row per country-year, and per category in the second branch.
    by_balance = Window.partitionBy("year").orderBy(F.col("high_complexity_trade_balance").desc())
    ranked = trade.withColumn("trade_balance_rank", F.rank().over(by_balance).cast("long"))

    # Products are few, so each gets its category before the rows are joined and summed once.
    high_products = (
        complexity.filter(high)
        .select("product_id", "year")
        .join(categories, "product_id", "left")
        .withColumn("product_category", F.coalesce("product_category", F.lit(UNKNOWN_CATEGORY)))
    )
    by_category = (
        fact.filter(F.col("export_value") > 0)
        .select("country_id", "product_id", "year", "export_value")
        .join(high_products, ["product_id", "year"])
        .groupBy("country_id", "year", "product_category")
        .agg(F.sum("export_value").alias("exports"))
    )
    by_exports = Window.partitionBy("country_id", "year").orderBy(
        F.col("exports").desc(), "product_category"
    )

    def place(n: int, name: str) -> Column:
        return F.max(F.when(F.col("place") == n, F.col("product_category"))).alias(name)

    leading = (
        by_category.withColumn("place", F.row_number().over(by_exports))
        .filter(F.col("place") <= 3)
        .groupBy("country_id", "year")
        .agg(
            place(1, "top_product_category"),
            place(2, "second_product_category"),
            place(3, "third_product_category"),
        )
    )
    pct = F.col("high_complexity_export_pct")
    pattern = (
        F.when(pct >= specialist_pct, SPECIALIST)
        .when(pct >= balanced_pct, BALANCED)
        .otherwise(LOW_EXPORTER)
    )
    score = F.avg("trade_balance_rank").over(Window.partitionBy("country_id"))
    return ranked.join(leading, ["country_id", "year"], "left").select(
        "country_id",
        "year",
        "high_complexity_exports",
        "high_complexity_imports",
        "high_complexity_trade_balance",
        "high_complexity_export_pct",
        "trade_balance_rank",
        "top_product_category",
        "second_product_category",
        "third_product_category",
        pattern.alias("specialization_pattern"),
        score.alias("leadership_score"),
    )


# Reports


def rpt_volume_yoy(global_trade: DataFrame, first: int = 2018, last: int = 2022) -> DataFrame:
    return (
        global_trade.filter(F.col("year").between(first, last))
        .select("year", "global_trade_volume", "trade_volume_pct_change")
        .orderBy("year")
    )


def rpt_eci_yoy(global_trade: DataFrame, first: int = 2018, last: int = 2022) -> DataFrame:
    return (
        global_trade.filter(F.col("year").between(first, last))
        .select("year", "avg_economic_complexity", "eci_pct_change")
        .orderBy("year")
    )


def rpt_top_products(products: DataFrame, year: int = 2022, n: int = 5) -> DataFrame:
    return (
        products.filter((F.col("year") == year) & (F.col("rank") <= n))
        .orderBy("rank", "product_id")
        .select("product_id", "global_trade_volume", "volume_pct_change")
    )


def rpt_top_partners(
    partners: DataFrame, country_id: int = 840, year: int = 2022, n: int = 5
) -> DataFrame:
    return (
        partners.filter(
            (F.col("country_id") == country_id) & (F.col("year") == year) & (F.col("rank") <= n)
        )
        .orderBy("rank", "partner_country_id")
        .select(
            "partner_country_id",
            "exports_to_partner",
            "imports_from_partner",
            "total_trade_with_partner",
        )
    )


def rpt_balance_over_time(partners: DataFrame, country_id: int = 840) -> DataFrame:
    exports, imports = F.col("exports_to_partner"), F.col("imports_from_partner")
    return (
        partners.filter(F.col("country_id") == country_id)
        .groupBy("year")
        .agg(
            F.sum(exports).alias("total_exports"),
            F.sum(imports).alias("total_imports"),
            F.sum(exports - imports).alias("trade_balance"),
        )
        .orderBy("year")
    )


def rpt_complex_among_top(
    products: DataFrame, year: int = 2022, rank: int = 20, n: int = 10
) -> DataFrame:
    return (
        products.filter((F.col("year") == year) & (F.col("rank") <= rank))
        .select("product_id", "global_trade_volume", "product_complexity_index")
        .orderBy(F.col("product_complexity_index").desc_nulls_last(), "product_id")
        .limit(n)
    )


def rpt_compare_countries(
    global_trade: DataFrame,
    annual: DataFrame,
    first_country: int = 840,
    second_country: int = 156,
    first: int = 2018,
    last: int = 2022,
) -> DataFrame:
    def profile(country: int, name: str) -> DataFrame:
        return annual.filter(F.col("country_id") == country).select(
            "year",
            F.col("total_exports").alias(f"{name}_exports"),
            F.col("total_imports").alias(f"{name}_imports"),
            F.col("economic_complexity_index").alias(f"{name}_eci"),
        )

    return (
        global_trade.filter(F.col("year").between(first, last))
        .select("year", F.col("avg_economic_complexity").alias("global_avg_eci"))
        .join(profile(first_country, "country1"), "year")
        .join(profile(second_country, "country2"), "year")
        .select(
            "year",
            "global_avg_eci",
            "country1_exports",
            "country1_imports",
            "country2_exports",
            "country2_imports",
            "country1_eci",
            "country2_eci",
        )
        .orderBy("year")
    )


def _steepest_first() -> list[Column]:
    """Equal trends differ in their last bits only; they are ordered by country."""
    return [F.round("eci_trend", 9).desc(), F.col("country_id").asc()]


def rpt_both_improving(correlation: DataFrame, n: int = 10) -> DataFrame:
    return (
        correlation.filter(F.col("trend_category") == S.BOTH_IMPROVING)
        .select(
            "country_id", "balance_trend", "eci_trend", "trend_category", "complexity_concentration"
        )
        .orderBy(*_steepest_first())
        .limit(n)
    )


def rpt_eci_up_balance_down(correlation: DataFrame, n: int = 10) -> DataFrame:
    return (
        correlation.filter(F.col("trend_category") == ECI_UP_BALANCE_DOWN)
        .select(
            "country_id",
            "balance_trend",
            "eci_trend",
            "high_complexity_balance_trend",
            "medium_complexity_balance_trend",
            "low_complexity_balance_trend",
            "complexity_concentration",
        )
        .orderBy(*_steepest_first())
        .limit(n)
    )


def rpt_segment_trends(segment_trends: DataFrame, country_id: int = 840) -> DataFrame:
    return segment_trends.filter(F.col("country_id") == country_id).orderBy(
        "product_complexity_segment"
    )


def rpt_high_complexity_leaders(leaders: DataFrame, year: int = 2022, n: int = 10) -> DataFrame:
    return (
        leaders.filter((F.col("year") == year) & (F.col("trade_balance_rank") <= n))
        .select(
            "country_id",
            "year",
            "high_complexity_exports",
            "high_complexity_imports",
            "high_complexity_trade_balance",
            "high_complexity_export_pct",
            "trade_balance_rank",
            "top_product_category",
            "specialization_pattern",
        )
        .orderBy("trade_balance_rank", "country_id")
    )


def rpt_consistent_leaders(leaders: DataFrame, year: int = 2022, n: int = 15) -> DataFrame:
    return (
        leaders.filter(F.col("year") == year)
        .select(
            "country_id",
            "year",
            "high_complexity_exports",
            "high_complexity_trade_balance",
            "leadership_score",
            "specialization_pattern",
            "top_product_category",
            "second_product_category",
            "third_product_category",
        )
        .orderBy("leadership_score", "country_id")
        .limit(n)
    )


def rpt_category_specialists(leaders: DataFrame, year: int = 2022, n: int = 20) -> DataFrame:
    return (
        leaders.filter(
            (F.col("year") == year) & F.col("specialization_pattern").isin(SPECIALIST, BALANCED)
        )
        .select(
            "country_id",
            "year",
            "top_product_category",
            "specialization_pattern",
            "high_complexity_export_pct",
            "high_complexity_trade_balance",
        )
        .orderBy(F.col("high_complexity_export_pct").desc(), "country_id")
        .limit(n)
    )


def rpt_rank_improvers(leaders: DataFrame, year: int = 2022, n: int = 15) -> DataFrame:
    by_country = Window.partitionBy("country_id").orderBy("year")
    improvement = F.col("prev_rank") - F.col("trade_balance_rank")
    return (
        leaders.select(
            "country_id",
            "year",
            "trade_balance_rank",
            "high_complexity_trade_balance",
            F.lag("trade_balance_rank").over(by_country).alias("prev_rank"),
        )
        .filter((F.col("year") == year) & F.col("prev_rank").isNotNull() & (improvement > 0))
        .select(
            "country_id",
            "year",
            F.col("trade_balance_rank").alias("current_rank"),
            "prev_rank",
            improvement.alias("rank_improvement"),
            "high_complexity_trade_balance",
        )
        .orderBy(F.col("rank_improvement").desc(), "country_id")
        .limit(n)
    )
