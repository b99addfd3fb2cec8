from __future__ import annotations

import pytest
from compare import by_key
from pyspark.sql import functions as F

from tradeloom import schema as S
from tradeloom.operators import insights, reports, views
from tradeloom.operators.views import SHARES

TRENDS = (
    "country_id long, year long, eci double, eci_change double, trade_balance double, "
    "balance_change double, trend_category string"
)
COI = (
    "coi_quartile long, base_year long, avg_high_complexity_growth double, "
    "avg_medium_high_growth double, std_high_complexity_growth double, "
    "std_medium_high_growth double, country_count long"
)
DIVERSIFIED = "country_id long, year long, partner_hhi double, eci double"


def test_tier_shares_add_up_to_one(bench):
    total = sum(F.col(c) for c in SHARES)
    assert bench.portfolio.filter(F.abs(total - 1) > 1e-9).count() == 0


def test_views_drop_first_years(bench):
    first = bench.country_year.agg(F.min("year")).first()[0]
    for view in (bench.portfolio_view, bench.diversification_view, bench.evolution):
        assert view.filter(F.col("year") == first).count() == 0


def test_one_country_in_a_quartile_has_no_deviation(spark):
    growth = spark.createDataFrame(
        [(1, 2016, 0.5, None), (2, 2016, 0.5, 1.0), (2, 2016, 1.5, 3.0)],
        "coi_quartile long, base_year long, high_complexity_growth double, "
        "medium_high_growth double",
    )
    rows = by_key(views.v_coi_predictive_power(growth), "coi_quartile")
    assert rows[(1,)]["std_high_complexity_growth"] is None
    assert rows[(1,)]["avg_medium_high_growth"] is None
    assert rows[(2,)]["std_medium_high_growth"] == pytest.approx(2**0.5)
    assert rows[(2,)]["country_count"] == 2


def test_equal_index_gives_equal_rank(spark):
    portfolio = spark.createDataFrame(
        [(c, 2020, 0.25, 0.25, 0.25, 0.25, 1.0) for c in (1, 2, 3)],
        "country_id long, year long, " + ", ".join(f"{c} double" for c in SHARES)
        + ", weighted_complexity double",
    )
    dynamics = spark.createDataFrame(
        [(1, 2020, 2.0), (2, 2020, 2.0), (3, 2020, 1.0)], "country_id long, year long, eci double"
    )
    rows = by_key(views.v_portfolio_evolution(portfolio, dynamics), "country_id")
    assert [rows[(c,)]["eci_rank"] for c in (1, 2, 3)] == [1, 1, 3]


def test_yoy_needs_the_calendar_year_before(spark):
    world = spark.createDataFrame(
        [(2017, 1.0), (2019, 2.0), (2020, 3.0)], "year long, global_exports double"
    )
    rows = by_key(insights.global_metrics_yoy(world), "year")
    assert rows[(2019,)]["prev_global_exports"] is None
    assert rows[(2020,)]["prev_global_exports"] == 2.0


def trend_rows(spark, points):
    return spark.createDataFrame(
        [(i, 2020, 0.0, x, 0.0, y, S.BOTH_IMPROVING) for i, (x, y) in enumerate(points)], TRENDS
    )


def test_fit_of_a_line(spark):
    row = insights.eci_balance_fit(trend_rows(spark, [(0.0, 1.0), (1.0, 3.0), (2.0, 5.0)])).first()
    assert (row["slope"], row["intercept"]) == (pytest.approx(2.0), pytest.approx(1.0))
    assert (row["x_min"], row["y_min"], row["x_max"], row["y_max"]) == (
        0.0, pytest.approx(1.0), 2.0, pytest.approx(5.0))


@pytest.mark.parametrize("points", [[], [(1.0, 1.0)], [(1.0, 1.0), (1.0, 2.0)]])
def test_no_fit_without_two_x(spark, points):
    assert insights.eci_balance_fit(trend_rows(spark, points)).count() == 0


def test_category_counts(spark):
    rows = spark.createDataFrame(
        [(i, 2020, 0.0, 0.0, 0.0, 0.0, c) for i, c in enumerate(["a", "b", "b", "b"])], TRENDS
    )
    found = [tuple(r) for r in insights.trend_category_counts(rows).collect()]
    assert found == [("b", 3, 75.0), ("a", 1, 25.0)]


def test_single_year_countries(spark):
    rows = spark.createDataFrame(
        [(1, 2020, 0.5), (2, 2020, 0.5), (2, 2021, 0.5)], "country_id long, year long, eci double"
    )
    assert [tuple(r) for r in insights.single_year_countries(rows).collect()] == [(1, 0.5)]


def test_score_without_spread_is_null(spark):
    rows = spark.createDataFrame([(1, 2020, 0.5, 1.0), (2, 2020, 0.25, 1.0)], DIVERSIFIED)
    scored = insights.diversification_score(rows)
    assert [r["combined_score"] for r in scored.collect()] == [None, None]
    assert [r["diversification_score"] for r in scored.orderBy("country_id").collect()] == [.5, .75]
    assert insights.combined_score_top(scored).count() == 0


def test_top_scores(spark):
    rows = spark.createDataFrame(
        [(i, 2020, 0.5, float(i)) for i in range(30)], DIVERSIFIED
    )
    top = insights.combined_score_top(insights.diversification_score(rows)).collect()
    assert [r["country_id"] for r in top] == list(range(29, 9, -1))
    assert top[0]["combined_score"] == pytest.approx(0.75)


def coi_rows(spark, quartiles):
    return spark.createDataFrame(
        [(q, 2016, 0.1 * q, 0.05, 0.01, None, 3) for q in quartiles], COI
    )


def test_quartile_fit_needs_four(spark):
    assert insights.coi_quartile_fit(coi_rows(spark, [1, 2, 4])).count() == 0
    fit = insights.coi_quartile_fit(coi_rows(spark, [1, 2, 3, 4])).orderBy("coi_quartile").collect()
    assert [r["coi_quartile"] for r in fit] == ["Q1", "Q2", "Q3", "Q4"]
    assert fit[3]["fitted"] == pytest.approx(0.4)


def test_growth_long_error_bars_and_table(spark):
    rows = coi_rows(spark, [1])
    long = {r["growth_type"]: r["growth_rate"] for r in insights.coi_growth_long(rows).collect()}
    assert long == {
        "High-complexity export growth": 0.1, "Medium-high complexity export growth": 0.05}
    bars = by_key(insights.coi_growth_error_bars(rows), "growth_type")
    assert bars[("High-complexity export growth",)]["growth_std"] == 0.01
    assert bars[("Medium-high complexity export growth",)]["growth_std"] is None
    table = insights.coi_table(rows).first().asDict()
    assert table["COI Quartile"] == "Q1"
    assert table["High Complexity Growth"] == "10.0%"


def test_latest_index_is_of_the_latest_year_of_all(spark):
    rows = spark.createDataFrame(
        [(1, 2020, 1.239, 1), (1, 2021, 1.239, 2), (2, 2020, 0.5, 3)],
        "country_id long, year long, eci double, eci_rank long",
    )
    assert [tuple(r) for r in insights.latest_eci(rows).collect()] == [(1, 2021, "1.24")]
    ranks = {r["country_id"]: r["eci_rank"] for r in insights.latest_rank(rows).collect()}
    assert ranks == {1: 2, 2: 3}


def test_pct_change_of_index_keeps_its_direction(spark):
    world = spark.createDataFrame(
        [(2019, 0.0, -0.5), (2020, 10.0, -0.25), (2021, 20.0, 0.0), (2022, 20.0, 1.0)],
        "year long, global_trade_volume double, avg_eci double",
    )
    rows = by_key(reports.v_global_trade_metrics(world), "year")
    assert rows[(2020,)]["trade_volume_pct_change"] is None  # from zero
    assert rows[(2021,)]["trade_volume_pct_change"] == 100.0
    assert rows[(2020,)]["eci_pct_change"] == 50.0
    assert rows[(2022,)]["eci_pct_change"] is None


def test_leaders_categories_and_pattern(spark, fact_of):
    fact = fact_of(
        (1, 2, 10, 2022, 60.0, 0.0),
        (1, 2, 11, 2022, 5.0, 20.0),
        (1, 2, 12, 2022, 35.0, 0.0),
        (2, 1, 10, 2022, 0.0, 60.0),
    )
    complexity = spark.createDataFrame(
        [(10, 2022, S.HIGH), (11, 2022, S.HIGH), (12, 2022, S.LOW)],
        "product_id long, year long, complexity_tier string",
    )
    categories = reports.hs_category(
        spark.createDataFrame([(10,), (11,), (12,)], "product_id long"), digits=2
    )
    tier_trade = reports.tier_year_trade(fact, complexity)
    rows = by_key(
        reports.v_product_complexity_leaders(fact, complexity, categories, tier_trade), "country_id"
    )
    one, two = rows[(1,)], rows[(2,)]
    assert (one["top_product_category"], one["second_product_category"]) == ("10", "11")
    assert one["third_product_category"] is None
    assert one["high_complexity_export_pct"] == 65.0
    assert one["specialization_pattern"] == reports.SPECIALIST
    assert one["trade_balance_rank"] == 1
    # Imports alone give a rank but no leading category.
    assert two["top_product_category"] is None
    assert two["high_complexity_export_pct"] is None
    assert two["specialization_pattern"] == reports.LOW_EXPORTER


def test_hs_category_pads_codes(spark):
    rows = spark.createDataFrame([(10121,), (840734,)], "product_id long")
    found = {r["product_id"]: r["product_category"] for r in reports.hs_category(rows).collect()}
    assert found == {10121: "01", 840734: "84"}
