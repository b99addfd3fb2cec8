from __future__ import annotations

import pytest
from compare import by_key
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schema as S
from tradeloom.operators import metrics, reports

CY = "country_id long, year long, eci double, coi double, trade_balance double"


def test_country_year_counts_ignore_null_and_cover_imports(fact_of):
    fact = fact_of(
        (1, 2, 10, 2015, 5.0, 1.0, 0.5, 0.25),
        (1, 3, 10, 2015, 0.0, 4.0, 0.75, 0.25),
        (1, None, 11, 2015, 2.0, 0.0, 0.5, 0.25),
        (1, 2, None, 2015, 1.0, 0.0, 0.5, 0.25),
        (None, 2, 10, 2015, 7.0, 0.0),
    )
    rows = by_key(metrics.country_year_metrics(fact), "country_id", "year")
    one = rows[(1, 2015)]
    assert (one["eci"], one["total_exports"], one["total_imports"]) == (0.75, 8.0, 5.0)
    assert (one["trade_balance"], one["product_count"], one["partner_count"]) == (3.0, 2, 2)
    assert rows[(None, 2015)]["total_exports"] == 7.0


def test_product_year_mean_is_over_rows(fact_of):
    fact = fact_of(
        (1, 2, 10, 2015, 5.0, 0.0, 0, 0, 1.0),
        (1, 3, 10, 2015, 5.0, 0.0, 0, 0, 1.0),
        (2, 3, 10, 2015, 0.0, 3.0, 0, 0, 4.0),
        (2, 3, 11, 2015, 0.0, 3.0, 0, 0, None),
    )
    rows = by_key(metrics.product_year_metrics(fact), "product_id")
    assert rows[(10,)]["avg_pci"] == 2.0
    assert rows[(10,)]["exporting_countries"] == 2
    assert rows[(11,)]["avg_pci"] is None


def test_metrics_from_stored_totals_are_the_same(bench):
    fact = bench.fact
    for direct, shared in [
        (metrics.country_year_metrics(fact), bench.country_year),
        (metrics.product_year_metrics(fact), bench.product_year),
        (reports.v_top_trading_partners(fact), bench.partners),
    ]:
        assert direct.exceptAll(shared).count() == 0
        assert shared.exceptAll(direct).count() == 0


def test_shares_add_up_to_one(bench):
    spec = bench.specialization
    for keys, share in [
        (["country_id", "year"], "export_share"),
        (["product_id", "year"], "global_market_share"),
    ]:
        totals = spec.groupBy(*keys).agg(F.sum(share).alias("s"))
        assert totals.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_specialization_keeps_null_groups_and_rows(fact_of):
    fact = fact_of(
        (1, 2, None, 2015, 1.0, 0.0), (1, 3, None, 2015, 3.0, 0.0), (1, 3, 5, 2015, 0.0, 3.0)
    )
    shares = sorted(r["global_market_share"] for r in metrics.export_specialization(fact).collect())
    assert shares == [0.25, 0.75]


def test_dynamics_categories(spark):
    rows = spark.createDataFrame(
        [
            (1, 2017, 1.0, 0.0, 10.0),
            (1, 2019, 2.0, 1.0, 11.0),  # gap year: still the previous available year
            (1, 2020, 2.0, 1.0, 12.0),  # no change of the index
            (1, 2021, 3.0, 1.0, 11.0),
            (1, 2022, 2.0, 1.0, 12.0),
            (1, 2023, 1.0, 1.0, 11.0),
            (2, 2020, 1.0, 0.0, 10.0),  # single year
            (3, 2020, None, 0.0, 10.0),
            (3, 2021, 1.0, 0.0, 11.0),
        ],
        CY,
    )
    found = by_key(metrics.complexity_dynamics(rows), "country_id", "year")
    assert {k: v["trend_category"] for k, v in found.items()} == {
        (1, 2019): S.BOTH_IMPROVING,
        (1, 2020): S.BOTH_WORSENING,
        (1, 2021): S.ECI_IMPROVING_ONLY,
        (1, 2022): S.BALANCE_IMPROVING_ONLY,
        (1, 2023): S.BOTH_WORSENING,
    }
    assert found[(1, 2019)]["eci_change"] == 1.0
    fixed = by_key(metrics.complexity_dynamics(rows, corrected=True), "country_id", "year")
    assert len(fixed) == 9
    assert fixed[(1, 2020)]["trend_category"] == S.NO_CHANGE_DATA
    assert fixed[(1, 2023)]["trend_category"] == S.BOTH_WORSENING
    assert fixed[(2, 2020)]["trend_category"] == S.NO_CHANGE_DATA


@pytest.mark.parametrize(
    ("values", "hhi", "band"),
    [
        ([1.0], 1.0, "Highly Concentrated"),
        ([1.0, 1.0], 0.5, "Highly Concentrated"),
        ([1.0, 1.0, 1.0], 1 / 3, "Moderately Concentrated"),
        ([1.0] * 4, 0.25, "Moderately Concentrated"),
        ([1.0] * 5, 0.2, "Moderately Diversified"),
        ([1.0] * 10, 0.1, "Highly Diversified"),
    ],
)
def test_diversification_bands(fact_of, values, hhi, band):
    fact = fact_of(*[(1, 10 + i, 5, 2015, v, 0.0) for i, v in enumerate(values)])
    row = metrics.partner_diversification(metrics.bilateral_flows(fact)).first()
    assert row["partner_count"] == len(values)
    assert row["partner_hhi"] == pytest.approx(hhi)
    assert row["concentration_category"] == band


def test_hhi_bounds(bench):
    outside = bench.diversification.filter(
        (F.col("partner_hhi") > 1 + 1e-9)
        | (F.col("partner_hhi") < 1 / F.col("partner_count") - 1e-9)
    )
    assert outside.count() == 0


def test_empty_fact(spark):
    empty = spark.createDataFrame([], S.FACT_SCHEMA)
    assert metrics.country_year_metrics(empty).count() == 0
    assert metrics.export_specialization(empty).count() == 0
    assert metrics.partner_diversification(metrics.bilateral_flows(empty)).count() == 0


def test_types(bench):
    for df in (bench.country_year, bench.dynamics, bench.evolution, bench.growth, bench.partners):
        for f in df.schema.fields:
            assert isinstance(f.dataType, (T.LongType, T.DoubleType, T.StringType)), f


def test_bitmaps_count_and_add_up(spark):
    values = [(1, 2015, v) for v in (0, 1, 1, 32767, 32768, 32769, 10**12, -1, -32768, None)] + [(2, 2015, 5), (3, 2015, None)]
    rows = spark.createDataFrame(values, "country_id long, year long, v long")
    keys = ["country_id", "year"]
    parts = metrics.distinct_bitmaps(rows, keys, "v").unionByName(metrics.distinct_bitmaps(rows.limit(4), keys, "v"))
    found = metrics.distinct_counts(metrics.added_bitmaps(parts, keys), keys, "n")
    assert {r.country_id: r.n for r in found.collect()} == {1: 8, 2: 1}
