from __future__ import annotations

import random
from collections import defaultdict

import pytest
from compare import by_key
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom import schema as S
from tradeloom.functions import tile_at, tile_end
from tradeloom.operators import complexity, metrics

PY = "product_id long, year long, avg_pci double, global_export_value double"


def ntile(total, n):
    """Tiles of positions 1..total."""
    small, longer = divmod(total, n)
    sizes = [small + 1] * longer + [small] * (n - longer)
    return [tile for tile, size in enumerate(sizes, 1) for _ in range(size)]


@settings(max_examples=15, deadline=None)
@given(total=st.integers(1, 200), n=st.integers(1, 9))
def test_tile_of_position(spark, total, n):
    rows = spark.range(1, total + 1).select(
        tile_at(F.col("id"), F.lit(total).cast("long"), n).alias("tile"),
        *[tile_end(i, F.lit(total).cast("long"), n).alias(f"end{i}") for i in range(n + 1)],
    )
    found = rows.collect()
    expected = ntile(total, n)
    assert [r["tile"] for r in found] == expected
    for i in range(n + 1):
        assert found[0][f"end{i}"] == sum(1 for tile in expected if tile <= i)


def test_product_complexity_ties(spark):
    rows = [(p, 2015, 1.0, 0.0 if p < 7 else float(p)) for p in range(10)]
    rows += [(p, 2016, None if p == 2 else float(-p), 5.0) for p in range(3)]
    rows += [(1, None, 2.0, 3.0)]
    df = spark.createDataFrame(rows, PY)
    found = by_key(complexity.product_complexity(df), "year", "product_id")
    assert len(found) == 14
    assert found[(None, 1)]["complexity_quartile"] == found[(None, 1)]["export_rank"] == 1
    # Equal values are ordered by product; quartile sizes differ by one at most.
    assert [found[(2015, p)]["complexity_quartile"] for p in range(10)] == ntile(10, 4)
    assert [found[(2015, p)]["export_rank"] for p in (9, 8, 7, 6, 0)] == [1, 2, 3, 4, 4]
    # NULL is first; three rows leave the fourth quartile empty.
    assert [found[(2016, p)]["complexity_quartile"] for p in (2, 1, 0)] == [1, 2, 3]
    assert found[(2015, 9)]["complexity_tier"] == S.HIGH
    assert found[(2015, 0)]["complexity_tier"] == S.LOW


def test_portfolio_top_flows_and_products(spark, fact_of):
    flows = [(1, 100 + i, 5, 2015, 1.0, 0.0) for i in range(12)]  # 12 small flows of product 5
    flows += [(1, 100, p, 2015, 2.0, 0.0) for p in range(10, 14)]
    fact = fact_of(*flows, (1, 100, None, 2015, 50.0, 0.0))
    spec = metrics.export_specialization(fact)
    tiers = complexity.product_complexity(metrics.product_year_metrics(fact))
    row = complexity.export_portfolio(spec, tiers).first()
    # Rows without a product are not in the portfolio: 20 in all, 4 * 2 + 6 * 1 in the top ten.
    assert row["top10_concentration"] == pytest.approx(14 / 20)
    assert row["product_diversity"] == 5
    shares = [row[c] for c in row.asDict() if c.endswith("_share")]
    assert sum(shares) == pytest.approx(1.0)
    known = complexity.export_portfolio(spec, tiers, all_products_known=True).first()
    assert known["top10_concentration"] == row["top10_concentration"]
    by_product = complexity.export_portfolio(spec, tiers, by_product=True).first()
    assert by_product["top10_concentration"] == pytest.approx(1.0)


def naive_growth(rows, pci, last_base_year, by_product=False):
    """Pairs of base and target rows, by country and base year, as dictionaries."""
    if by_product:
        sums = defaultdict(float)
        for c, p, y, e in rows:
            sums[(c, p, y)] += e
        rows = [(*k, e) for k, e in sums.items()]
    years = sorted({r[2] for r in rows})
    tiles = []
    for year in years:
        ordered = sorted(
            (r for r in rows if r[2] == year), key=lambda r: (pci[(r[1], year)], r[1], r[0], r[3])
        )
        tiles += zip(ordered, ntile(len(ordered), 4))
    later = dict(zip(years, years[1:]))
    by_key_ = defaultdict(list)
    for c, p, y, e in rows:
        by_key_[(c, p, y)].append(e)
    growth = defaultdict(lambda: [None, None])
    for (c, p, y, e), tile in tiles:
        if y not in later or (last_base_year and y >= last_base_year) or tile < 3:
            continue
        for e2 in by_key_[(c, p, later[y])]:
            slot = 0 if tile == 4 else 1
            growth[(c, y)][slot] = (growth[(c, y)][slot] or 0.0) + (e2 - e) / e
    return {k: v for k, v in growth.items() if v[0] is not None}


@pytest.mark.parametrize("by_product", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_growth_equals_row_pairs(spark, fact_of, by_product, hot):
    """Also when one product has a large part of all rows and so spans several quartiles."""
    random.seed(7)
    seen = {}
    for _ in range(900):
        product = 3 if hot and random.random() < 0.4 else random.randrange(9)
        key = (random.randrange(6), random.randrange(100, 140), product,
               random.choice([2018, 2019, 2021, 2022]))
        seen[key] = float(random.choice([1, 2, 2, 4, 8]))
    pci_of = lambda product: float(product // 2)  # noqa: E731 - ties on purpose
    fact = fact_of(*[(*k, e, 0.0, 0.0, float(k[0]), pci_of(k[2])) for k, e in seen.items()])
    country_year = metrics.country_year_metrics(fact)
    product_year = metrics.product_year_metrics(fact)
    found = by_key(
        complexity.coi_growth_analysis(
            country_year,
            metrics.export_specialization(fact),
            product_year,
            by_product=by_product,
        ),
        "country_id",
        "base_year",
    )
    rows = [(c, p, y, e) for (c, _, p, y), e in seen.items()]
    pci = {(p, y): pci_of(p) for _, p, y, _ in rows}
    expected = naive_growth(rows, pci, S.LAST_BASE_YEAR, by_product)
    assert found.keys() == expected.keys()
    for key, (high, medium) in expected.items():
        assert found[key]["high_complexity_growth"] == pytest.approx(high)
        if medium is None:
            assert found[key]["medium_high_growth"] is None
        else:
            assert found[key]["medium_high_growth"] == pytest.approx(medium)
        assert found[key]["target_year"] == {2018: 2019, 2019: 2021, 2021: 2022}[key[1]]


def test_year_steps(spark):
    years = spark.createDataFrame([(2017,), (2019,), (2022,), (2023,), (2017,)], "year long")
    pairs = {tuple(r) for r in complexity.year_steps(years, 2022).collect()}
    assert pairs == {(2017, 2019), (2019, 2022)}
    assert len(complexity.year_steps(years, None).collect()) == 3
