"""Product complexity tiers, export portfolios and growth by complexity outlook."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import (
    between_positions,
    bins_of,
    ratio,
    tier_of,
    tile_at,
    tile_end,
    tile_ends,
    window_tiles,
    with_rank,
)
from ..sources.shared import stored


def product_complexity(product_year: DataFrame, *, n_tiles: int = S.N_TILES) -> DataFrame:
    """Complexity quartile and tier, and export rank, of each product within its year.

    Ties in ``avg_pci`` are ordered by product; a NULL year is a year like any other. ``product_year``
    is read several times, so it should be a stored table. Nothing is sorted but what lies around the
    ends of the quartiles, and ranges of exports for the rank.
    """
    rows = product_year.select("product_id", "year", "avg_pci", "global_export_value")
    bins = bins_of(rows, ["year"], ["avg_pci", "global_export_value"])
    order = ["avg_pci", "product_id"]
    placed = between_positions(rows, ["year"], order, tile_ends(n_tiles), bins=bins)
    tiled = placed.select(
        *rows.columns,
        tile_at(F.col("before") + 1, F.col("total"), n_tiles).alias("complexity_quartile"),
    )
    ranked = with_rank(tiled, ["year"], "global_export_value", "export_rank", bins)
    return ranked.select(
        "product_id",
        "year",
        "avg_pci",
        "complexity_quartile",
        tier_of(F.col("complexity_quartile")).alias("complexity_tier"),
        "global_export_value",
        "export_rank",
    )


def export_portfolio(
    specialization: DataFrame,
    complexity: DataFrame,
    *,
    products: DataFrame | None = None,
    top_n: int = S.TOP_FLOWS,
    by_product: bool = False,
    all_products_known: bool = False,
) -> DataFrame:
    """Tier shares, weighted complexity, product count and top-flow concentration per country-year.

    The concentration is over the largest rows, that is, flows of one product to one partner;
    ``by_product=True`` takes the largest products instead. ``products`` may give the sums of
    ``export_value`` and ``export_share`` per country, product and year if they are stored.
    ``all_products_known=True`` states that ``complexity`` covers each non-NULL product and year of
    ``specialization`` (as it does when both come from one fact table); the top flows then need no
    join.
    """
    if products is None:
        products = specialization.groupBy("country_id", "product_id", "year").agg(
            F.sum("export_value").alias("export_value"),
            F.sum("export_share").alias("export_share"),
        )
    tiers = complexity.select("product_id", "year", "avg_pci", "complexity_tier")

    def tier_sum(tier: str):
        return F.sum(
            F.when(F.col("complexity_tier") == tier, F.col("export_value")).otherwise(F.lit(0.0))
        )

    portfolio = (
        products.join(tiers, ["product_id", "year"])
        .groupBy("country_id", "year")
        .agg(
            tier_sum(S.HIGH).alias("high"),
            tier_sum(S.MEDIUM_HIGH).alias("medium_high"),
            tier_sum(S.MEDIUM_LOW).alias("medium_low"),
            tier_sum(S.LOW).alias("low"),
            F.sum(F.col("export_share") * F.col("avg_pci")).alias("weighted_complexity"),
            F.count(F.lit(1)).alias("product_diversity"),
            F.sum("export_value").alias("exports"),
        )
    )

    sizes = products if by_product else specialization
    sizes = sizes.select("country_id", "year", "product_id", "export_value")
    if all_products_known:
        sizes = sizes.filter(F.col("product_id").isNotNull())
    else:
        sizes = sizes.join(tiers.select("product_id", "year"), ["product_id", "year"], "left_semi")
    # The rank filter becomes a group limit below the shuffle: each task sends at most top_n rows
    # per country-year. Ties cannot change the sum.
    largest = Window.partitionBy("country_id", "year").orderBy(F.col("export_value").desc())
    top = (
        sizes.withColumn("flow_rank", F.row_number().over(largest))
        .filter(F.col("flow_rank") <= top_n)
        .groupBy("country_id", "year")
        .agg(F.sum("export_value").alias("top_exports"))
    )
    # Both have one row per country-year; aggregating their union pairs NULL countries as well.
    paired = portfolio.unionByName(top, allowMissingColumns=True).groupBy("country_id", "year")
    measures = [c for c in portfolio.columns if c not in ("country_id", "year")]
    exports = F.col("exports")
    return paired.agg(*[F.max(c).alias(c) for c in [*measures, "top_exports"]]).select(
        "country_id",
        "year",
        ratio(F.col("high"), exports).alias("high_complexity_share"),
        ratio(F.col("medium_high"), exports).alias("medium_high_share"),
        ratio(F.col("medium_low"), exports).alias("medium_low_share"),
        ratio(F.col("low"), exports).alias("low_complexity_share"),
        "weighted_complexity",
        "product_diversity",
        ratio(F.col("top_exports"), exports).alias("top10_concentration"),
    )


def year_steps(country_year: DataFrame, last_base_year: int | None) -> DataFrame:
    """Each base year with the next available year; ``None`` allows every year that has one."""
    years = country_year.select("year").distinct()
    # One row per year, so a window over all of them is small by construction.
    steps = years.select(
        F.col("year").alias("base_year"),
        F.lead("year").over(Window.orderBy("year")).alias("target_year"),
    ).filter(F.col("target_year").isNotNull())
    if last_base_year is not None:
        steps = steps.filter(F.col("base_year") < last_base_year)
    return steps


def export_totals(rows: DataFrame) -> DataFrame:
    """Row count, sum and sum of inverses of exports per country, product and year."""
    return rows.groupBy("country_id", "product_id", "year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("export_value").alias("value_sum"),
        F.sum(ratio(F.lit(1.0), F.col("export_value"))).alias("inverse_sum"),
    )


def _with_target(totals: DataFrame, steps: DataFrame) -> DataFrame:
    """Add the next available year's sum and row count to country-product-year totals.

    A country-product has one row per year, so the windows are small, and looking one row ahead
    replaces the join of the table with itself.
    """
    ahead = Window.partitionBy("country_id", "product_id").orderBy("year")
    return (
        totals.withColumn("_next", F.lead("year").over(ahead))
        .withColumn("target_sum", F.lead("value_sum").over(ahead))
        .withColumn("target_rows", F.lead("n_rows").over(ahead))
        .join(
            F.broadcast(steps),  # one row per year
            (F.col("year") == F.col("base_year")) & (F.col("_next") == F.col("target_year")),
        )
        .drop("_next")
    )


def coi_growth_analysis(
    country_year: DataFrame,
    specialization: DataFrame,
    product_year: DataFrame,
    *,
    totals: DataFrame | None = None,
    last_base_year: int | None = S.LAST_BASE_YEAR,
    n_tiles: int = S.N_TILES,
    by_product: bool = False,
) -> DataFrame:
    """Export growth in the two upper complexity quartiles, by country and base year.

    Quartiles are over export rows ordered by their product's ``avg_pci``. The growth of a country
    is the sum of (e2 - e1) / e1 over all pairs of a base row and a target row of the same product,
    the target being the next available year. Three rewrites keep this from growing with the
    number of pairs or from sorting the fact:

    * With S2 and n2 the sum and number of target rows, the pairs of one base row add up to
      S2 / e1 - n2. Hence per country, product and year only the row count, the value sum and the
      sum of 1 / e1 are needed, and no pair is ever formed. ``totals`` may give these stored.
    * Rows of one product are neighbours in the quartile order, so the running row counts of
      products give the quartile of all its rows, except for the at most ``n_tiles - 1`` products
      per year that straddle a boundary.
    * For these the same is done on (product, country, value), rows equal in which are
      interchangeable; that is also how ties in ``avg_pci`` are ordered.

    ``by_product=True`` sums each country's product over partners before growth is taken, so that
    it no longer depends on the number of partners.
    """
    rows = specialization.filter(F.col("product_id").isNotNull()).select(
        "country_id", "product_id", "year", "export_value"
    )
    if totals is None:
        totals = stored(export_totals(rows), "export-totals")
    totals = totals.filter(F.col("product_id").isNotNull())
    if by_product:
        totals = totals.select(
            "country_id",
            "product_id",
            "year",
            F.lit(1).cast("long").alias("n_rows"),
            "value_sum",
            ratio(F.lit(1.0), F.col("value_sum")).alias("inverse_sum"),
        )
        rows = totals.select(
            "country_id", "product_id", "year", F.col("value_sum").alias("export_value")
        )
    steps = year_steps(country_year, last_base_year)
    products = product_ranges(totals, product_year, n_tiles)

    upper, lower = n_tiles, n_tiles - 1
    # Only products with rows in the upper tiles of some year count; their next year is looked up
    # once for both kinds of products.
    reaching = products.filter(F.col("last_tile") >= lower).select("product_id").distinct()
    targets = stored(
        _with_target(totals.join(reaching, "product_id", "left_semi"), steps), "targets"
    )
    tile = F.col("first_tile")
    in_one_tile = products.filter((tile == F.col("last_tile")) & (tile >= lower))
    pair_sum = F.col("target_sum") * F.col("inverse_sum") - F.col("target_rows") * F.col("n_rows")
    whole = (
        targets.join(in_one_tile.select("product_id", "year", "first_tile"), ["product_id", "year"])
        .select(
            "country_id",
            "base_year",
            "target_year",
            F.when(tile == upper, pair_sum).alias("high"),
            F.when(tile == lower, pair_sum).alias("medium"),
        )
    )
    split = _straddling_growth(rows, targets, products, n_tiles)
    growth = (
        whole.unionByName(split)
        .groupBy("country_id", "base_year", "target_year")
        .agg(
            F.sum("high").alias("high_complexity_growth"),
            F.sum("medium").alias("medium_high_growth"),
        )
        .filter(F.col("high_complexity_growth").isNotNull())
    )
    coi = country_year.select("country_id", F.col("year").alias("base_year"), "coi")
    return growth.join(coi, ["country_id", "base_year"]).select(
        "country_id",
        "base_year",
        "coi",
        window_tiles(
            n_tiles,
            ["base_year"],
            [F.col("coi").asc_nulls_first(), F.col("country_id").asc()],
        ).alias("coi_quartile"),
        "high_complexity_growth",
        "medium_high_growth",
        "target_year",
    )


def product_ranges(totals: DataFrame, product_year: DataFrame, n_tiles: int) -> DataFrame:
    """First and last quartile of each product's export rows within its year, as a stored table."""
    counts = stored(
        totals.groupBy("product_id", "year")
        .agg(F.sum("n_rows").alias("n_rows"))
        .join(product_year.select("product_id", "year", "avg_pci"), ["product_id", "year"]),
        "product-rows",
    )
    placed = between_positions(
        counts, ["year"], ["avg_pci", "product_id"], tile_ends(n_tiles), "n_rows"
    )
    before, total = F.col("before"), F.col("total")
    return stored(
        placed.select(
            "product_id",
            "year",
            "n_rows",
            "before",
            "total",
            tile_at(before + 1, total, n_tiles).alias("first_tile"),
            tile_at(before + F.col("n_rows"), total, n_tiles).alias("last_tile"),
        ),
        "product-tiles",
    )


def _straddling_growth(
    rows: DataFrame, targets: DataFrame, products: DataFrame, n_tiles: int
) -> DataFrame:
    """Growth terms of the products whose rows lie in more than one quartile."""
    # At most n_tiles - 1 products per year.
    in_several = products.filter(F.col("first_tile") < F.col("last_tile"))
    straddling = in_several.select(
        "product_id",
        "year",
        F.col("before").alias("product_before"),
        F.col("total").alias("year_rows"),
    )
    before = {(r["product_id"], r["year"]): r for r in straddling.collect()}
    targets = targets.select(
        "country_id", "product_id", "year", "base_year", "target_year", "target_sum", "target_rows"
    )
    copies = stored(
        rows.join(F.broadcast(straddling), ["product_id", "year"])
        .groupBy("product_id", "year", "product_before", "year_rows", "country_id", "export_value")
        .agg(F.count(F.lit(1)).alias("n")),
        "straddling-rows",
    )

    def ends_inside(product_year: tuple, n_rows: int) -> list[int]:
        of = before[product_year]
        ends = tile_ends(n_tiles)((), of["year_rows"])
        return [end - of["product_before"] for end in ends]

    placed = between_positions(
        copies, ["product_id", "year"], ["country_id", "export_value"], ends_inside, "n"
    ).withColumn("first", F.col("product_before") + F.col("before"))

    def in_tile(tile: int):
        start = tile_end(tile - 1, F.col("year_rows"), n_tiles)
        end = tile_end(tile, F.col("year_rows"), n_tiles)
        inside = F.least(F.col("first") + F.col("n"), end) - F.greatest(F.col("first"), start)
        return F.greatest(inside, F.lit(0).cast("long"))

    upper, lower = n_tiles, n_tiles - 1
    value = F.col("export_value")
    weights = placed.groupBy("country_id", "product_id", "year").agg(
        F.sum(in_tile(upper)).alias("upper_rows"),
        F.sum(ratio(in_tile(upper), value)).alias("upper_inverse"),
        F.sum(in_tile(lower)).alias("lower_rows"),
        F.sum(ratio(in_tile(lower), value)).alias("lower_inverse"),
    )

    def pair_sum(side: str):
        n, inverse = F.col(f"{side}_rows"), F.col(f"{side}_inverse")
        return F.when(n > 0, F.col("target_sum") * inverse - F.col("target_rows") * n)

    return weights.join(targets, ["country_id", "product_id", "year"]).select(
        "country_id",
        "base_year",
        "target_year",
        pair_sum("upper").alias("high"),
        pair_sum("lower").alias("medium"),
    )
