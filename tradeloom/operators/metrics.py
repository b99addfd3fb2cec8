"""Metric tables computed from the combined fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import ratio


def country_product_year(fact: DataFrame) -> DataFrame:
    """Totals over partners per country, product and year: the base of most metric tables.

    It is the one large shuffle that these tables share, so a pipeline stores it and passes it on
    as ``by_product``. Rows combine on the map side, so no country or product, however large,
    sends more than its distinct keys.
    """
    return added_product_totals(product_totals_of_rows(fact))


def product_totals_of_rows(fact: DataFrame) -> DataFrame:
    """``country_product_year`` of each row by itself, without a shuffle."""
    exports = F.col("export_value")
    return fact.select(
        "country_id",
        "product_id",
        "year",
        "eci",
        "coi",
        F.col("pci").alias("pci_sum"),
        F.col("pci").isNotNull().cast("long").alias("pci_rows"),
        "export_value",
        "import_value",
        (exports - F.col("import_value")).alias("trade_balance"),
        F.when(exports > 0, 1).otherwise(0).cast("long").alias("export_rows"),
        F.when(exports > 0, F.lit(1.0) / exports).alias("inverse_exports"),
    )


def added_product_totals(parts: DataFrame) -> DataFrame:
    """``country_product_year`` of a fact from those of its parts: every column is a sum or a maximum.

    A part may be a single row, so rows are added to older totals in one shuffle.
    """
    maxima = ("eci", "coi")
    keys = ["country_id", "product_id", "year"]
    measures = [c for c in parts.columns if c not in keys]
    return parts.groupBy(*keys).agg(
        *[(F.max(c) if c in maxima else F.sum(c)).alias(c) for c in measures]
    )


def partner_totals_of_rows(fact: DataFrame) -> DataFrame:
    """``country_partner_year`` of each row by itself; ``country_partner_year`` adds them up."""
    return fact.select("country_id", "partner_country_id", "year", "export_value", "import_value")


def country_partner_year(fact: DataFrame) -> DataFrame:
    """Totals over products per country, partner and year, for results that need no products."""
    return fact.groupBy("country_id", "partner_country_id", "year").agg(
        F.sum("export_value").alias("export_value"), F.sum("import_value").alias("import_value")
    )


def country_year_metrics(
    fact: DataFrame,
    *,
    by_product: DataFrame | None = None,
    by_partner: DataFrame | None = None,
) -> DataFrame:
    """Indices, trade totals and distinct product and partner counts per country and year.

    Two distinct counts in one aggregate would expand every fact row three times. Instead the fact
    is reduced once by product (carrying the sums) and once by partner, and both reductions meet
    in one small aggregate.
    """
    if by_product is None:
        by_product = country_product_year(fact)
    sums = by_product.select(
        "country_id", "year", "product_id", "eci", "coi", "export_value", "import_value",
        "trade_balance",
    )
    if by_partner is None:
        by_partner = fact.select("country_id", "year", "partner_country_id").distinct()
    partners = by_partner.select("country_id", "year", "partner_country_id")
    return (
        sums.unionByName(partners, allowMissingColumns=True)
        .groupBy("country_id", "year")
        .agg(
            F.max("eci").alias("eci"),
            F.max("coi").alias("coi"),
            F.sum("export_value").alias("total_exports"),
            F.sum("import_value").alias("total_imports"),
            F.sum("trade_balance").alias("trade_balance"),
            F.count("product_id").alias("product_count"),
            F.count("partner_country_id").alias("partner_count"),
        )
    )


def distinct_bitmaps(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Which values of an integer column each group has, as bitmaps of 32,768 values each.

    Bits are set on the map side, so the shuffle has one row per group, range of values and task.
    """
    known = rows.where(F.col(column).isNotNull())
    return known.groupBy(
        *keys, F.expr(f"bitmap_bucket_number({column})").alias("bucket")
    ).agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({column}))").alias("bits"))


def added_bitmaps(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``distinct_bitmaps`` of all rows from those of their parts."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Exact number of distinct values of each group that has any."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def product_year_metrics(fact: DataFrame, *, by_product: DataFrame | None = None) -> DataFrame:
    """Mean complexity, world exports and number of reporting countries per product and year.

    The mean is over fact rows, so a country counts once per partner.
    """
    if by_product is None:
        by_product = country_product_year(fact)
    return by_product.groupBy("product_id", "year").agg(
        ratio(F.sum("pci_sum"), F.sum("pci_rows")).alias("avg_pci"),
        F.sum("export_value").alias("global_export_value"),
        F.count("country_id").alias("exporting_countries"),
    )


def partner_flows(rows: DataFrame) -> DataFrame:
    """Positive exports to known partners, with the two countries named by their role."""
    return rows.filter(
        F.col("partner_country_id").isNotNull() & (F.col("export_value") > 0)
    ).withColumnsRenamed({"country_id": "exporter_id", "partner_country_id": "importer_id"})


def bilateral_flows(fact: DataFrame) -> DataFrame:
    """Directed export flows with a known partner."""
    return partner_flows(fact).select(
        "exporter_id", "importer_id", "product_id", "year", "export_value", "pci"
    )


def country_export_totals(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("export_value") > 0)
        .groupBy("country_id", "year")
        .agg(F.sum("export_value").alias("country_total"))
    )


def product_export_totals(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("export_value") > 0)
        .groupBy("product_id", "year")
        .agg(F.sum("export_value").alias("product_total"))
    )


def positive_exports(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("export_value") > 0)


def stored_export_totals(by_product: DataFrame) -> DataFrame:
    """Count, sum and sum of inverses of export rows, taken from ``country_product_year``."""
    return by_product.filter(F.col("export_rows") > 0).select(
        "country_id",
        "product_id",
        "year",
        F.col("export_rows").alias("n_rows"),
        F.col("export_value").alias("value_sum"),
        F.col("inverse_exports").alias("inverse_sum"),
    )


def with_country_share(rows: DataFrame, country_totals: DataFrame) -> DataFrame:
    """Add ``export_share``, the row's part of its country's exports of the year."""
    totals = country_totals.select(
        F.col("country_id").alias("_c"), F.col("year").alias("_y"), "country_total"
    )
    # Null-safe, as NULL is one group of a window too.
    same = F.col("country_id").eqNullSafe(F.col("_c")) & (F.col("year") == F.col("_y"))
    return (
        rows.join(totals, same)
        .withColumn("export_share", F.col("export_value") / F.col("country_total"))
        .drop("_c", "_y", "country_total")
    )


def export_specialization(
    fact: DataFrame,
    *,
    country_totals: DataFrame | None = None,
    product_totals: DataFrame | None = None,
) -> DataFrame:
    """Share of each export row in its country's and in its product's yearly exports.

    The totals are joined rather than computed as windows: a window would sort the whole fact
    twice and put each country-year in one task. Stored totals may be passed in; Spark then knows
    their size and broadcasts them when small, and a hot key of the fact is split by AQE when not.
    """
    rows = positive_exports(fact).select(
        "country_id", "product_id", "year", "export_value", "pci"
    )
    by_country = country_totals if country_totals is not None else country_export_totals(fact)
    by_product = product_totals if product_totals is not None else product_export_totals(fact)
    totals = by_product.select(
        F.col("product_id").alias("_p"), F.col("year").alias("_y"), "product_total"
    )
    same = F.col("product_id").eqNullSafe(F.col("_p")) & (F.col("year") == F.col("_y"))
    return (
        with_country_share(rows, by_country)
        .join(totals, same)
        .withColumn("global_market_share", F.col("export_value") / F.col("product_total"))
        .drop("_p", "_y", "product_total")
    )


def complexity_dynamics(country_year: DataFrame, *, corrected: bool = False) -> DataFrame:
    """Change of complexity and balance against the country's previous available year.

    A change of zero counts as worsening, and each country's first year is left out. With
    ``corrected=True`` only two negative changes are 'Both worsening', a change of zero gives
    'No change data', and so do first years, which are kept.
    """
    by_country = Window.partitionBy("country_id").orderBy("year")
    previous = country_year.select(
        "country_id",
        "year",
        "eci",
        "coi",
        "trade_balance",
        F.lag("eci").over(by_country).alias("prev_eci"),
        F.lag("coi").over(by_country).alias("prev_coi"),
        F.lag("trade_balance").over(by_country).alias("prev_balance"),
    )
    if not corrected:
        previous = previous.filter(
            F.col("prev_eci").isNotNull() & F.col("prev_balance").isNotNull()
        )
    eci_change = F.col("eci_change")
    balance_change = F.col("balance_change")
    category = (
        F.when((eci_change > 0) & (balance_change > 0), S.BOTH_IMPROVING)
        .when((eci_change > 0) & (balance_change < 0), S.ECI_IMPROVING_ONLY)
        .when((eci_change < 0) & (balance_change > 0), S.BALANCE_IMPROVING_ONLY)
    )
    if corrected:
        category = category.when((eci_change < 0) & (balance_change < 0), S.BOTH_WORSENING)
        category = category.otherwise(S.NO_CHANGE_DATA)
    else:
        category = category.otherwise(S.BOTH_WORSENING)
    return previous.select(
        "country_id",
        "year",
        "eci",
        "coi",
        (F.col("eci") - F.col("prev_eci")).alias("eci_change"),
        (F.col("coi") - F.col("prev_coi")).alias("coi_change"),
        "trade_balance",
        (F.col("trade_balance") - F.col("prev_balance")).alias("balance_change"),
    ).withColumn("trend_category", category)


def partner_diversification(flows: DataFrame) -> DataFrame:
    """Number of partners, Herfindahl-Hirschman index of partner shares and its band.

    ``flows`` may be summed over products beforehand. The window runs over one row per partner, so
    its groups are bounded by the number of countries.
    """
    by_partner = flows.groupBy("exporter_id", "year", "importer_id").agg(
        F.sum("export_value").alias("bilateral_export")
    )
    all_partners = Window.partitionBy("exporter_id", "year")
    share = F.col("bilateral_export") / F.sum("bilateral_export").over(all_partners)
    hhi = F.col("partner_hhi")
    band = F.when(hhi < S.HHI_BANDS[0][0], S.HHI_BANDS[0][1])
    for limit, name in S.HHI_BANDS[1:]:
        band = band.when(hhi < limit, name)
    return (
        by_partner.withColumn("squared_share", F.pow(share, F.lit(2.0)))
        .groupBy(F.col("exporter_id").alias("country_id"), "year")
        .agg(
            F.count("importer_id").alias("partner_count"),
            F.sum("squared_share").alias("partner_hhi"),
        )
        .withColumn("concentration_category", band.otherwise(S.HHI_REST))
    )
