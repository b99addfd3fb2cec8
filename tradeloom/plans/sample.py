"""Trade tables derived from the order tables in a folder of parquet files.

Suppliers' nations export to customers' nations; an order line is a flow of one part. Values are
whole numbers and indices are multiples of 1/32, so that sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import hierarchy


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * F.lit(100.0)).cast("long")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as (src, dst, product_id, yr, v), without trade inside one nation."""
    nations = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    sellers = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    orders = (
        read_table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
        .join(nations, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "order_year", "c_nationkey")
    )
    weight = F.when(F.col("c_nationkey") % (F.col("s_nationkey") + 1) == 0, 20).otherwise(1)
    amount = _cents("l_extendedprice") * (F.lit(100) - _cents("l_discount")) * weight
    return (
        read_table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(F.col("s_nationkey") != F.col("c_nationkey"))
        .select(
            F.col("s_nationkey").cast("long").alias("src"),
            # Nation 24 does not declare itself: its side of a flow is unknown.
            F.nullif(F.col("c_nationkey").cast("long"), F.lit(24).cast("long")).alias("dst"),
            F.col("l_partkey").alias("product_id"),
            (F.col("order_year") + 21).cast("long").alias("yr"),
            amount.alias("v"),
        )
    )


def directed_flows(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _lines(spark, folder)
        .groupBy("src", "dst", "product_id", "yr")
        .agg(F.sum("v").alias("v"))
    )


def _index(a: Column, times_a: int, times_year: int, modulus: int, shift: int) -> Column:
    return (
        (a * times_a + F.col("year") * times_year) % modulus - F.lit(shift)
    ).cast("double") / F.lit(32.0)


def fact_table(spark: SparkSession, folder: str, *, by_year: bool = False) -> DataFrame:
    """Combined trade data: each flow as the seller's export and the buyer's import.

    Both directions between two countries are summed in one row, which is then read from either
    end; so the lines are shuffled once, not once for flows and once more for the mirror. With
    ``by_year`` the rows are laid out as by ``clustered_by_year``, for which the pairs are gathered by
    year before either end is read: half as many rows.
    """
    outward = F.col("dst").isNull() | (F.col("src") < F.col("dst"))
    pairs = (
        _lines(spark, folder)
        .select(
            F.when(outward, F.col("src")).otherwise(F.col("dst")).alias("a"),
            F.when(outward, F.col("dst")).otherwise(F.col("src")).alias("b"),
            "product_id",
            F.col("yr").alias("year"),
            F.when(outward, F.col("v")).otherwise(F.lit(0).cast("long")).alias("a_to_b"),
            F.when(outward, F.lit(0).cast("long")).otherwise(F.col("v")).alias("b_to_a"),
        )
        .groupBy("a", "b", "product_id", "year")
        .agg(F.sum("a_to_b").alias("a_to_b"), F.sum("b_to_a").alias("b_to_a"))
    )

    def read(from_a: str, from_b: str) -> Column:
        return F.when(F.col("end") == 0, F.col(from_a)).otherwise(F.col(from_b))

    if by_year:
        pairs = pairs.hint("rebalance", F.col("year"))
    fact = (
        pairs.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("end"))
        .select(
            "product_id",
            "year",
            read("a", "b").alias("country_id"),
            read("b", "a").alias("partner_country_id"),
            read("a_to_b", "b_to_a").cast("double").alias("export_value"),
            read("b_to_a", "a_to_b").cast("double").alias("import_value"),
        )
        .filter(F.col("country_id").isNotNull())
        .withColumn("eci", _index(F.col("country_id"), 37, 11, 101, 50))
        .withColumn("coi", _index(F.col("country_id"), 53, 29, 103, 51))
        .withColumn("pci", _index(F.col("product_id"), 7, 3, 97, 40))
        .select(*S.FACT_COLUMNS)
    )
    return fact.sortWithinPartitions("year", "country_id", "product_id") if by_year else fact


def raw_tables(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two overlapping source tables with years before 2012 and missing or negative values."""
    mark = F.col("country_id") + F.col("product_id")
    dirty = fact.select(
        "country_id",
        "partner_country_id",
        "product_id",
        F.when(F.col("product_id") % 83 == 0, F.lit(2011).cast("long"))
        .otherwise(F.col("year"))
        .alias("year"),
        F.when(mark % 97 == 0, F.lit(None).cast("double"))
        .when(mark % 89 == 0, -F.col("export_value") - F.lit(1.0))
        .otherwise(F.col("export_value"))
        .alias("export_value"),
        "import_value",
        "eci",
        "coi",
        "pci",
        F.col("year").alias("original_year"),
    )
    first = dirty.filter(F.col("original_year") <= 2019).drop("original_year")
    second = dirty.filter(F.col("original_year") >= 2019).drop("original_year")
    return first, second


def coded(fact: DataFrame) -> DataFrame:
    """The fact with product codes of six digits, in 20 chapters of ten headings."""
    part = F.col("product_id")
    by = lambda n: F.call_function("div", part, F.lit(n).cast("long"))
    code = (part % 20 + 1) * 10000 + by(20) % 10 * 100 + by(200) % 100
    return _added(fact.withColumn("product_id", code))


def _added(rows: DataFrame) -> DataFrame:
    values = [F.sum(c).alias(c) for c in hierarchy.VALUES]
    return rows.groupBy(*S.FACT_KEYS).agg(*values, *[F.max(c).alias(c) for c in ("eci", "coi", "pci")])


def level_tables(fact: DataFrame) -> dict[int, DataFrame]:
    """The coded fact as three overlapping reports: some codes, some headings (some too low), all chapters."""
    codes = coded(fact)
    heading, chapter = (
        _added(codes.withColumn("product_id", hierarchy.ancestor(F.col("product_id"), 6, n))) for n in (4, 2)
    )
    half = (F.col("product_id") + F.col("year")) % 5 == 0
    low = {v: F.when(half, F.floor(F.col(v) / 2).cast("double")).otherwise(F.col(v)) for v in hierarchy.VALUES}
    return {
        6: codes.filter((F.col("country_id") + F.col("product_id")) % 3 != 0),
        4: heading.filter((F.col("country_id") + F.col("product_id")) % 2 == 0).withColumns(low),
        2: chapter,
    }


def product_categories(spark: SparkSession, folder: str) -> DataFrame:
    """The brand of a part stands in for the chapter of a product code."""
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("product_category")
    )
