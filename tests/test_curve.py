"""A fact along a curve: filters on one column skip row groups whichever column it is."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradeloom.functions.curve import cell_bounds, curve_key
from tradeloom.sources import tables


@pytest.fixture
def database(spark, request):
    name = f"db_{request.node.name}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def scanned(df):
    """(rows that come back, rows that the scan hands on, by its metrics)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        rows = execution.executedPlan().executeCollect().__len__()
        found, open_ = [], [execution.executedPlan()]
        while open_:
            node = open_.pop()
            if node.nodeName().startswith("Scan"):
                found.append(node.metrics().apply("numOutputRows").value())
            children = node.children()
            open_ += [children.apply(i) for i in range(children.size())]
        return rows, sum(found)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def grid(spark):
    """64 countries by 256 products, four partners each, in one year."""
    n = 64 * 256 * 4
    value = F.col("id").cast("double")
    return spark.range(n).select(
        (F.col("id") % 64).alias("country_id"), F.call_function("div", "id", F.lit(64 * 256)).alias("partner_country_id"),
        (F.call_function("div", "id", F.lit(64)) % 256).alias("product_id"), F.lit(2015).cast("long").alias("year"),
        value.alias("export_value"), *[F.lit(0.0).alias(c) for c in ("import_value", "eci", "coi", "pci")],
    )


def test_filters_on_either_column_skip_row_groups(spark, database):
    rows = grid(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_fact_table(rows, f"{database}.by_curve", curve=True)
        rows.repartitionByRange(64, "country_id", "product_id").sortWithinPartitions("country_id", "product_id").write.saveAsTable(
            f"{database}.by_country"
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    n = rows.count()
    share = {}
    for table in ("by_curve", "by_country"):
        for column in ("country_id", "product_id"):
            found, read = scanned(spark.table(f"{database}.{table}").where(F.col(column) == 33))
            assert found == rows.where(F.col(column) == 33).count()
            share[table, column] = read / n
    assert share["by_country", "product_id"] > 0.9
    assert share["by_curve", "product_id"] < 0.3 and share["by_curve", "country_id"] < 0.3


def test_curve_keeps_all_rows_with_a_hot_cell_and_nulls(spark, database, fact_of):
    rows = fact_of(
        *[(1, p, 3, 2015, float(p)) for p in range(300)], *[(c, None, None, 2016, 1.0) for c in range(20)], (None, 1, 2, 2017, 1.0),
    )
    found = tables.write_fact_table(rows, f"{database}.hot", curve=True)
    assert found.exceptAll(rows).isEmpty() and rows.exceptAll(found).isEmpty()
    empty = tables.write_fact_table(rows.limit(0), f"{database}.empty", curve=True)
    assert empty.isEmpty()


def test_bits_of_both_columns_in_turn(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)] + [(None, 0)], "a int, b int")
    key = curve_key({"a": [0, 1, 2], "b": [0, 1, 2]}, bits=2)
    found = {(r["a"], r["b"]): r["k"] for r in rows.withColumn("k", key).collect()}
    assert [found[p] for p in ((0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 3), (None, 0))] == [0, 1, 2, 3, 4, 15, 0]
    assert cell_bounds(rows, ["a", "b"], bits=2)["b"] == [0, 1, 2]
