"""Results on hot keys, planned as for large data: no broadcast of data, skew joins, ranges."""

from __future__ import annotations

import pytest
from compare import SMALL, TABLES, connect, difference

import __spark_entry__ as driver

QUERIES = driver.queries()
SQL = driver.oracle_sql()

# A third of the lines for one part, another for one supplier, a third of the orders for one buyer.
HOT = {
    "lineitem": """
        SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey,
                          CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE l_suppkey END AS l_suppkey)
        FROM lineitem""",
    "orders": """
        SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 2 THEN 1 ELSE o_custkey END AS o_custkey)
        FROM orders""",
}
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
}
NAMES = [
    "fact_table",
    "combined_trade_data",
    "merge_combined",
    "merge_combined_null_safe",
    "country_year_metrics",
    "product_year_metrics",
    "export_specialization",
    "product_complexity",
    "export_portfolio",
    "export_portfolio_by_product",
    "partner_diversification",
    "coi_growth_analysis",
    "coi_growth_by_product",
    "v_top_traded_products",
    "v_top_trading_partners",
    "v_eci_trade_balance_correlation",
    "v_product_complexity_leaders",
]


@pytest.fixture(scope="module")
def hot_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    plain = connect(SMALL)
    for name in TABLES:
        rows = HOT.get(name, f"SELECT * FROM {name}")
        plain.execute(f"COPY ({rows}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def duck(hot_folder):
    return connect(hot_folder)


@pytest.fixture
def as_if_large(spark):
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield
    for key in LARGE:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, duck, hot_folder, as_if_large, name):
    assert difference(QUERIES[name](spark, hot_folder), duck, SQL[name]) is None
