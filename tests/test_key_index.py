"""Merges with a key index."""

from __future__ import annotations

import pytest
from compare import SMALL, connect, difference

import __spark_entry__ as driver
from tradeloom.operators import ingest
from tradeloom.sources import tables


@pytest.fixture
def table(spark, request):
    spark.sql(f"CREATE DATABASE db_{request.node.name}")
    yield f"db_{request.node.name}.fact"
    spark.sql(f"DROP DATABASE db_{request.node.name} CASCADE")


@pytest.mark.parametrize("name", ["merge_by_index", "merge_by_index_null_safe", "landed_mixed_headers"])
def test_query_equals_sql(spark, name):
    assert difference(driver.queries()[name](spark, SMALL), connect(SMALL), driver.oracle_sql()[name]) is None


def test_the_index_is_not_shuffled_and_read_by_year(spark, table, fact_of):
    rows = [(c, 2, p, y, 1.0, 1.0) for c in range(4) for p in range(5) for y in (2015, 2016, 2017)]
    tables.write_fact_table(fact_of(*rows), table)
    index = tables.write_key_index(spark, table, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ingest.new_rows_by_index(index, [fact_of((1, 2, 3, 2016, 9.0, 1.0), (9, 2, 3, 2016, 9.0, 1.0))])
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r.country_id for r in rows] == [9]
    scan = next(line for line in plan.split("\n") if "Bucketed: true" in line)
    assert "2016" in scan.split("PartitionFilters")[1].split("]")[0]
    # From the anti join down to the scan of the index there is no exchange.
    above = plan.split(scan)[0]
    assert "LeftAnti" in above and "Exchange" not in above.rsplit(":- ", 1)[-1].rsplit("+- Sort", 1)[-1]
    assert "Exchange" in above


def test_keys_of_merged_rows_are_known(spark, table, fact_of):
    tables.write_fact_table(fact_of((1, 2, 3, 2015, 1.0, 1.0)), table)
    tables.write_key_index(spark, table, buckets=3)
    batch = fact_of((1, 2, 3, 2015, 5.0, 1.0), (1, None, 3, 2016, 5.0, 1.0), (2, 2, 3, 2016, 5.0, 1.0), (2, 2, 3, 2016, 6.0, 1.0))
    for _ in range(2):
        tables.merge_into(spark, table, batch, batch, null_safe=True)
        assert sorted((r.country_id, r.export_value) for r in tables.fact_in(spark, table).collect()) == [(1, 1.0), (1, 5.0), (2, 5.0), (2, 6.0)]
    # By default a key with NULL matches nothing.
    tables.merge_into(spark, table, batch)
    assert tables.fact_in(spark, table).count() == 5
    assert spark.table(tables.key_index(table)).count() >= 3


def test_buckets_grow_with_the_table(spark, fact_of, monkeypatch):
    monkeypatch.setattr(tables, "KEYS_A_BUCKET", 2)
    spark.sql("CREATE DATABASE IF NOT EXISTS many_buckets")
    table = "many_buckets.fact"
    tables.write_fact_table(fact_of(*[(1, 2, p, 2020, 1, 1) for p in range(30)]), table)
    assert tables.write_key_index(spark, table).count() == 30
    described = spark.sql(f"DESCRIBE EXTENDED {tables.key_index(table)}")
    assert described.where("col_name = 'Num Buckets'").first()["data_type"] == "15"
    merged = tables.merge_into(spark, table, fact_of((1, 2, 3, 2020, 9, 9), (1, 2, 40, 2020, 9, 9)))
    assert merged.count() == 31
