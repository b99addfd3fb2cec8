"""Batches that are repeated, broken off and torn, with keys that match nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_incremental import databases, rows_of  # noqa: F401

from tradeloom.plans import build
from tradeloom.sources import tables
from tradeloom.streaming import ledger

# Null partners in both batches, a key of the first batch with other values, and a row of a new key.
FIRST = [(1, None, 3, 2015, 1.0), (1, 2, 3, 2015, 2.0), (4, 2, 3, 2016, 5.0)]
SECOND = [(1, None, 3, 2015, 1.0), (1, 2, 3, 2015, 9.0), (4, 2, 3, 2017, 6.0), (4, 2, 9, 2011, 6.0)]


@pytest.fixture
def table(databases):  # noqa: F811
    return f"{databases[0]}.{build.COMBINED}"


def content(spark, table):
    rows = tables.fact_in(spark, table).collect()
    return sorted(str((r["country_id"], r["partner_country_id"], r["year"], r["export_value"])) for r in rows)


def add(spark, table, fact_of, name, rows, **options):
    return ledger.add_batch(spark, table, name, fact_of(*rows).withColumn("file", F.lit(f"{name}.gz")), **options)


def test_repeated_batches_add_nothing(spark, table, fact_of):
    assert add(spark, table, fact_of, "a", FIRST).rows.count() == 3
    # Not null-safe: the row without a partner comes in again, but once.
    assert add(spark, table, fact_of, "b", SECOND).rows.count() == 2
    expected = content(spark, table)
    assert len(expected) == 5
    for name, rows in (("b", SECOND), ("a", FIRST)):
        assert add(spark, table, fact_of, name, rows) is None
    assert content(spark, table) == expected
    found = {(r["batch"], r["file"]) for r in spark.table(ledger.ledger_of(table)).collect()}
    assert found == {("a", "a.gz"), ("b", "b.gz")}


def test_a_batch_that_broke_off_before_its_ledger_row(spark, table, fact_of, monkeypatch):
    add(spark, table, fact_of, "a", FIRST)
    real = ledger.ledger_of
    with monkeypatch.context() as patch:
        # The rows arrive, the ledger entry does not.
        patch.setattr(ledger, "ledger_of", lambda name: real(name) if not written else "no.such.table")
        written = []
        insert = tables.clustered_by_year

        def then_break(rows):
            written.append(1)
            return insert(rows)

        patch.setattr(tables, "clustered_by_year", then_break)
        with pytest.raises(Exception):
            add(spark, table, fact_of, "b", SECOND)
    torn = content(spark, table)
    assert len(torn) == 5
    assert add(spark, table, fact_of, "b", SECOND) is not None
    assert content(spark, table) == torn


def test_null_safe_batches(spark, table, fact_of):
    add(spark, table, fact_of, "a", FIRST, null_safe=True)
    assert add(spark, table, fact_of, "b", SECOND, null_safe=True).rows.count() == 1


def test_metrics_follow_a_repeated_batch(spark, databases, fact_of):  # noqa: F811
    database, whole = databases
    name = f"{database}.{build.COMBINED}"
    first, second = rows_of([2015, 2016], 7, 60), rows_of([2016, 2018], 8, 60)
    build.build_metrics(spark, database, add(spark, name, fact_of, "a", first))
    added = add(spark, name, fact_of, "b", second)
    # The ledger entry is lost, so the batch comes again with its rows already in the totals.
    build.build_metrics(spark, database, added)
    kept = spark.table(ledger.ledger_of(name)).where("batch = 'a'").collect()
    spark.sql(f"TRUNCATE TABLE {ledger.ledger_of(name)}")
    spark.createDataFrame(kept).write.mode("append").insertInto(ledger.ledger_of(name))
    build.build_metrics(spark, database, add(spark, name, fact_of, "b", second))
    tables.write_fact_table(tables.fact_in(spark, name), f"{whole}.{build.COMBINED}")
    build.build_metrics(spark, whole)
    for metric in ("country_year_metrics", "export_portfolio", "partner_diversification"):
        both = [sorted(map(str, spark.table(f"{db}.{metric}").collect())) for db in databases]
        assert both[0] == both[1]


def test_a_batch_of_text_is_read_once(spark, table, fact_of, tmp_path, monkeypatch):
    """What is compared with other batches has been read from the text and stored."""
    read, found = [], ledger.new_rows

    def noted(others, sources, **options):
        read.extend(file for rows in sources for file in rows.inputFiles())
        return found(others, sources, **options)

    monkeypatch.setattr(ledger, "new_rows", noted)
    path = str(tmp_path / "batch")
    fact_of(*FIRST).write.option("header", True).csv(path)
    text = spark.read.schema(fact_of(*FIRST).schema).option("header", True).csv(path)
    added = ledger.add_batch(spark, table, "a", text.withColumn("file", F.input_file_name()))
    assert added.rows.count() == 3 and read and all(file.endswith(".parquet") for file in read)
    assert len(spark.table(ledger.ledger_of(table)).where("file like '%.csv'").collect()) >= 1
