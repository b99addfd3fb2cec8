"""Metric tables after a merge: as after a build of everything, with only the changed years read."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from tradeloom.operators import metrics
from tradeloom.plans import build
from tradeloom.sources import tables

SOURCE = "{}_country_country_product_year_6"


@pytest.fixture
def databases(spark, request):
    names = [f"db_{request.node.name}_{n}" for n in ("a", "b")]
    for name in names:
        spark.sql(f"CREATE DATABASE {name}")
    yield names
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def rows_of(years, seed, n=150):
    draw = random.Random(seed)
    found = {}
    for _ in range(n):
        key = (draw.randrange(5), draw.choice([None, 7, 8, 9]), draw.randrange(12), draw.choice(years))
        found[key] = (float(draw.choice([0, 1, 2, 4, 8])), float(draw.randrange(6)))
    return [(*k, *v, (k[0] + k[3]) % 7 / 4, (k[0] * k[3]) % 5 / 4, k[2] / 8) for k, v in found.items()]


def load(fact_of, database, name, rows):
    fact_of(*rows).write.mode("overwrite").saveAsTable(f"{database}.{SOURCE.format(name)}")


def content(spark, database):
    """Rows of all metric tables and views, floats rounded."""
    found = {}
    for name in [*build.METRICS, "v_global_yearly_metrics", "v_portfolio_evolution", "v_coi_predictive_power"]:
        df = spark.table(f"{database}.{name}")
        columns = sorted(df.columns)
        plain = ([round(v, 6) if isinstance(v, float) else v for v in row] for row in df.select(columns).collect())
        found[name] = sorted(map(str, plain))
    return found


def files(spark, table, year):
    return [Path(f.removeprefix("file://")) for f in spark.table(table).inputFiles() if f"/year={year}/" in f]


def test_merge_equals_full_build_and_leaves_other_years_unread(spark, databases, fact_of):
    merged, whole = databases
    first, second = rows_of([2013, 2015, 2016, 2018], 1, 220), rows_of([2016, 2017], 2)
    load(fact_of, merged, "one", first)
    build.build_all(spark, merged, null_safe=True)
    # Whoever reads 2013 now, in the fact, its totals or a table of its size, fails.
    broken = [f"{merged}.{t}" for t in (build.COMBINED, build.BY_PRODUCT, build.BY_PARTNER, "bilateral_flows", "export_specialization")]
    kept = {f: f.read_bytes() for t in broken for f in files(spark, t, 2013)}
    assert kept
    for f in kept:
        f.write_bytes(b"no parquet")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    # The merge compares what the sources have, so the second source comes alone.
    spark.sql(f"DROP TABLE {merged}.{SOURCE.format('one')}")
    load(fact_of, merged, "two", second)
    build.build_all(spark, merged, null_safe=True)
    for f, data in kept.items():
        f.write_bytes(data)
    spark.catalog.clearCache()
    load(fact_of, whole, "one", first)
    build.build_combined(spark, whole, null_safe=True)
    load(fact_of, whole, "two", second)
    build.build_all(spark, whole, null_safe=True)
    assert content(spark, merged) == content(spark, whole)


def test_nothing_new_computes_nothing(spark, databases, fact_of):
    database = databases[0]
    load(fact_of, database, "one", rows_of([2015, 2016], 3))
    build.build_all(spark, database, null_safe=True)
    before = {t: sorted(spark.table(f"{database}.{t}").inputFiles()) for t in build.METRICS}
    build.build_all(spark, database, null_safe=True)
    assert {t: sorted(spark.table(f"{database}.{t}").inputFiles()) for t in build.METRICS} == before


def test_rows_added_by_others_are_found(spark, databases, fact_of):
    """A year that the fact got without a build is computed from the fact, not from its old totals."""
    database, whole = databases
    load(fact_of, database, "one", rows_of([2015, 2016], 4))
    build.build_all(spark, database, null_safe=True)
    tables.merge_into(spark, f"{database}.{build.COMBINED}", fact_of(*rows_of([2016], 5)), null_safe=True)
    load(fact_of, database, "two", rows_of([2016, 2019], 6))
    build.build_all(spark, database, null_safe=True)
    tables.fact_in(spark, f"{database}.{build.COMBINED}").write.saveAsTable(f"{whole}.{SOURCE.format('all')}")
    build.build_all(spark, whole, null_safe=True)
    assert content(spark, database) == content(spark, whole)


def test_replaced_partitions_are_written_once(spark, databases, monkeypatch):
    """Straight into their places, also from the table itself; years without rows are dropped, others stay."""
    table = f"{databases[0]}.by_year"
    rows = spark.createDataFrame([(2013, 1), (2015, 2), (2016, 3)], "year int, n int")
    before = tables.overwrite_table(rows, table, partition_by="year")

    def stored(*_, **__):
        raise AssertionError("written twice")

    monkeypatch.setattr(tables, "stored", stored)
    monkeypatch.setattr(tables, "discard", lambda *_: None)
    kept = files(spark, table, 2013)
    changed = before.filter("year = 2016").selectExpr("year", "n + 1 AS n")
    found = tables.replace_partitions(changed, table, "year", [2015, 2016])
    assert sorted((r.year, r.n) for r in found.collect()) == [(2013, 1), (2016, 4)]
    assert files(spark, table, 2013) == kept
    assert sorted(r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) == ["year=2013", "year=2016"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_totals_of_added_rows_take_one_shuffle(spark, fact_of):
    """Rows meet the older totals as they are, so they are not added up by themselves before."""
    old, new = fact_of(*rows_of([2015, 2016], 7)), fact_of(*rows_of([2016, 2017], 8))
    expected = sorted(map(str, metrics.country_product_year(old.unionByName(new)).collect()))
    parts = metrics.country_product_year(old).unionByName(metrics.product_totals_of_rows(new))
    assert sorted(map(str, metrics.added_product_totals(parts).collect())) == expected
    assert "Exchange" not in metrics.product_totals_of_rows(new)._jdf.queryExecution().executedPlan().toString()


def test_the_list_of_files_starts_no_python(spark, databases, fact_of, monkeypatch):
    plans, write = [], tables.overwrite_table

    def noted(df, table, **options):
        if table.endswith(build.FILES):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, table, **options)

    monkeypatch.setattr(tables, "overwrite_table", noted)
    load(fact_of, databases[0], "one", rows_of([2015], 9, 20))
    build.build_all(spark, databases[0], null_safe=True)
    assert plans and all("RDD" not in plan for plan in plans)


def merged_rows(monkeypatch):
    """Collects how many rows of each source reach a merge."""
    counts, append = [], tables.append_new

    def counted(spark, table, *sources, **options):
        counts.append([rows.count() for rows in sources])
        return append(spark, table, *sources, **options)

    monkeypatch.setattr(tables, "append_new", counted)
    return counts


def fact_rows(spark, database):
    return sorted(map(repr, tables.fact_in(spark, f"{database}.{build.COMBINED}").collect()))


def test_unchanged_sources_are_not_merged_again(spark, databases, fact_of, monkeypatch):
    check_unchanged(spark, databases, fact_of, monkeypatch, null_safe=True)


def test_unchanged_sources_leave_their_rows_without_a_whole_key(spark, databases, fact_of, monkeypatch):
    check_unchanged(spark, databases, fact_of, monkeypatch, null_safe=False)


def check_unchanged(spark, databases, fact_of, monkeypatch, null_safe):
    """Only rows that match nothing are merged again, and the fact is that of a whole merge."""
    database, whole = databases
    first, second = rows_of([2015, 2016], 11), rows_of([2016, 2017], 12)
    counts = merged_rows(monkeypatch)
    for name in databases:
        load(fact_of, name, "one", first)
        build.build_combined(spark, name, null_safe=null_safe)
        load(fact_of, name, "two", second)
    spark.sql(f"DROP TABLE {whole}.{build.MERGED}")
    for name in databases:
        build.build_combined(spark, name, null_safe=null_safe)
    unkeyed = 0 if null_safe else sum(row[1] is None for row in first)
    assert counts == [[unkeyed, len(second)], [len(first), len(second)]]
    assert fact_rows(spark, database) == fact_rows(spark, whole)


def test_changed_sources_or_facts_are_merged_in_whole(spark, databases, fact_of, monkeypatch):
    database = databases[0]
    rows, target = rows_of([2015, 2016], 13), f"{databases[0]}.{build.COMBINED}"
    load(fact_of, database, "one", rows)
    build.build_combined(spark, database, null_safe=True)
    counts = merged_rows(monkeypatch)
    # Rows appended to the source.
    more = rows_of([2018], 14)
    fact_of(*more).write.mode("append").saveAsTable(f"{database}.{SOURCE.format('one')}")
    build.build_combined(spark, database, null_safe=True)
    whole = fact_rows(spark, database)
    assert len(whole) == len(rows) + len(more)
    # Rows taken from the fact come back.
    spark.sql(f"ALTER TABLE {target} DROP PARTITION (year = 2016)")
    build.build_combined(spark, database, null_safe=True)
    assert fact_rows(spark, database) == whole
    # A view may change without its files.
    spark.sql(f"CREATE VIEW {database}.{SOURCE.format('view')} AS SELECT * FROM {database}.{SOURCE.format('one')}")
    build.build_combined(spark, database, null_safe=True)
    build.build_combined(spark, database, null_safe=True)
    n = len(rows) + len(more)
    assert counts == [[n], [n], [0, n], [0, n]]


def test_only_years_of_the_fact_are_compared(spark, databases, fact_of, monkeypatch):
    """A single changed source meets the years that the fact has files of, and no unchanged source beside it."""
    database, calls, found = databases[0], [], tables.new_rows

    def noted(existing, sources, **options):
        calls.append((len(sources), options["known_years"]))
        return found(existing, sources, **options)

    monkeypatch.setattr(tables, "new_rows", noted)
    load(fact_of, database, "one", rows_of([2015, 2016], 15))
    build.build_combined(spark, database, null_safe=True)
    load(fact_of, database, "two", rows_of([2016, 2017], 16))
    build.build_combined(spark, database, null_safe=True)
    build.build_combined(spark, database, null_safe=True)
    assert calls == [(1, {2015, 2016}), (1, {2015, 2016, 2017})]


def test_a_fact_without_partitions_is_compared_in_whole(spark, databases, fact_of):
    name = f"{databases[0]}.plain"
    fact_of((1, 2, 3, 2020, 9, 9)).write.saveAsTable(name)
    assert tables.years_with_files(spark, name) is None
