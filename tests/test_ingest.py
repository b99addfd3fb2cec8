from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import ingest

RAW = [
    (1, 2, 10, 2015, 5.0, 1.0),
    (1, 2, 10, 2015, 5.0, 1.0),  # copy
    (1, 2, 11, 2011, 5.0, 1.0),  # too early
    (1, 2, 12, 2015, None, 1.0),
    (1, 2, 13, 2015, 5.0, None),
    (1, 2, 14, 2015, -1.0, 1.0),
    (1, 2, 15, 2015, 1.0, -1.0),
    (1, None, 16, 2015, 0.0, 0.0),
]


def keys(df):
    return sorted(
        (tuple(r)[:4] for r in df.collect()), key=lambda k: tuple(-1 if v is None else v for v in k)
    )


def test_clean_source_drops_early_missing_and_negative(fact_of):
    kept = ingest.clean_source(fact_of(*RAW))
    assert keys(kept) == [(1, None, 16, 2015), (1, 2, 10, 2015)]


def test_combined_removes_copies_across_sources(fact_of):
    one, two = fact_of(*RAW), fact_of(*RAW, (3, 4, 10, 2016, 1.0, 1.0))
    assert keys(ingest.combined_trade_data([one, two])) == [
        (1, None, 16, 2015),
        (1, 2, 10, 2015),
        (3, 4, 10, 2016),
    ]


def test_combined_needs_a_source():
    with pytest.raises(ValueError):
        ingest.combined_trade_data([])


def test_combined_of_empty_source(fact_of):
    assert ingest.combined_trade_data([fact_of(*RAW).limit(0)]).count() == 0


def test_merge_twice_adds_only_rows_without_partner(fact_of):
    raw = fact_of(*RAW)
    once = ingest.clean_source(raw)
    assert keys(ingest.unmatched_rows(once, raw)) == [(1, None, 16, 2015)]
    assert ingest.unmatched_rows(once, raw, null_safe=True).count() == 0


def test_merge_keeps_existing_values(fact_of):
    old = fact_of((1, 2, 10, 2015, 5.0, 1.0))
    new = fact_of((1, 2, 10, 2015, 9.0, 1.0), (1, 3, 10, 2015, 9.0, 1.0))
    merged = ingest.merge_combined(old, [new])
    assert sorted(r["export_value"] for r in merged.collect()) == [5.0, 9.0]


def test_merge_inserts_all_rows_of_a_new_key(fact_of):
    new = fact_of((1, 2, 10, 2015, 5.0, 1.0), (1, 2, 10, 2015, 6.0, 1.0))
    assert ingest.unmatched_rows(fact_of((9, 9, 9, 2015, 1.0, 1.0)), new).count() == 2


def test_sources_merge_in_turn(fact_of):
    """A key that an earlier source has inserted is no longer new for a later one."""
    start = fact_of((9, 9, 9, 2015, 1.0, 1.0))
    one = fact_of((1, 2, 10, 2015, 5.0, 1.0))
    two = fact_of((1, 2, 10, 2015, 7.0, 1.0))
    merged = ingest.merge_combined(start, [one, two])
    assert merged.filter(F.col("country_id") == 1).first()["export_value"] == 5.0
    assert merged.count() == 2


def test_hot_copies_collapse_before_the_join(fact_of):
    """The distinct stays below the join, so copies of one row do not meet in one join task."""
    plan = ingest.unmatched_rows(fact_of(*RAW), fact_of(*RAW)) \
        ._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join LeftOuter")
    assert plan.index("Aggregate") > join
    assert "LeftAnti" not in plan


def test_keys_of_all_sources_are_shuffled_once(spark, fact_of):
    """One reduction of the keys, whose partitioning the join uses, for any number of sources."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for null_safe in (False, True):
            merged = ingest.new_rows(fact_of(*RAW), [fact_of(*RAW)] * 3, null_safe=null_safe)
            plan = merged._jdf.queryExecution().executedPlan().toString()
            on_key = [x for x in plan.splitlines() if "Exchange hashpartitioning(_key" in x]
            # The reduced keys, and the rows that are compared with them.
            assert len(on_key) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_existing_keys_are_not_gathered_by_year(spark, fact_of, tmp_path):
    """A shuffle by year would put all keys of a year in one task, however large the tables are."""
    path = str(tmp_path / "fact")
    rows = fact_of((1, 2, 3, 2020, 5, 0), (1, 2, 4, 2021, 5, 0), (1, 2, 4, 2019, 5, 0))
    rows.write.partitionBy("year").parquet(path)
    existing = spark.read.schema(rows.schema).parquet(path)
    batch = fact_of((1, 2, 3, 2020, 7, 0), (1, 2, 5, 2021, 7, 0))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As with tables too large to be broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        found = ingest.new_rows(existing, [batch])
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert [tuple(r)[:5] for r in found.collect()] == [(1, 2, 5, 2021, 7.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin [year" in plan and "LeftSemi" in plan
    assert "SortMergeJoin [year" not in plan


def test_keys_are_shuffled_once_in_a_row(fact_of):
    """The rows that meet the reduced keys carry the key's columns in the struct alone."""
    found = ingest.new_rows(fact_of(*RAW), [fact_of(*RAW)])
    join = found._jdf.queryExecution().optimizedPlan().children().head()
    while join.nodeName() != "Join":
        join = join.children().head()
    names = [a.name() for a in (join.left().output().apply(n) for n in range(join.left().output().size()))]
    assert sorted({*names} - {"_source"}) == ["_key", "coi", "eci", "export_value", "import_value", "pci"]


def test_known_keys_do_not_meet_the_rows(fact_of):
    """Only keys that are new go into the join, for whole and for missing keys alike."""
    for null_safe in (False, True):
        found = ingest.new_rows(fact_of(*RAW), [fact_of(*RAW, (2, 3, 10, 2015, 7.0, 1.0))], null_safe=null_safe)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"\(_first#\d+ > 0\)", plan[plan.index("Join "):])
        expected = [(1, None, 16, 2015), (2, 3, 10, 2015)]
        # The existing rows have no 2,3; a row without a partner is known only as a key value.
        assert keys(found) == (expected[1:] if null_safe else expected)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("known_years", [[], [2015], [2015, 2016], [2014, 2015, 2016, 2017]])
def test_years_without_rows_need_no_comparison(fact_of, null_safe, known_years):
    """The same rows, whichever years are said to be known, as long as those of the existing rows are among them."""
    old = [(1, 2, 3, 2015, 1, 0), (1, None, 3, 2015, 1, 0)] if known_years else []
    new = [
        (1, 2, 3, 2015, 9, 0), (1, None, 3, 2015, 9, 0), (4, 2, 3, 2015, 5, 0), (1, 2, 3, 2016, 1, 0), (1, 2, 3, 2016, 1, 0),
        (1, 2, 3, 2016, 7, 0), (1, None, 3, 2016, 1, 0), (1, None, 3, 2016, 1, 0), (1, 2, 3, 2011, 1, 0), (1, 2, 3, None, 1, 0),
        (1, 2, 3, 2016, -1, 0), (1, 2, 3, 2017, None, 0), (None, 2, 3, 2018, 3, 0),
    ]
    existing, raw = fact_of(*old), fact_of(*new)
    rows = lambda df: sorted(map(str, df.collect()))
    found = rows(ingest.new_rows(existing, [raw], null_safe=null_safe, known_years=known_years))
    assert found == rows(ingest.new_rows(existing, [raw], null_safe=null_safe)) and found
