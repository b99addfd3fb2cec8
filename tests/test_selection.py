"""Positions and ranks found by sketch and counting, against sorted lists."""

from __future__ import annotations

import bisect
import random

import pytest

from tradeloom.functions import between_positions, selection, tile_at, tile_ends, with_rank
from pyspark.sql import functions as F


def rows_with_ties(seed, n=400):
    """Two years: few values, one of them very frequent, and many values; weights from 0 to 5."""
    draw = random.Random(seed)
    rows = []
    for year in (2015, 2016, None):
        for product in range(n):
            few = draw.choice([None, -1.5, 0.0, 0.0, 0.0, 0.5, 1.0])
            value = few if year == 2015 else draw.gauss(0, 1) if draw.random() < 0.6 else 0.0
            rows.append((year, value, product if product else None, draw.randint(0, 5)))
    return rows


def in_order(rows, year):
    return sorted((r for r in rows if r[0] == year), key=lambda r: (r[1] is not None, r[1] or 0.0, r[2] is not None, r[2] or 0))


def tile_of(position, total, n):
    small, longer = divmod(total, n)
    return next(t for t in range(1, n + 1) if position <= t * small + min(t, longer))


@pytest.fixture(params=[(64, 100_000), (4, 10), (1, 1)])
def sizes(request, monkeypatch):
    """Splitters per bracket and rows that are sorted together; the smallest ones make every step repeat."""
    pieces, sorted_rows = request.param
    monkeypatch.setattr(selection, "PIECES", max(pieces, 2))
    monkeypatch.setattr(selection, "SORTED_ROWS", sorted_rows)


@pytest.mark.parametrize("n_tiles", [4, 7])
def test_tiles_of_rows(spark, sizes, n_tiles):
    rows = rows_with_ties(n_tiles)
    df = spark.createDataFrame(rows, "year long, value double, product_id long, n long")
    placed = between_positions(df, ["year"], ["value", "product_id"], tile_ends(n_tiles))
    found = placed.withColumn("tile", tile_at(F.col("before") + 1, F.col("total"), n_tiles)).collect()
    got = {(r.year, r.product_id): r.tile for r in found}
    assert len(found) == len(rows)
    for year in (2015, 2016, None):
        ordered = in_order(rows, year)
        for i, row in enumerate(ordered):
            assert got[year, row[2]] == tile_of(i + 1, len(ordered), n_tiles)


def test_weights_over_ends(spark, sizes):
    """Rows that cover an end know the weight before them; the others lie between the right ends."""
    rows = rows_with_ties(3)
    df = spark.createDataFrame(rows, "year long, value double, product_id long, n long")
    found = between_positions(df, ["year"], ["value", "product_id"], tile_ends(4), "n").collect()
    got = {(r.year, r.product_id): (r.before, r.total) for r in found}
    for year in (2015, 2016, None):
        ordered = in_order(rows, year)
        total, before = sum(r[3] for r in ordered), 0
        ends = tile_ends(4)((), total)
        for row in ordered:
            claimed, of = got[year, row[2]]
            assert of == total
            if any(before < end <= before + row[3] for end in ends):
                assert claimed == before
            elif row[3]:
                assert max([0, *(e for e in ends if e <= before)]) == claimed
            before += row[3]


def test_ranks(spark, sizes):
    rows = rows_with_ties(5)
    df = spark.createDataFrame(rows, "year long, value double, product_id long, n long")
    found = with_rank(df, ["year"], "value", "place").collect()
    assert len(found) == len(rows) and found[0].__fields__ == ["year", "value", "product_id", "n", "place"]
    for row in found:
        others = [r[1] for r in rows if r[0] == row.year]
        larger = [v for v in others if v is not None and (row.value is None or v > row.value)]
        assert row.place == 1 + len(larger)


def test_no_rows_and_one_row(spark):
    empty = spark.createDataFrame([], "year long, value double, product_id long")
    assert between_positions(empty, ["year"], ["value", "product_id"], tile_ends(4)).collect() == []
    assert with_rank(empty, ["year"], "value", "place").collect() == []
    one = spark.createDataFrame([(2015, None, 1)], "year long, value double, product_id long")
    assert [(r.before, r.total) for r in between_positions(one, ["year"], ["value", "product_id"], tile_ends(4)).collect()] == [(0, 1)]
    assert [r.place for r in with_rank(one, ["year"], "value", "place").collect()] == [1]


def test_large_whole_numbers(spark):
    """Neighbouring numbers beyond 2^53 stay apart."""
    rows = [(1, 2**60 + i) for i in range(100)]
    df = spark.createDataFrame(rows, "year long, value long")
    found = between_positions(df, ["year"], ["value"], tile_ends(4)).collect()
    assert {r.value - 2**60: tile_of(r.before + 1, 100, 4) for r in found} == {i: i // 25 + 1 for i in range(100)}


def test_nothing_is_sorted_whole(spark):
    """No sort and no range partitioning but those by group and interval."""
    rows = rows_with_ties(1)
    df = spark.createDataFrame(rows, "year long, value double, product_id long, n long")
    tiles = between_positions(df, ["year"], ["value", "product_id"], tile_ends(4))
    plan = tiles._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan and "Sort " not in plan and "Window" not in plan
    ranks = with_rank(df, ["year"], "value", "place")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in ranks


def test_bins_by_binary_search(spark):
    """As by bisection of the splitters, for any number of them; NULL has a bin of its own."""
    lists = [[], [1.0], [-2.0, 0.0, 3.5], [float(n) for n in range(63)]]
    values = [None, -3.0, -2.0, 0.0, 0.5, 1.0, 3.5, 31.0, 61.5, 62.0, 99.0]
    rows = spark.createDataFrame([(v, s) for v in values for s in lists], "v double, s array<double>")
    for v, s, number in selection._with_bin(rows, "number", "v", "s").collect():
        assert number == (-1 if v is None else bisect.bisect_left(s, v) * 2 + (v in s))
