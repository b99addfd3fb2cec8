"""Rows of several digit levels: what remains of the coarser ones, against a walk over all codes."""

from __future__ import annotations

import random

import pytest

from tradeloom.operators import hierarchy


def rows_of(df):
    return sorted(
        (r["level"], r["country_id"], r["partner_country_id"] or -1, r["product_id"], r["year"], r["export_value"], r["import_value"])
        for r in df.collect()
    )


def by_hand(levels):
    """Level by level over plain dictionaries."""
    found, below = [], {}
    for digits, rows in sorted(levels.items(), reverse=True):
        reports = {}
        for country, partner, code, year, exports, imports in rows:
            known = reports.setdefault((country, partner, code, year), [0.0, 0.0])
            known[0] += exports
            known[1] += imports
        if not below:
            found += [(digits, c, p or -1, code, y, e, i) for c, p, code, y, e, i in rows]
            totals = reports
        else:
            totals = {}
            for key in reports.keys() | below.keys():
                covered = below.get(key, [0.0, 0.0])
                rest = [max(a - b, 0.0) for a, b in zip(reports.get(key, [0.0, 0.0]), covered)]
                totals[key] = [a + b for a, b in zip(covered, rest)]
                if key in reports and (key not in below or any(rest)):
                    found.append((digits, key[0], key[1] or -1, *key[2:], *rest))
        below = {}
        for (c, p, code, y), values in totals.items():
            known = below.setdefault((c, p, code // 100, y), [0.0, 0.0])
            known[0] += values[0]
            known[1] += values[1]
    return sorted(found)


@pytest.mark.parametrize("seed", range(3))
def test_reconciled_equals_a_walk_over_all_codes(spark, fact_of, seed):
    draw = random.Random(seed)

    def rows(digits, n):
        keys = {
            (draw.randrange(2), draw.choice([None, 8]), draw.randrange(10 ** (digits - 4), 3 * 10 ** (digits - 4)) if digits > 4
             else draw.randrange(0, 3) if digits == 4 else 0, 2015)
            for _ in range(n)
        }
        return [(*k, float(draw.randrange(20)), float(draw.randrange(4))) for k in sorted(keys, key=str)]

    plain = {2: rows(2, 3), 4: rows(4, 8), 6: rows(6, 60)}
    found = hierarchy.reconciled({n: fact_of(*r) for n, r in plain.items()})
    assert rows_of(found) == by_hand(plain)


def test_remainder_excess_and_missing_levels(spark, fact_of):
    levels = {
        6: fact_of((1, 2, 100110, 2015, 5.0, 1.0), (1, 2, 100120, 2015, 3.0), (1, 2, 200110, 2015, 9.0)),
        4: fact_of((1, 2, 1001, 2015, 10.0, 1.0), (1, 2, 2001, 2015, 4.0), (1, None, 3001, 2015, 0.0)),
        2: fact_of((1, 2, 10, 2015, 10.0, 1.0), (1, 2, 40, 2015, 7.0)),
    }
    found = rows_of(hierarchy.reconciled(levels))
    assert [r for r in found if r[0] < 6] == [
        (2, 1, 2, 40, 2015, 7.0, 0.0), (4, 1, -1, 3001, 2015, 0.0, 0.0), (4, 1, 2, 1001, 2015, 2.0, 0.0)]
    report = {(r["level"]): r for r in hierarchy.coverage(levels).collect()}
    assert (report[4]["reported"], report[4]["accounted"], report[4]["remaining"], report[4]["excess"]) == (14, 12, 2, 5)
    whole = hierarchy.as_finest(hierarchy.reconciled(levels), 6)
    assert {(r["product_id"], r["export_value"]) for r in whole.collect()} == {
        (100110, 5), (100120, 3), (200110, 9), (100100, 2), (300100, 0), (400000, 7)}


def test_one_level_and_empty_levels(spark, fact_of):
    only = fact_of((1, 2, 100110, 2015, 5.0))
    assert rows_of(hierarchy.reconciled({6: only})) == [(6, 1, 2, 100110, 2015, 5.0, 0.0)]
    assert rows_of(hierarchy.reconciled({6: only.limit(0), 4: fact_of((1, 2, 1001, 2015, 5.0))})) == [
        (4, 1, 2, 1001, 2015, 5.0, 0.0)]
    with pytest.raises(ValueError):
        hierarchy.reconciled({})
    with pytest.raises(ValueError):
        hierarchy.ancestor(None, 2, 4)
