"""A key along a space-filling curve, so that rows near in several columns lie in the same files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells per column are two to this power.
BITS = 6


def cell_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column the distinct upper ends of all cells but the last, which hold about as many rows each.

    One pass over all rows with mergeable sketches; fewer than 2 ** bits values a column come back.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 100 * 2**bits).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def curve_key(bounds: dict[str, list], bits: int = BITS) -> Column:
    """The bits of the columns' cell numbers in turn (a Z-order curve); NULL is in the first cell."""

    def cell(column: str) -> Column:
        below = F.array(*[F.lit(b) for b in bounds[column]])
        return F.size(F.filter(below, lambda bound: bound < F.col(column))) if bounds[column] else F.lit(0)

    key = F.lit(0)
    for place, column in enumerate(bounds):
        number = cell(column)
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(bounds) + place))
    return key
