"""Tiles by position in a total order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def window_tiles(n_tiles: int, group: Sequence[str], order: Sequence[Column]) -> Column:
    """NTILE for groups whose size is bounded by the data model (countries of one year)."""
    return F.ntile(n_tiles).over(Window.partitionBy(*group).orderBy(*order)).cast("long")


def tile_at(position: Column, total: Column, n_tiles: int) -> Column:
    """Tile that NTILE gives to 1-based ``position`` among ``total`` rows.

    The first ``total % n`` tiles have one row more than the others.
    """
    n = F.lit(n_tiles).cast("long")
    small = F.floor(total / n).cast("long")
    longer = total % n
    in_long = longer * (small + 1)
    return F.when(
        position <= in_long, F.ceil(position / (small + 1))
    ).otherwise(
        longer + F.ceil((position - in_long) / F.nullif(small, F.lit(0).cast("long")))
    ).cast("long")


def tile_end(tile: int, total: Column, n_tiles: int) -> Column:
    """Last position that belongs to ``tile``; the end of tile 0 is 0."""
    n = F.lit(n_tiles).cast("long")
    return F.lit(tile).cast("long") * F.floor(total / n).cast("long") + F.least(
        F.lit(tile).cast("long"), total % n
    )


def tile_ends(n_tiles: int) -> Callable[[tuple, int], list[int]]:
    """Last positions of all tiles but the last one, from a group's key and its number of rows."""

    def ends(group: tuple, total: int) -> list[int]:
        return [tile * (total // n_tiles) + min(tile, total % n_tiles) for tile in range(1, n_tiles)]

    return ends
