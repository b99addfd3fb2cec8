from .columns import (
    fixed_text,
    label_of,
    pct_change,
    percent_text,
    quartile_text,
    ratio,
    tier_of,
)
from .ordering import tile_at, tile_end, tile_ends, window_tiles
from .selection import between_positions, bins_of, with_rank

__all__ = [
    "between_positions",
    "bins_of",
    "fixed_text",
    "label_of",
    "pct_change",
    "percent_text",
    "quartile_text",
    "ratio",
    "tier_of",
    "tile_at",
    "tile_end",
    "tile_ends",
    "window_tiles",
    "with_rank",
]
