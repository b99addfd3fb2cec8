"""Schemas and fixed values of the trade data model."""

from __future__ import annotations

from pyspark.sql import types as T

FACT_KEYS = ["country_id", "partner_country_id", "product_id", "year"]
FACT_COLUMNS = [*FACT_KEYS, "export_value", "import_value", "eci", "coi", "pci"]

FACT_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in FACT_KEYS]
    + [T.StructField(name, T.DoubleType()) for name in FACT_COLUMNS[4:]]
)

# The literals below are part of the result definitions.
MIN_YEAR = 2012
LAST_BASE_YEAR = 2022
N_TILES = 4
TOP_FLOWS = 10
SOURCE_TABLE_MARK = "country_country_product_year"

HIGH = "High Complexity"
MEDIUM_HIGH = "Medium-High Complexity"
MEDIUM_LOW = "Medium-Low Complexity"
LOW = "Low Complexity"

BOTH_IMPROVING = "Both improving"
ECI_IMPROVING_ONLY = "ECI improving only"
BALANCE_IMPROVING_ONLY = "Balance improving only"
BOTH_WORSENING = "Both worsening"
NO_CHANGE_DATA = "No change data"

HHI_BANDS = [
    (0.15, "Highly Diversified"),
    (0.25, "Moderately Diversified"),
    (0.45, "Moderately Concentrated"),
]
HHI_REST = "Highly Concentrated"

SHARE_LABELS = {
    "high_complexity_share": HIGH,
    "medium_high_share": MEDIUM_HIGH,
    "medium_low_share": MEDIUM_LOW,
    "low_complexity_share": LOW,
}
GROWTH_LABELS = {
    "avg_high_complexity_growth": "High-complexity export growth",
    "avg_medium_high_growth": "Medium-high complexity export growth",
}
