from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import SMALL  # noqa: E402

from tradeloom import schema as S  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tradeloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bench(spark):
    from tradeloom.plans.workbench import workbench

    return workbench(spark, SMALL)


@pytest.fixture
def fact_of(spark):
    """Fact rows from tuples (country, partner, product, year, export, import, eci, coi, pci)."""

    def make(*rows):
        full = [(*row, *(0.0,) * (9 - len(row))) for row in rows]
        typed = [tuple(float(v) if v is not None and i > 3 else v for i, v in enumerate(r))
                 for r in full]
        return spark.createDataFrame(typed, S.FACT_SCHEMA)

    return make
