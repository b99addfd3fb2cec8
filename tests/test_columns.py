from __future__ import annotations

from pyspark.sql import functions as F

from tradeloom import schema as S
from tradeloom.functions import (
    fixed_text,
    label_of,
    pct_change,
    percent_text,
    quartile_text,
    ratio,
    tier_of,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_ratio_of_zero_is_null(spark):
    assert value(spark, ratio(F.lit(1.0), F.lit(0.0))) is None
    assert value(spark, ratio(F.lit(1.0), F.lit(4.0))) == 0.25
    assert value(spark, ratio(F.lit(None).cast("double"), F.lit(4.0))) is None


def test_pct_change(spark):
    assert value(spark, pct_change(F.lit(3.0), F.lit(2.0))) == 50.0
    assert value(spark, pct_change(F.lit(-1.0), F.lit(-2.0))) == -50.0
    assert value(spark, pct_change(F.lit(-1.0), F.lit(-2.0), signed_base=True)) == 50.0
    assert value(spark, pct_change(F.lit(1.0), F.lit(0.0))) is None


def test_texts(spark):
    assert value(spark, percent_text(F.lit(0.1234))) == "12.3%"
    assert value(spark, percent_text(F.lit(-1.5))) == "-150.0%"
    assert value(spark, percent_text(F.lit(None).cast("double"))) is None
    rows = [0.125, 0.625, -0.125, 0.0625, 2.675, 1.005, 0.995, 99.995, -0.0, -0.001, 2.0**45 + 0.125]
    rows += [k / 32 for k in range(-70, 70)] + [k / 1000 for k in range(-300, 300)]
    df = spark.createDataFrame([(v,) for v in rows], "v double")
    for r in df.select("v", fixed_text(F.col("v")).alias("f"), percent_text(F.col("v")).alias("p")).collect():
        assert (r.f, r.p) == (f"{r.v:.2f}", f"{r.v:.1%}")
    assert value(spark, fixed_text(F.lit(None).cast("double"))) is None
    assert value(spark, quartile_text(F.lit(3).cast("long"))) == "Q3"


def test_labels(spark):
    code = F.lit("high_complexity_share")
    assert value(spark, label_of(code, S.SHARE_LABELS)) == S.HIGH
    assert value(spark, label_of(F.lit("other"), S.SHARE_LABELS)) is None
    tiers = [value(spark, tier_of(F.lit(q))) for q in (4, 3, 2, 1)]
    assert tiers == [S.HIGH, S.MEDIUM_HIGH, S.MEDIUM_LOW, S.LOW]


def test_quartile_sizes_differ_by_one_at_most(bench):
    for table, group, tile in [
        (bench.complexity, "year", "complexity_quartile"),
        (bench.growth, "base_year", "coi_quartile"),
    ]:
        sizes = table.groupBy(group, tile).count().groupBy(group)
        uneven = sizes.agg((F.max("count") - F.min("count")).alias("d")).filter(F.col("d") > 1)
        assert uneven.count() == 0
