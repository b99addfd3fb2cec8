"""Product codes of several digit levels together: roll-up, and reconciliation without double counting.

A code of n digits is a number whose leading digits are the code of its parent, so 100630 belongs to
heading 1006 and chapter 10. Levels are numbers of digits. Rows are cleaned: their values are known.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.shared import stored

VALUES = ["export_value", "import_value"]
_OTHERS = ["eci", "coi", "pci"]


def ancestor(code: Column, digits: int, level: int) -> Column:
    """The code of ``level`` digits that a code of ``digits`` digits belongs to."""
    if level > digits:
        raise ValueError(f"a code of {digits} digits has no ancestor of {level}")
    return code if level == digits else F.call_function("div", code, F.lit(10 ** (digits - level)).cast("long"))


def reconciled(levels: Mapping[int, DataFrame]) -> DataFrame:
    """Fact rows of all levels with their ``level``, in which no trade is counted twice.

    The finest rows are kept as they are. Of what a coarser level reports for a country, partner,
    code and year, only the part remains that finer rows below the code do not account for; a row
    without finer rows remains as it is. Where finer rows exceed the coarser report they win and
    nothing remains. A NULL in a key is a value like any other.

    Per level there is one aggregate over the reported rows and the totals of the next finer level,
    combined on the map side, so a code or country with many rows sends only its distinct keys.
    """
    digits = sorted(levels, reverse=True)
    if not digits:
        raise ValueError("no levels to reconcile")
    kept = [levels[digits[0]].select(*S.FACT_COLUMNS, F.lit(digits[0]).alias("level"))]
    for level, rows in settled(levels).items():
        rest = rows.filter("reports > 0 and (covered = 0 or rest_export_value > 0 or rest_import_value > 0)")
        kept.append(
            rest.select(
                *S.FACT_KEYS, *[F.col(f"rest_{v}").alias(v) for v in VALUES], *_OTHERS, F.lit(level).alias("level")
            )
        )
    return reduce(DataFrame.unionByName, kept)


def settled(levels: Mapping[int, DataFrame]) -> dict[int, DataFrame]:
    """By level but the finest: reported, covered, remaining and total values of each key.

    ``reports`` and ``covered`` count the rows of the level and the keys of the next finer one. The
    total of a code is what is covered and what remains; it is what the next coarser level compares with.
    """
    digits = sorted(levels, reverse=True)
    finer = levels[digits[0]].select(*S.FACT_KEYS, *VALUES)
    found = {}
    for above, level in zip(digits, digits[1:]):
        own = levels[level].select(
            *S.FACT_KEYS, *VALUES, *_OTHERS, *[F.lit(0.0).alias(f"finer_{v}") for v in VALUES], F.lit(1).alias("own")
        )
        below = finer.select(
            *[c for c in S.FACT_KEYS if c != "product_id"],
            ancestor(F.col("product_id"), above, level).alias("product_id"),
            *[F.lit(0.0).alias(v) for v in VALUES],
            *[F.lit(None).cast("double").alias(c) for c in _OTHERS],
            *[F.col(v).alias(f"finer_{v}") for v in VALUES],
            F.lit(0).alias("own"),
        )
        sums = own.unionByName(below).groupBy(*S.FACT_KEYS).agg(
            F.sum("own").alias("reports"),
            F.count_if(F.col("own") == 0).alias("covered"),
            *[F.sum(v).alias(f"reported_{v}") for v in VALUES],
            *[F.sum(f"finer_{v}").alias(f"covered_{v}") for v in VALUES],
            *[F.max(c).alias(c) for c in _OTHERS],
        )
        rest = {
            f"rest_{v}": F.greatest(F.col(f"reported_{v}") - F.col(f"covered_{v}"), F.lit(0.0)) for v in VALUES
        }
        # Read twice: for what remains of this level, and as the finer totals of the next.
        found[level] = stored(sums.withColumns(rest), f"level-{level}")
        finer = found[level].select(
            *S.FACT_KEYS, *[(F.col(f"covered_{v}") + F.col(f"rest_{v}")).alias(v) for v in VALUES]
        )
    return found


def coverage(levels: Mapping[int, DataFrame]) -> DataFrame:
    """Per year and level: exports reported, covered by finer rows, remaining, and in excess of the report."""

    def of(level: int, rows: DataFrame) -> DataFrame:
        reported, covered = F.col("reported_export_value"), F.col("covered_export_value")
        return rows.filter("reports > 0").groupBy("year").agg(
            F.lit(level).alias("level"),
            F.count(F.lit(1)).alias("codes"),
            F.sum(reported).alias("reported"),
            F.sum(F.least(reported, covered)).alias("accounted"),
            F.sum("rest_export_value").alias("remaining"),
            F.sum(F.greatest(covered - reported, F.lit(0.0))).alias("excess"),
        )

    return reduce(DataFrame.unionByName, [of(level, rows) for level, rows in settled(levels).items()])


def rolled_up(rows: DataFrame, level: int) -> DataFrame:
    """Values of ``reconciled`` rows per country, code of ``level`` digits and year.

    What is known for a coarser code only is not in the codes below it: it comes out under that
    code, with its own ``level``.
    """
    digits = [r["level"] for r in rows.select("level").distinct().collect()]
    code = F.col("product_id")
    for n in digits:
        if n > level:
            code = F.when(F.col("level") == n, ancestor(F.col("product_id"), n, level)).otherwise(code)
    return (
        rows.withColumns({"product_id": code, "level": F.least("level", F.lit(level))})
        .groupBy("country_id", "product_id", "year", "level")
        .agg(*[F.sum(v).alias(v) for v in VALUES])
    )


def as_finest(rows: DataFrame, digits: int) -> DataFrame:
    """``reconciled`` rows as fact rows: a remainder gets its code with zeros up to ``digits``.

    This is how a nomenclature writes a heading that has no subdivision; the remainder is added to
    such a code where the finest level has it, as one row per key.
    """
    power = F.pow(F.lit(10.0), F.lit(digits) - F.col("level")).cast("long")
    coarse = rows.filter(F.col("level") < digits).withColumn("product_id", F.col("product_id") * power)
    fine = rows.filter(F.col("level") == digits)
    both = fine.unionByName(coarse).drop("level").groupBy(*S.FACT_KEYS)
    return both.agg(*[F.sum(v).alias(v) for v in VALUES], *[F.max(c).alias(c) for c in _OTHERS])
