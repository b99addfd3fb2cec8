"""Raw source tables to the combined fact table."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.shared import stored


def _valid_rows(raw: DataFrame, min_year: int) -> DataFrame:
    # A NULL value fails the sign tests, so no NULL is left to be replaced by zero.
    return raw.filter(
        (F.col("year") >= min_year) & (F.col("export_value") >= 0) & (F.col("import_value") >= 0)
    ).select(*S.FACT_COLUMNS)


def clean_source(raw: DataFrame, *, min_year: int = S.MIN_YEAR) -> DataFrame:
    """Distinct rows of one source table with a year in range and both values known and >= 0."""
    return _valid_rows(raw, min_year).distinct()


def combined_trade_data(sources: Sequence[DataFrame], *, min_year: int = S.MIN_YEAR) -> DataFrame:
    """Distinct cleaned rows of all source tables.

    One distinct after the union equals a distinct per source and another one after it, and
    shuffles once. Identical copies collapse before the shuffle.
    """
    if not sources:
        raise ValueError("no source tables to combine")
    return reduce(
        DataFrame.unionByName, [_valid_rows(source, min_year) for source in sources]
    ).distinct()


def new_rows(
    existing: DataFrame,
    sources: Sequence[DataFrame],
    *,
    null_safe: bool = False,
    min_year: int = S.MIN_YEAR,
    known_years: Collection[int] | None = None,
) -> DataFrame:
    """Cleaned rows of ``sources`` that an insert-only merge, source by source, adds to ``existing``.

    A key is (country, partner, product, year), and the first that has it, ``existing`` or a source,
    supplies its rows. By default a NULL in the key matches nothing, so such rows come out on every
    run; ``null_safe=True`` treats NULL as a key value. All sources are compared in one pass: the
    keys of the existing rows and of all sources are reduced to the first that has each, in one
    shuffle, and rows are kept where that is their own source. ``known_years`` may give the years, or
    more, that ``existing`` has rows of: a single source's rows of other years are new without comparison.
    """
    if known_years is not None and len(sources) == 1:
        (raw,) = sources
        if not known_years:
            return clean_source(raw, min_year=min_year)
        # A row without a year is not valid.
        known = F.col("year").isin(sorted(known_years))
        compared = new_rows(existing, [raw.filter(known)], null_safe=null_safe, min_year=min_year)
        return clean_source(raw.filter(~known), min_year=min_year).unionByName(compared)
    tagged = [
        _valid_rows(raw, min_year).withColumn("_source", F.lit(n)) for n, raw in enumerate(sources, 1)
    ]
    rows = reduce(DataFrame.unionByName, tagged)
    # Copies collapse here, before rows of one key meet.
    fresh = rows.distinct()
    # A struct equals another one with NULLs in the same places, so the reduction and the join are
    # on one expression and share a partitioning. What tells most keys apart comes first.
    key = F.struct(*sorted(S.FACT_KEYS, key="product_id".__ne__)).alias("_key")
    # Where ``existing`` is partitioned by year, other years are not read. One row per year; left to
    # itself, Spark expects as many as there are rows and shuffles ``existing`` by year, which puts
    # all keys of a year in one task.
    years = F.broadcast(rows.select("year").distinct())
    seen = existing.join(years, "year", "left_semi").select(*S.FACT_KEYS, F.lit(0).alias("_source"))
    keys = seen.unionByName(rows.select(*S.FACT_KEYS, "_source"))
    if not null_safe:
        keys = keys.dropna(subset=list(S.FACT_KEYS))
    first = keys.select(key, "_source").groupBy("_key").agg(F.min("_source").alias("_first"))
    # Only new keys meet the rows; a row without a whole key is new by itself.
    # Not an equality of two columns, which would become one more key of the join.
    of_first = F.col("_first").bitwiseXOR(F.col("_source")) == 0
    unkeyed = reduce(lambda a, b: a | b, [F.col(f"_key.{c}").isNull() for c in S.FACT_KEYS])
    # The key's columns are shuffled in the struct alone, and taken out of it after the join.
    values = [c for c in S.FACT_COLUMNS if c not in S.FACT_KEYS]
    return (
        fresh.select(key, *values, "_source")
        .join(first.filter(F.col("_first") > 0), "_key", "left")
        .filter(of_first if null_safe else of_first | unkeyed)
        # With a NULL in the key, a row that several sources have is new in each of them.
        .select(*[F.col(f"_key.{c}") if c in S.FACT_KEYS else F.col(c) for c in S.FACT_COLUMNS])
    )


def unkeyed_rows(raw: DataFrame, *, null_safe: bool = False) -> DataFrame:
    """Rows of ``raw`` that ``new_rows`` compares with nothing: all that it adds when every key of ``raw`` is known."""
    if null_safe:
        return raw.filter(F.lit(False))
    return raw.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in S.FACT_KEYS]))


def row_key() -> Column:
    """A hash of a row's key; rows of one key share it, and few others do."""
    return F.xxhash64(*S.FACT_KEYS)


def new_rows_by_index(
    index: DataFrame,
    sources: Sequence[DataFrame],
    *,
    null_safe: bool = False,
    min_year: int = S.MIN_YEAR,
) -> DataFrame:
    """``new_rows`` of sources against the keys of the existing rows.

    ``index`` has the distinct keys with ``key``, their ``row_key``, and is bucketed by it. The join is on
    that column alone, so the index is read bucket by bucket and never shuffled; the keys themselves
    are compared where hashes are equal. Only years of the batch are read.
    """
    tagged = [
        _valid_rows(raw, min_year).withColumn("_source", F.lit(n)) for n, raw in enumerate(sources, 1)
    ]
    fresh = stored(reduce(DataFrame.unionByName, tagged).distinct(), "merge-batch")
    years = [row["year"] for row in fresh.select("year").distinct().collect()]
    complete = [F.col(c).isNotNull() for c in S.FACT_KEYS]
    whole = F.lit(True) if null_safe else reduce(lambda a, b: a & b, complete)
    keys = fresh.where(whole).groupBy(row_key().alias("key"), *S.FACT_KEYS).agg(F.min("_source").alias("_first"))
    known = index.where(F.col("year").isin(years)).select("key", *[F.col(c).alias(f"_{c}") for c in S.FACT_KEYS])

    def same(c: str) -> Column:
        # Not an equality of two columns, which would become one more key of the join.
        equal = F.col(c).bitwiseXOR(F.col(f"_{c}")) == 0
        return F.coalesce(equal, F.col(c).isNull() & F.col(f"_{c}").isNull())

    is_known = reduce(lambda a, b: a & b, map(same, S.FACT_KEYS), keys["key"] == known["key"])
    unseen = keys.join(known, is_known, "left_anti").select(*[F.col(c).alias(f"_{c}") for c in S.FACT_KEYS], "_first")
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in S.FACT_KEYS])
    first = fresh.join(unseen, match & (F.col("_source") == F.col("_first"))).select(*S.FACT_COLUMNS)
    return first if null_safe else first.unionByName(fresh.where(~whole).select(*S.FACT_COLUMNS))


def unmatched_rows(
    existing: DataFrame, raw: DataFrame, *, null_safe: bool = False, min_year: int = S.MIN_YEAR
) -> DataFrame:
    """``new_rows`` of one source."""
    return new_rows(existing, [raw], null_safe=null_safe, min_year=min_year)


def merge_combined(
    existing: DataFrame,
    sources: Sequence[DataFrame],
    *,
    null_safe: bool = False,
    min_year: int = S.MIN_YEAR,
) -> DataFrame:
    """``existing`` plus, source by source, the rows with new keys (insert-only merge)."""
    rows = existing.select(*S.FACT_COLUMNS)
    if not sources:
        return rows
    return rows.unionByName(new_rows(rows, sources, null_safe=null_safe, min_year=min_year))
