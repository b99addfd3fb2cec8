"""Catalog tables: discovery, checks, overwrite and merge sinks, views."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.curve import cell_bounds, curve_key
from ..operators.ingest import new_rows, new_rows_by_index, row_key
from .shared import discard, stored


def source_tables(
    spark: SparkSession,
    database: str,
    *,
    mark: str = S.SOURCE_TABLE_MARK,
    level: str | None = None,
) -> list[str]:
    """Names of the source tables in ``database``; an error when there are none.

    Tables of several classification levels would count trade more than once. ``level`` keeps
    those whose name ends in ``_<level>``.
    """
    listed = spark.catalog.listTables(database)
    # Temporary views are listed in every database.
    names = sorted(t.name for t in listed if mark in t.name and not t.isTemporary)
    if level is not None:
        names = [name for name in names if name.endswith(f"_{level}")]
    if not names:
        raise LookupError(f"no source tables in {database}")
    return names


def table_status(spark: SparkSession, table: str) -> tuple[bool, bool]:
    """Whether ``table`` exists, and whether it has rows (one row is looked for, none counted)."""
    if not spark.catalog.tableExists(table):
        return False, False
    return True, not spark.table(table).isEmpty()


def overwrite_table(df: DataFrame, table: str, *, partition_by: str | None = None) -> DataFrame:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


#: Whether an overwriting insert replaces all partitions or those that get rows.
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def replace_partitions(df: DataFrame, table: str, column: str, values: Sequence[int]) -> DataFrame:
    """Puts ``df`` in place of the partitions of ``values``; all of its rows lie in them.

    Rows are written once, aside, and take the place of their partitions when all are written. So ``df`` may be made from
    the table itself, and other partitions are not read. A partition that gets no rows is dropped.
    """
    spark = df.sparkSession
    before = _files(spark, table, column, values)
    mode = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        # The columns of an insert are taken by position.
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, mode)
    left = _files(spark, table, column, values) & before
    for value in values:
        if any(f"/{column}={value}/" in file for file in left):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = {value})")
    return spark.table(table)


def _files(spark: SparkSession, table: str, column: str, values: Sequence[int]) -> set[str]:
    """Files of the partitions of ``values``; others are not listed."""
    return set(spark.table(table).where(F.col(column).isin(list(values))).inputFiles())


def files_by_year(spark: SparkSession, table: str, *, without: str | None = None) -> dict[int, str]:
    """A digest of the names of each year's files, which change whenever rows are added or rewritten.

    Files with ``without`` in their path are left out.
    """
    names: dict[int, list[str]] = {}
    for file in spark.table(table).inputFiles():
        year = re.search(r"/year=(\d+)/", file)
        if year and not (without and without in file):
            names.setdefault(int(year[1]), []).append(file.rsplit("/", 1)[-1])
    return {y: hashlib.md5("\n".join(sorted(n)).encode()).hexdigest() for y, n in names.items()}


def years_with_files(spark: SparkSession, table: str) -> set[int] | None:
    """The years that a table has files of, and so all that it has rows of; None if it is not partitioned by year."""
    if "year" not in {c.name for c in spark.catalog.listColumns(table) if c.isPartition}:
        return None
    return set(files_by_year(spark, table))


#: Formats in which a table's rows follow from its files alone.
_PLAIN = ("parquet", "orc", "json", "csv")


def table_state(spark: SparkSession, table: str) -> str | None:
    """A digest of a table's columns and of its files' names, sizes and times; None where it does not follow from files.

    A view may be defined anew over the same files, so it has none, nor has a table without files.
    """
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if detail["Type"] == "VIEW" or detail.get("Provider", "").lower() not in _PLAIN:
        return None
    rows = spark.table(table)
    files = [unquote(file) for file in rows.inputFiles()]
    if not files or any(re.search(r"[*?{}\[\]\\]", file) for file in files):
        return None
    # The files are listed, not read.
    listed = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
    state = [rows.schema.json(), *sorted(repr(tuple(r)) for r in listed.collect())]
    return hashlib.md5("\n".join(state).encode()).hexdigest()


def clustered_by_year(fact: DataFrame) -> DataFrame:
    """Rows laid out for a table partitioned by year and sorted by country and product.

    Rebalancing gathers each year's rows and lets AQE split a large year into files of the
    advisory size, where a plain repartition would write a year in one task.
    """
    return fact.hint("rebalance", F.col("year")).sortWithinPartitions(
        "year", "country_id", "product_id"
    )


#: Columns that filters of a fact by curve may name alone.
CURVE_COLUMNS = ("country_id", "product_id")


def clustered_by_curve(fact: DataFrame) -> DataFrame:
    """Rows of each year in the order of a curve through ``CURVE_COLUMNS``.

    Sorting by country first spreads a product over all files of a year. Here a file holds a range of
    the curve, which is a block of countries by a block of products, so a filter on either column
    skips the files and row groups of other blocks. The key's columns follow in the range, so a cell
    with many rows is split over files like any other. ``fact`` is read three times, for the cells'
    bounds, the ranges and the rows: pass a stored one.
    """
    key = curve_key(cell_bounds(fact, CURVE_COLUMNS))
    keyed = fact.withColumn("_curve", key)
    order = ["year", "_curve", "country_id", "product_id", "partner_country_id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")


def write_fact_table(fact: DataFrame, table: str, *, curve: bool = False) -> DataFrame:
    """The fact partitioned by year; sorted by country first, or with ``curve`` by country and product alike."""
    rows = stored(fact, "fact") if curve else fact
    laid_out = clustered_by_curve(rows) if curve else clustered_by_year(rows)
    laid_out.write.mode("overwrite").partitionBy("year").saveAsTable(table)
    if curve:
        discard(rows)
    return fact_in(fact.sparkSession, table)


#: Rows of a fact table for which its key index has one bucket.
KEYS_A_BUCKET = 1_000_000


def key_index(table: str) -> str:
    """The name of a fact table's key index."""
    return f"{table}_keys"


def write_key_index(spark: SparkSession, table: str, *, buckets: int | None = None) -> DataFrame:
    """The distinct keys of a fact table, partitioned by year and bucketed by their hash.

    With it, a merge reads the keys of the batch's years only, and shuffles none of them. There is one
    file per year, bucket and merge; ``buckets`` are as many as the session's shuffle partitions, or more
    so that none gets over ``KEYS_A_BUCKET`` of the table's rows, since a merge sorts a bucket in one task.
    """
    if not buckets:
        rows = spark.table(table).count()
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // KEYS_A_BUCKET))
    keys = _indexed(fact_in(spark, table), buckets)
    writer = keys.write.mode("overwrite").partitionBy("year")
    writer.bucketBy(buckets, "key").sortBy("key").saveAsTable(key_index(table))
    return spark.table(key_index(table))


def _indexed(rows: DataFrame, buckets: int) -> DataFrame:
    keys = rows.select(*S.FACT_KEYS).distinct().withColumn("key", row_key())
    return keys.repartition(buckets, "key")


def append_new(
    spark: SparkSession,
    table: str,
    *sources: DataFrame,
    null_safe: bool = False,
    empty: Collection[int] = (),
) -> DataFrame:
    """Append the cleaned rows of ``sources`` whose key is not in ``table`` or an earlier source.

    The rows that were added are returned, as a stored table. A key index is used and kept up; after a
    merge that was broken off between the two it must be written again. ``empty`` may give the places of
    sources that are known to have no rows.
    """
    sources = tuple(rows for n, rows in enumerate(sources) if n not in empty) or sources[:1]
    index = key_index(table)
    if spark.catalog.tableExists(index):
        known = spark.table(index)
        found = new_rows_by_index(known, sources, null_safe=null_safe)
    else:
        known, years = None, years_with_files(spark, table)
        found = new_rows(fact_in(spark, table), sources, null_safe=null_safe, known_years=years)
    fresh = stored(found, "fresh")
    clustered_by_year(fresh).write.mode("append").partitionBy("year").saveAsTable(table)
    if known is not None:
        buckets = int(spark.sql(f"DESCRIBE EXTENDED {index}").where("col_name = 'Num Buckets'").first()["data_type"])
        writer = _indexed(fresh, buckets).write.mode("append").partitionBy("year")
        writer.bucketBy(buckets, "key").sortBy("key").saveAsTable(index)
    return fresh


def merge_into(
    spark: SparkSession, table: str, *sources: DataFrame, null_safe: bool = False
) -> DataFrame:
    """``append_new``, and the table with them."""
    discard(append_new(spark, table, *sources, null_safe=null_safe))
    return fact_in(spark, table)


def fact_in(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*S.FACT_COLUMNS)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def replace_database_view(spark: SparkSession, view: str, sql: str) -> DataFrame:
    """A view that the catalog keeps, so that later sessions read it by its full name.

    ``sql`` must name its tables with their database. A table of the same name makes way.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {sql}")
    return spark.table(view)
