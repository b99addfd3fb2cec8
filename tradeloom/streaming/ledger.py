"""Batches that can be repeated: each batch's rows carry its name, and a ledger lists its files.

The fact is partitioned by batch and year. A batch that comes again after a failure replaces its own
partitions, looking only at the rows of other batches for known keys, so it adds nothing twice even
where a NULL in the key matches nothing. Once the ledger has a batch, it is passed over.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.ingest import new_rows
from ..plans import build
from ..sources import tables
from ..sources.shared import discard, stored
from .incremental import landed_files

BATCH, FILE = "batch", "file"
_VALUES = [c for c in S.FACT_COLUMNS if c != "year"]


def ledger_of(table: str) -> str:
    """The name of a fact table's ledger: (batch, file), written after the batch's rows."""
    return f"{table}_batches"


def _create(spark: SparkSession, table: str) -> None:
    """Both tables, where they are missing."""
    if not spark.catalog.tableExists(table):
        kinds = {f.name: f.dataType.simpleString() for f in S.FACT_SCHEMA} | {BATCH: "string"}
        columns = ", ".join(f"{c} {kinds[c]}" for c in [*_VALUES, BATCH, "year"])
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({BATCH}, year)")
    if not spark.catalog.tableExists(ledger_of(table)):
        spark.sql(f"CREATE TABLE {ledger_of(table)} ({BATCH} string, {FILE} string) USING parquet")


def is_done(spark: SparkSession, table: str, batch: str) -> bool:
    ledger = ledger_of(table)
    return spark.catalog.tableExists(ledger) and not spark.table(ledger).where(F.col(BATCH) == batch).isEmpty()


def add_batch(
    spark: SparkSession, table: str, batch: str, rows: DataFrame, *, null_safe: bool = False
) -> build.Added | None:
    """Adds the cleaned rows of a batch whose key no other batch has; None if the ledger has the batch.

    ``rows`` has the columns of the data model and ``file``, where each row comes from. Within the
    batch all distinct rows of a new key are kept. The ledger is written last: a batch that broke off
    before is done again, and its partitions, whole or torn, are replaced.
    """
    if not re.fullmatch("[A-Za-z0-9._-]+", batch):
        raise ValueError(f"not a name for a batch: {batch}")
    if is_done(spark, table, batch):
        return None
    _create(spark, table)
    # Read once: text would be parsed again for each step below.
    landed = stored(rows.select(*S.FACT_COLUMNS, FILE), "landed")
    others = spark.table(table).where(F.col(BATCH) != batch).select(*S.FACT_COLUMNS)
    # The rows of a first attempt may be in the totals already; they are not those of other batches.
    before = tables.files_by_year(spark, table, without=f"/{BATCH}={batch}/")
    fresh = stored(new_rows(others, [landed], null_safe=null_safe, known_years=before), "batch")
    # With the batch given, all that lies below its folder is replaced, and nothing else.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = '{batch}', year) SELECT * FROM {{rows}}",
        rows=tables.clustered_by_year(fresh).select(*_VALUES, "year"),
    )
    files = landed.select(F.lit(batch).alias(BATCH), F.col(FILE)).distinct().coalesce(1)
    files.write.mode("append").insertInto(ledger_of(table))
    discard(landed)
    return build.Added(fresh, before)


def ingest_batches(
    spark: SparkSession,
    landing: str,
    database: str,
    progress: str,
    *,
    null_safe: bool = False,
    max_files: int | None = None,
    with_metrics: bool = True,
) -> StreamingQuery:
    """Adds the files that arrived in ``landing`` since the last run to the fact of ``database``, then stops.

    After each batch the metric tables are brought up to date for its years. ``progress`` is a
    checkpoint folder on shared storage, whose path also names the batches; a batch that is repeated
    after a failure is known by its name.
    """
    table = f"{database}.{build.COMBINED}"
    stream = hashlib.md5(progress.encode()).hexdigest()[:8]

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        added = add_batch(session, table, f"{stream}-{number:09d}", batch, null_safe=null_safe)
        # Also after a repeated batch: its rows may be in without their metrics.
        if with_metrics and tables.table_status(session, table)[1]:
            build.build_metrics(session, database, added)
        if added:
            discard(added.rows)

    return (
        landed_files(spark, landing, max_files, file_column=FILE)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
