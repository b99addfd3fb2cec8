"""Incremental load of landed files into the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.ingest import clean_source
from ..sources import tables
from ..sources.raw_csv import typed
from ..sources.shared import discard, stored


def landed_files(
    spark: SparkSession, landing: str, max_files: int | None = None, file_column: str | None = None
) -> DataFrame:
    """The stream of rows of landed files, with the path of each row's file if a column is named for it."""
    reader = (
        spark.readStream.schema(", ".join(f"{name} string" for name in S.FACT_COLUMNS))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", True)
        .option("pathGlobFilter", "*.gz")
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(landing)
    if file_column is None:
        return typed(rows)
    return typed(rows.withColumn(file_column, F.col("_metadata.file_path")))


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    table: str,
    progress: str,
    *,
    null_safe: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merge the files that arrived in ``landing`` since the last run, then stop.

    ``progress`` is a checkpoint folder on shared storage; it records which files are done. A batch
    that is repeated after a failure finds its keys in the table and adds nothing, which with
    ``null_safe=True`` includes rows without a partner. Files must have the columns of the data
    model in order, else the header check fails.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if tables.table_status(session, table)[1]:
            # Read once: text would be parsed again for each step of the merge.
            landed = stored(batch, "landed")
            tables.merge_into(session, table, landed, null_safe=null_safe)
            discard(landed)
        else:
            tables.write_fact_table(clean_source(batch), table)

    return (
        landed_files(spark, landing, max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
