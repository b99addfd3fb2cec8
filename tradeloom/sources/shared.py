"""Tables written once to the cluster's shared folder and read back.

A relation that several branches of a plan need, or whose size decides a join, is written as
parquet below ``spark.checkpoint.dir``. That cuts the lineage in a way that survives the loss of
executors, and it gives Catalyst the size of the files, so that a broadcast is chosen only where
that size is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}
_scopes = threading.local()


#: Spark's setting for the bytes of files that a task reads, its default, and what ``bounded_splits`` makes of that.
_SPLIT, _SPARK_SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", "134217728b", "16777216b"
#: The same for the bytes of a shuffle that a task reads, and for the partitions that these are put together from.
_ADVISORY, _SPARK_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "67108864b"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: One partition for so many bytes of input files. The largest shuffle of a merge has about five times their size.
INPUT_BYTES_A_PARTITION = 1 << 21

#: The compression of parquet files, Spark's default, and what ``bounded_splits`` makes of that: smaller files.
_CODEC, _SPARK_CODEC, CODEC = "spark.sql.parquet.compression.codec", "snappy", "zstd"

#: The number of partitions that ``bounded_splits`` has given to a session, by application.
_partitions: dict[str, str] = {}


def bounded_splits(spark: SparkSession, input_bytes: int = 0) -> None:
    """Lets a task read SPLIT_BYTES of files or of a shuffle, unless the session has been given sizes of its own.

    Tables of keys and whole numbers take some ten bytes a row in parquet, and a hundred or more in a task's hash table. By
    default a task would read over ten million rows, and nearly all of them are groups of their own in the partial
    aggregates by product and in the distinct rows: these spill as soon as there is a full split to read. A smaller
    split bounds what a task holds, whatever the size of the input. The same holds after a shuffle, where the number of
    partitions is fixed beforehand: it follows from ``input_bytes``, is never below that of the session, and AQE puts
    small partitions together.
    """
    if spark.conf.get(_SPLIT) == _SPARK_SPLIT:
        spark.conf.set(_SPLIT, SPLIT_BYTES)
    if spark.conf.get(_ADVISORY) == _SPARK_ADVISORY:
        spark.conf.set(_ADVISORY, SPLIT_BYTES)
    if spark.conf.get(_CODEC) == _SPARK_CODEC:
        spark.conf.set(_CODEC, CODEC)
    application = spark.sparkContext.applicationId
    if spark.conf.get(_INITIAL, None) in (None, _partitions.get(application)):
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _partitions[application] = str(max(least, -(-input_bytes // INPUT_BYTES_A_PARTITION)))
        spark.conf.set(_INITIAL, _partitions[application])


def file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, folder: str) -> bool:
    path, files = file_system(spark, folder)
    return files.exists(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can read, private to this application and removed at its end.

    ``spark.checkpoint.dir`` names its parent. Where that is unset, a local master gets a temporary
    folder; on a cluster that would not be visible to the executors, so it is an error there.
    """
    application = spark.sparkContext.applicationId
    if application not in _folders:
        parent = spark.conf.get("spark.checkpoint.dir", None)
        if not parent:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the whole cluster")
            parent = tempfile.mkdtemp(prefix="tradeloom-")
        folder = f"{parent.rstrip('/')}/tradeloom-{application}-{uuid.uuid4().hex[:8]}"
        path, files = file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[application] = folder
    return _folders[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder, or in the innermost scope, that no earlier call has returned."""
    open_ = getattr(_scopes, "open", None)
    folder = open_[-1] if open_ else shared_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that this thread stores inside, once they have been read."""
    path = new_path(spark, "scope")
    _scopes.open = [*getattr(_scopes, "open", []), path]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        folder, files = file_system(spark, path)
        files.delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Removes stored tables that nothing reads any more."""
    for table in tables:
        path, files = file_system(table.sparkSession, table._stored_at)
        files.delete(path, True)


def stored(df: DataFrame, name: str, *, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # The schema is given, because the type of a partition column would otherwise be guessed.
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table
