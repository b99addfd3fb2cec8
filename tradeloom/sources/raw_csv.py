"""Landing, listing and reading of gzipped CSV source files."""

from __future__ import annotations

import csv
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .csv_records import examine, records
from .shared import path_exists

#: Errors of a read arrive in either form.
READ_ERRORS = (PySparkException, Py4JJavaError)

LOADED, SKIPPED, ERROR = "loaded", "skipped", "error"
UPLOADED, ALREADY_EXISTS = "uploaded", "already_exists"

_KNOWN = {f.name: f.dataType for f in S.FACT_SCHEMA.fields}

LANDING_SCHEMA = (
    "table_name string, status string, original_bytes long, landed_bytes long, seconds double, "
    "message string"
)
LOAD_SCHEMA = (
    "table_name string, files long, rows long, rejected long, status string, message string"
)


def list_files(spark: SparkSession, folder: str, glob: str, suffix: str) -> DataFrame:
    """Files below ``folder`` whose name matches ``glob``; only names and sizes are read.

    ``entry_path`` is the file or folder directly below ``folder`` that a file belongs to, and
    ``table_name`` the name of that entry without ``suffix``.
    """
    inside = "/" + folder.split(":", 1)[-1].strip("/") + "/"
    # The listed path may have a scheme and a host before the folder as it was given.
    below = F.substring_index(F.col("path"), inside, -1)
    entry = F.substring_index(below, "/", 1)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            F.regexp_replace(entry, suffix, "").alias("table_name"),
            F.concat(F.lit(folder.rstrip("/") + "/"), entry).alias("entry_path"),
            "path",
            "length",
        )
    )


def list_raw_files(spark: SparkSession, folder: str) -> DataFrame:
    """Gzipped files of a landing folder with the name of the table each belongs to.

    ``<folder>/<table>.csv.gz`` is one file, ``<folder>/<table>/*.csv.gz`` are parts of one table.
    """
    return list_files(spark, folder, "*.gz", r"(\.csv)?\.gz$")


#: How values are quoted, for files and for single records.
CSV_OPTIONS = {"mode": "PERMISSIVE", "escape": '"'}


def csv_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text rows of CSV files whose headers may have other columns or another order.

    One Spark job finds the header of each file and whether quoted values hold line breaks. Files
    with one header are one scan, with the columns as that header names them; scans are put together
    by name. Files of any kind are split over tasks, unless they are compressed.
    """
    found = examine(spark, paths)
    if not found.files:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in S.FACT_COLUMNS))
    if any(file.quoted_breaks for file in found.files):
        return _parsed(records(spark, found), found.headers())
    scans = []
    for header in found.headers():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in _names(header)])
        same = [file.path for file in found.files if file.header == header]
        scans.append(spark.read.options(header=True, **CSV_OPTIONS).schema(schema).csv(same))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff").removesuffix("\r")]))


def _by_name(parsed: Column, names: list[str], every: list[str]) -> Column:
    """The fields of a record as a list in the order of ``every``."""
    return F.array(*[parsed[f"c{names.index(n)}"] if n in names else F.lit(None).cast("string") for n in every])


def _parsed(rows: DataFrame, headers: list[str]) -> DataFrame:
    """Columns of all headers, each record read by its own one."""
    every = list(dict.fromkeys(name for header in headers for name in _names(header)))
    values = F.lit(None)
    for number, header in enumerate(headers):
        record = F.col("record")
        if header.endswith("\r"):
            record = F.regexp_replace(record, "\r(\n|$)", "$1")
        names = _names(header)
        ddl = ", ".join(f"c{n} string" for n in range(len(names)))
        # As the value of a variable the record is read once; a reference to each field would read it for each column.
        parsed = F.array(F.from_csv(record, ddl, CSV_OPTIONS))
        as_lists = F.transform(parsed, lambda p: _by_name(p, names, every))
        values = F.when(F.col("header") == number, as_lists[0]).otherwise(values)
    # Empty lines are no records.
    read = rows.where(F.trim("record") != "").select(values.alias("v"))
    return read.select(*[F.get("v", n).alias(name) for n, name in enumerate(every)])


def _typed_column(name: str) -> Column:
    """A known column in its type, NULL where it cannot be read; any other column as it is.

    An identifier may be written as a whole number with decimals, such as ``840.0``.
    """
    kind = _KNOWN.get(name)
    value = F.col(name)
    if kind is None:
        return value
    number = value.try_cast("double")
    if kind != T.LongType():
        return number
    whole = F.when(number == F.floor(number), number.try_cast("long"))
    return F.coalesce(value.try_cast("long"), whole)


def typed(text: DataFrame) -> DataFrame:
    """Give the known columns of text rows their types; what cannot be read becomes NULL."""
    return text.select(*[_typed_column(name).alias(name) for name in text.columns])


# How text of each type is written, from the narrowest type to the widest.
TYPE_PATTERNS = {
    "boolean": "^(?i)(true|false)$",
    "bigint": "^[+-]?[0-9]{1,18}$",
    "double": "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$",
}


def detected_types(text: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, type_name, non_empty) of text columns, by default of those the data model does not know.

    A column has the narrowest type that all its values have: bigint is within double and date
    within timestamp, anything else together is string, and a column without values is string.
    Empty values have every type. All rows are looked at, in one pass that sends one row per task.
    """
    names = [c for c in text.columns if c not in _KNOWN] if columns is None else list(columns)
    schema = "column_name string, type_name string, non_empty long"
    if not names:
        return text.sparkSession.createDataFrame([], schema)
    counts = []
    for n, name in enumerate(names):
        value = F.col(f"`{name}`")
        counts.append(F.count_if(value != "").alias(f"n{n}"))
        for kind, pattern in TYPE_PATTERNS.items():
            fits = value.rlike(pattern)
            if kind in ("date", "timestamp"):
                # The form alone does not make a date.
                fits = fits & value.try_cast(kind).isNotNull()
            counts.append(F.count_if((value != "") & fits).alias(f"{kind}{n}"))
    summed = text.agg(*counts)

    def type_of(n: int) -> Column:
        total = F.col(f"n{n}")
        number = F.col(f"bigint{n}"), F.col(f"double{n}")
        time = F.col(f"date{n}"), F.col(f"timestamp{n}")
        return (
            F.when(total == 0, "string")
            .when(F.col(f"boolean{n}") == total, "boolean")
            .when(number[0] == total, "bigint")
            # What is written as a whole number is written as a double, too.
            .when(number[1] == total, "double")
            .when(time[0] == total, "date")
            .when(time[0] + time[1] == total, "timestamp")
            .otherwise("string")
        )

    each = [
        F.struct(
            F.lit(name).alias("column_name"), type_of(n).alias("type_name"), F.col(f"n{n}").alias("non_empty")
        )
        for n, name in enumerate(names)
    ]
    return summed.select(F.inline(F.array(*each)))


def with_types(text: DataFrame, types: DataFrame) -> DataFrame:
    """Columns of ``text`` in the types that ``detected_types`` has found; empty values become NULL."""
    kinds = {r["column_name"]: r["type_name"] for r in types.collect()}

    def column(name: str) -> Column:
        kind, value = kinds.get(name), F.col(f"`{name}`")
        if kind is None:
            return value
        return value if kind == "string" else F.nullif(value, F.lit("")).try_cast(kind).alias(name)

    return text.select(*map(column, text.columns))


def unreadable(text: DataFrame) -> Column:
    """Whether a row of ``text`` has a value that the type of its column cannot hold."""
    tests = [
        (F.trim(F.col(name)) != "") & _typed_column(name).isNull()
        for name in text.columns
        if name in _KNOWN
    ]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def read_raw_csv(
    spark: SparkSession, paths: str | list[str], *, detect: bool = False
) -> DataFrame:
    """Rows of one table's CSV files, with columns found by the names in each file's header.

    Known columns get the types of the data model; others stay strings, or get the types of all
    their values with ``detect``. A row that is too short ends in NULLs.
    """
    text = csv_rows(spark, paths)
    return typed(with_types(text, detected_types(text)) if detect else text)


def write_raw_csv(rows: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Gzipped CSV parts, each with a header; one per task, so that readers work in parallel."""
    (
        rows.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("compression", "gzip")
        .csv(path)
    )


def land_csv(
    spark: SparkSession,
    source: str,
    landing: str,
    *,
    max_workers: int = 4,
) -> DataFrame:
    """Write each CSV of ``source`` as gzipped parts below ``landing``; report status, sizes and time.

    A table that is already landed is skipped. Tables are handled by parallel Spark jobs. The parts
    of a table may have other columns or another order: each is read by its own header, and what is
    landed has all columns of all parts, by name.
    """
    # A CSV is a file or a folder of parts directly below ``source``.
    found = {
        row["table_name"]: row
        for row in list_files(spark, source, "*.csv", r"\.csv$")
        .filter(F.col("entry_path").endswith(".csv"))
        .groupBy("table_name", "entry_path")
        .agg(F.sum("length").alias("length"))
        .collect()
    }
    present = {
        name
        for name, path in _landed_entries(spark, landing)
        if path.endswith(".gz") or path_exists(spark, f"{path}/_SUCCESS")
    }

    def land(name: str) -> tuple[str, float | None, str | None]:
        if name in present:
            return ALREADY_EXISTS, None, None
        start = time.monotonic()
        try:
            rows = csv_rows(spark, found[name]["entry_path"])
            # What an earlier failed run left has no ``_SUCCESS`` and is replaced.
            write_raw_csv(rows, f"{landing}/{name}", mode="overwrite")
            return UPLOADED, round(time.monotonic() - start, 3), None
        except READ_ERRORS as error:
            return ERROR, None, str(error)

    names = sorted(found)
    with ThreadPoolExecutor(max_workers) as pool:
        results = list(pool.map(land, names))
    landed = _table_sizes(spark, landing)
    return spark.createDataFrame(
        [
            (name, status, found[name]["length"], landed.get(name), seconds, message)
            for name, (status, seconds, message) in zip(names, results)
        ],
        LANDING_SCHEMA,
    )


def _landed_entries(spark: SparkSession, landing: str) -> list[tuple[str, str]]:
    """(table, file or folder) of a landing folder; none for one that does not exist yet."""
    if not path_exists(spark, landing):
        return []
    entries = list_raw_files(spark, landing).select("table_name", "entry_path").distinct()
    return [(name, path) for name, path in entries.collect()]


def _table_sizes(spark: SparkSession, landing: str) -> dict[str, int]:
    """Bytes per landed table; none for a landing folder that does not exist yet."""
    if not path_exists(spark, landing):
        return {}
    sizes = list_raw_files(spark, landing).groupBy("table_name").agg(F.sum("length"))
    return {name: length for name, length in sizes.collect()}


def load_raw_tables(
    spark: SparkSession,
    landing: str,
    database: str,
    *,
    mode: str = "append",
    max_workers: int = 4,
) -> DataFrame:
    """Load each landed table into ``database``; report rows, rejected rows and status per table.

    A row with a value that cannot be read is loaded with NULL there and counted as rejected, since
    cleaning leaves it out. Appending repeats rows when a file is loaded twice;
    ``mode="overwrite"`` makes a second load harmless. Tables are loaded by parallel Spark jobs, and
    an unreadable one does not stop the others. No shuffle is needed: parquet splits where gzip
    does not.
    """
    files = (
        list_raw_files(spark, landing)
        .groupBy("table_name")
        .agg(F.collect_set("path").alias("paths"))
        .orderBy("table_name")
        .collect()
    )

    def load(name: str, paths: list[str]) -> tuple:
        counted = Observation()
        try:
            text = csv_rows(spark, sorted(paths))
            marked = text.withColumn("_unreadable", unreadable(text)).observe(
                counted,
                F.count(F.lit(1)).alias("rows"),
                F.count_if(F.col("_unreadable")).alias("rejected"),
            )
            typed(marked.drop("_unreadable")).write.mode(mode).saveAsTable(f"{database}.{name}")
            found = counted.get
            return name, len(paths), found["rows"], found["rejected"], LOADED, None
        except READ_ERRORS as error:
            return name, len(paths), None, None, ERROR, str(error)

    with ThreadPoolExecutor(max_workers) as pool:
        report = list(pool.map(lambda row: load(*row), files))
    return spark.createDataFrame(report, LOAD_SCHEMA)


def load_summary(report: DataFrame) -> DataFrame:
    """Number of tables by outcome."""

    def tables(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status)

    return report.agg(
        F.count(F.lit(1)).alias("total"), tables(LOADED), tables(SKIPPED), tables(ERROR)
    )
