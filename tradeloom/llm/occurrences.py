"""Steps that word and byte duplicates share: which keys occur twice, and results brought back to their documents.

A document is known by its id and a hash of its text (``version``), so that rows which repeat an id keep apart, rows that
are equal in full share their result, and a null id is an id like another.
"""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources.shared import stored

DOCUMENT = ["doc_id", "version"]


def versioned(documents: DataFrame, others: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, version, text), a null text as an empty one, and ``others`` by their new names."""
    text = F.coalesce("text", F.lit(""))
    return documents.select("doc_id", F.hash(text).alias("version"), text.alias("text"), *(F.col(f"`{c}`").alias(n) for n, c in (others or {}).items()))


def repeated_keys(keys: DataFrame, key: str) -> DataFrame:
    """(key) of those on two rows or more. Counts are combined before the shuffle.

    They are stored, since Spark splits a skewed partition only where both sides of a join come straight from a shuffle.
    """
    return stored(keys.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated-keys")


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["version"] == right["version"])


def with_lists(documents: DataFrame, rows: DataFrame, values: Column, name: str) -> DataFrame:
    """``versioned`` documents with the set of ``values`` that ``rows`` has of each: at most one for each place in it."""
    lists = rows.groupBy(*DOCUMENT).agg(F.collect_set(values).alias(name))
    return documents.join(lists, same_document(documents, lists), "left").select(*(documents[c] for c in documents.columns), name)


def release(spark: SparkSession) -> None:
    """Lets the context cleaner delete shuffle files of finished steps, which nothing refers to any more.

    Both sides hold references: Python's are dropped first, and the JVM learns of that a moment later.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
