"""A training corpus from ``documents``: quality, near copies, repeated passages, benchmark items, token ids.

``STAGES`` are (name, function) with function(spark, docs, sf_dir); each works on all that the stage before it kept, and
all but the last return the columns of ``documents``. What a stage decides about a row depends on its text, never on its
id alone, so rows that repeat an id or have none are judged one by one. In every stage a null text stays null, an empty
table gives an empty result, and columns beyond those of ``documents`` are dropped, whatever they are called. Each
function states what it does with null, empty and repeated texts.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import decontamination, quality_rules, sentence_pieces, word_windows
from tradeloom.llm import near_copies as near_copies_of
from tradeloom.llm.shipping import ship
from tradeloom.sources.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Near copies: texts whose sets of 5-word shingles are similar to this degree, shared shingles by all shingles of both.
SHINGLE, SIMILAR = 5, Fraction(4, 5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trees take for good ones, whatever their length; null texts are judged like empty ones."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.judge(docs.select(COLUMNS), labels, limits=False).where("kept").select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id, then hash; rows equal in all columns are one row.

    Rows without an id are compared like others and come after them. Rows with a null text stay; texts without words are
    copies of each other.
    """
    ship(spark)
    # Tells rows apart, also those that repeat an id or have none; rows that are equal in all columns are one.
    of_id = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    mark = F.concat(F.md5("text"), F.hex(F.xxhash64("lang", "source", "n_chars")), of_id)
    filled = docs.where("text is not null").select(*COLUMNS, mark.alias("mark"))
    chosen = near_copies_of.representatives(filled, SIMILAR, SHINGLE).select("mark")
    one_each = filled.join(chosen, "mark", "left_semi").dropDuplicates(["mark"]).select(COLUMNS)
    return one_each.unionByName(docs.where("text is null").select(COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that stand elsewhere too, in another row or in the same one."""
    ship(spark)
    # A null text has no windows, and comes back as it was.
    marked = docs.select(*COLUMNS, F.col("text").isNull().alias("was_null"))
    kept = word_windows.remove_repeats(marked, spaces=True)
    text = F.when(~F.col("was_null"), F.col("kept"))
    n_chars = F.when(F.col("was_null"), F.col("n_chars")).otherwise(F.length("kept"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", n_chars.cast("long").alias("n_chars"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found; null and empty texts stay."""
    ship(spark)
    # Equal texts share their fate, whatever their ids.
    marked = docs.select(*COLUMNS, F.md5("text").alias("mark"))
    texts = marked.select(F.col("mark").alias("doc_id"), "text")
    found = decontamination.matches(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # The stored list's size decides between a broadcast and a sort-merge join.
    leaked = stored(found.select(F.col("doc_id").alias("mark")).distinct(), "leaked")
    return marked.join(leaked, "mark", "left_anti").select(COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    ship(spark)
    encoded = sentence_pieces.encode_and_decode(docs.select(COLUMNS), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_free),
    ("sentencepiece", token_ids),
]

#: SQL has no boosted trees, fingerprint components or piece segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
