"""Quality rules: fixed limits on document statistics, then boosted trees over them.

All statistics of a slice of texts are computed at once in numpy. The trees are trained on at most ``SAMPLE`` labelled
documents, chosen by the hash of their id, and their margin may only fall as the repetition and symbol shares rise.

A null or empty text has no words and fails; repeated rows stay repeated; an empty table gives an empty result; without
labels, or with only one kind, the trees reject nothing; extra columns stay as they are, one called like a result column
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm import boosted_trees
from tradeloom.llm.texts import Texts, mix, per_range, slices, span_hashes, window_hashes, words

#: Labelled documents used for training at most; one in five is held out to choose the limit of the score.
SAMPLE = 20_000
#: Share of good held-out documents that the limit must keep.
KEEP_GOOD = 0.998
#: Fewest words, and largest share of repeated words in percent.
MIN_WORDS = 50
MAX_REPEATED = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the trees and the direction in which the margin may move.
FEATURES = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 0,
    "upper_share": -1,
    "digit_share": -1,
    "punctuation_per_word": 0,
    "bar_per_word": -1,
    "exclamation_per_word": -1,
    "lone_mark_share": -1,
    "words_per_line": 0,
    "stop_per_word": 0,
    "longest_run_share": -1,
}


def _table(characters: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(characters.encode())] = True
    return flags


_SYMBOLS = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _table("0123456789")
_PUNCTUATION = _table(".,;:!?")
_LETTERS = _UPPER | _table("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0x80)


def statistics(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(texts, COUNTS) whole numbers and (texts, FEATURES) values."""
    data, n = texts.data, len(texts)
    found = words(texts)
    n_words = found.counts()
    whole = np.zeros(len(data) + 1, np.int64)
    whole[found.starts] = 1
    whole[found.ends] -= 1
    in_word = np.cumsum(whole[:-1]) > 0
    points = (data & 0xC0) != 0x80
    word_chars = texts.count(in_word & points)

    # Lines with a word, by the hash of their bytes within the text.
    edge = np.zeros(len(data) + 1, bool)
    edge[texts.offsets] = True
    edge[np.flatnonzero(data == 0x0A)] = True
    line_ends = np.flatnonzero(edge[1:]) + 1
    line_starts = np.flatnonzero(edge[:-1])
    line_starts = line_starts + (data[line_starts] == 0x0A) if len(data) else line_starts
    # A text's first byte starts a line even if that byte is the line break itself; such an empty line has no word.
    filled = np.searchsorted(found.starts, line_ends) > np.searchsorted(found.starts, line_starts)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    line_text = np.searchsorted(texts.offsets, line_starts, "right") - 1
    line_keys = mix(span_hashes(data, line_starts, line_ends) + line_text.astype(np.uint64))
    n_lines = np.bincount(line_text, minlength=n)
    _, first = np.unique(line_keys, return_index=True)
    n_dup_lines = n_lines - np.bincount(line_text[first], minlength=n)

    text_of = found.text_of()
    hashes = mix(span_hashes(data, found.starts, found.ends) + text_of.astype(np.uint64))
    windows = window_hashes(hashes, 3)
    inside = text_of[: len(windows)] == text_of[2:] if len(windows) else np.zeros(0, bool)
    repeated = np.zeros(len(hashes), bool)
    _, number, times = np.unique(windows[inside], return_inverse=True, return_counts=True)
    at = np.flatnonzero(inside)[times[number] > 1]
    for k in range(3):
        repeated[at + k] = True
    n_repeat_words = per_range(repeated, found.offsets)
    counts = np.stack([n_words, word_chars, texts.count(_SYMBOLS[data]), n_dup_lines, n_repeat_words], 1).astype(np.int64)

    _, first, times = np.unique(hashes, return_index=True, return_counts=True)
    n_distinct = np.bincount(text_of[first], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text_of[first], times)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    letters = np.concatenate([[0], np.cumsum(_LETTERS[data])])
    lone = letters[found.ends] == letters[found.starts]
    short = (found.ends - found.starts) <= 3
    per_word, size = np.maximum(n_words, 1), np.maximum(texts.sizes(), 1)
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / per_word,
            counts[:, 2] / per_word,
            n_dup_lines / np.maximum(n_lines, 1),
            n_repeat_words / per_word,
            n_distinct / per_word,
            texts.count(_UPPER[data]) / size,
            texts.count(_DIGITS[data]) / size,
            texts.count(_PUNCTUATION[data]) / per_word,
            texts.count(data == 0x7C) / per_word,
            texts.count(data == 0x21) / per_word,
            per_range(lone, found.offsets) / per_word,
            n_words / np.maximum(n_lines, 1),
            per_range(short, found.offsets) / per_word,
            per_range(same, found.offsets) / per_word,
        ],
        1,
    )
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED * counts[:, 0])


def labelled_features(documents: DataFrame, labels: DataFrame, limits: bool) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most SAMPLE documents, those outside the limits left out if the limits hold."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .withColumn("_order", F.xxhash64("doc_id"))
        .orderBy("_order", "doc_id")
        .limit(SAMPLE)
    )
    # At most SAMPLE rows of three numbers.
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            counts, features = statistics(texts)
            good = ~base_failed(counts) if limits else np.ones(len(counts), bool)
            flat = pa.array(features[good].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(good.sum() + 1, dtype=np.int32) * len(FEATURES)), flat)
            yield pa.RecordBatch.from_arrays([texts.rows.column("doc_id").filter(pa.array(good)), texts.rows.column("_order").filter(pa.array(good)), texts.rows.column("quality").filter(pa.array(good)).cast(pa.int32()), lists], names=["doc_id", "_order", "quality", "features"])

    # Of documents with one id the first by statistics counts, so the bound holds.
    found = rows.mapInArrow(measure, "doc_id long, _order long, quality int, features array<double>").groupBy("_order", "doc_id").agg(F.min("quality").alias("quality"), F.min("features").alias("features"))
    table = found.orderBy("_order", "doc_id").toArrow()
    values = np.array(table.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
    return values, table.column("quality").to_numpy().astype(float)


def fit(documents: DataFrame, labels: DataFrame, limits: bool = True) -> tuple[boosted_trees.Forest, float]:
    """Trees and the lowest margin that is kept."""
    values, good = labelled_features(documents, labels, limits)
    held = len(good) // 5
    fitted = len(good) - held
    forest = boosted_trees.train(values[:fitted], good[:fitted], np.array(list(FEATURES.values())))
    margins = forest.margins(values[fitted:])[good[fitted:] == 1]
    if not len(forest.leaf) or not len(margins):
        return forest, -np.inf
    return forest, float(min(0.0, np.quantile(margins, 1 - KEEP_GOOD)))


def judge(documents: DataFrame, labels: DataFrame, limits: bool = True) -> DataFrame:
    """Adds the counts, ``base_failed``, ``quality_margin`` and ``kept``.

    Without ``limits`` the trees alone decide, and are trained on documents of every length.
    """
    forest, limit = fit(documents, labels, limits)
    added = {**dict.fromkeys(COUNTS, "long"), "base_failed": "boolean", "quality_margin": "double", "kept": "boolean"}
    kept_names = [f.name for f in documents.schema if f.name not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            counts, features = statistics(texts)
            failed, margins = base_failed(counts), forest.margins(features)
            yield pa.RecordBatch.from_arrays(
                [*(texts.rows.column(n) for n in kept_names), *(pa.array(c) for c in counts.T.copy()), pa.array(failed), pa.array(margins), pa.array((margins >= limit) & ~(failed & limits))],
                names=[*kept_names, *added],
            )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema if f.name not in added]
    return documents.mapInArrow(run, ", ".join(schema + [f"{n} {t}" for n, t in added.items()]))
