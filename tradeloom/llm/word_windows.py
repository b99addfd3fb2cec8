"""Removal of word windows that occur more than once, through anchors at difference-cover positions.

A difference cover of period v has, for any two positions, a shift below v that takes both to cover positions. So two
equal windows of ``window`` words share an anchor of ``window - v + 1`` words that starts at a cover position in both
documents, and only a few anchors in v need hashing. Anchors that occur twice are extended to all windows around them,
and the windows that occur twice are removed. Each step is a count combined before its shuffle and a semi join, whose
skewed partitions Spark can split; rows are hashes and places, never texts or pairs.

A null or short text loses nothing; rows that repeat an id are documents by their texts; rows equal in full are copies
of each other and both lose their windows; an empty table gives an empty result; extra columns are dropped. Windows are
compared by 64-bit hashes of their word sequence: among a trillion candidate windows one in 20 million meets a stranger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.occurrences import DOCUMENT, release, repeated_keys, same_document, versioned, with_lists
from tradeloom.llm.texts import Texts, Words, slices, span_hashes, to_long, window_hashes, words
from tradeloom.sources.shared import discard, stored

WINDOW = 35

# Perfect difference sets by period.
COVERS = {1: [0], 3: [0, 1], 7: [0, 1, 3], 13: [0, 1, 3, 9], 21: [0, 1, 4, 14, 16]}


def period_for(window: int) -> int:
    """The longest period that leaves anchors of two fifths of the window."""
    return max(v for v in COVERS if v == 1 or 5 * (window - v + 1) >= 2 * window)


def _hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    found = words(texts)
    return found, span_hashes(texts.data, found.starts, found.ends)


def anchors(documents: DataFrame, window: int) -> DataFrame:
    """(anchor, doc_id, version, word) of each cover position of documents with a whole window."""
    period = period_for(window)
    length = window - period + 1
    cover = np.zeros(period, bool)
    cover[COVERS[period]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            found, hashes = _hashes(texts)
            keys = window_hashes(hashes, length)
            text = found.text_of()[: len(keys)]
            place = np.arange(len(keys)) - found.offsets[text]
            room = found.offsets[text + 1] - np.arange(len(keys))
            at = np.flatnonzero(cover[place % period] & (room >= length) & (found.counts()[text] >= window))
            owner = pa.array(text[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(to_long(keys[at])), *(texts.rows.column(c).take(owner) for c in DOCUMENT), pa.array(place[at].astype(np.int32))],
                names=["anchor", *DOCUMENT, "word"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"anchor long, doc_id {kind}, version int, word int")


def _windows_around(documents: DataFrame, window: int) -> DataFrame:
    """(hash, doc_id, version, word) of each window that holds an anchor of the ``words`` list of its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            found, hashes = _hashes(texts)
            keys = window_hashes(hashes, window)
            at = np.flatnonzero(_candidates(texts, found, window))
            text = found.text_of()[at]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to_long(keys[at])), *(texts.rows.column(c).take(rows) for c in DOCUMENT), pa.array((at - found.offsets[text]).astype(np.int32))],
                names=["hash", *DOCUMENT, "word"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"hash long, doc_id {kind}, version int, word int")


def _candidates(texts: Texts, found: Words, window: int) -> np.ndarray:
    """Whether a window starts at a word and holds a listed anchor in its first ``period`` places."""
    period = period_for(window)
    lists = texts.rows.column("words")
    owner = np.repeat(np.arange(len(texts)), np.diff(_list_offsets(lists)))
    anchor = _list_values(lists) + found.offsets[owner]
    first = np.maximum(anchor - period + 1, found.offsets[owner])
    last = np.minimum(anchor, found.offsets[owner + 1] - window)
    some = last >= first
    step = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(step, first[some], 1)
    np.add.at(step, last[some] + 1, -1)
    return np.cumsum(step[:-1]) > 0


def _list_offsets(lists: pa.ListArray) -> np.ndarray:
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _list_values(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def with_candidates(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents with ``words``, their anchors that occur twice, and ``single``, the windows around these that do not."""
    spark = documents.sparkSession
    found = anchors(documents, window)
    twice = repeated_keys(found, "anchor")
    shared = stored(found.join(twice, "anchor", "left_semi").select(*DOCUMENT, "word"), "anchors")
    discard(twice)
    release(spark)
    # Documents without a shared anchor have no list and drop out.
    lists = shared.groupBy(*DOCUMENT).agg(F.collect_set("word").alias("words"))
    texts = documents.select(*DOCUMENT, "text")
    texts = texts.join(lists, same_document(texts, lists)).select(*(texts[c] for c in texts.columns), "words")
    # Nearly all candidates repeat, so the few that do not are named; the one row of such a hash has its place.
    alone = _windows_around(texts, window).groupBy("hash").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in (*DOCUMENT, "word")))
    single = stored(alone.where("n = 1").select(*DOCUMENT, "word"), "single-windows")
    release(spark)
    return with_lists(with_lists(documents, shared, F.col("word"), "words"), single, F.col("word"), "single")


def remove_repeats(documents: DataFrame, window: int = WINDOW, spaces: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` has the words that stay, joined by one space.

    With ``spaces`` only the removed words and the white space after each of them go from the text. Then all other
    columns of ``documents`` follow, those called like a result column left out.
    """
    others = [c for c in documents.columns if spaces and c not in ("doc_id", "text", "n_words", "n_removed", "kept")]
    aside = {f"_other{n}": c for n, c in enumerate(others)}
    texts = versioned(documents, aside)
    marked = with_candidates(texts, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slice_ in slices(batches):
            found = words(slice_)
            repeated = _candidates(slice_, found, window)
            single = slice_.rows.column("single")
            repeated[_list_values(single) + np.repeat(found.offsets[:-1], np.diff(_list_offsets(single)))] = False
            start = np.flatnonzero(repeated)
            step = np.zeros(len(found.starts) + 1, np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + window, -1)
            removed = np.cumsum(step[:-1]) > 0
            n_removed = np.diff(np.concatenate([[0], np.cumsum(removed)])[found.offsets])
            kept = _spaced(slice_, found, removed) if spaces else _joined(slice_, found, ~removed)
            yield pa.RecordBatch.from_arrays(
                [slice_.rows.column("doc_id"), pa.array(found.counts()), pa.array(n_removed), kept, *(slice_.rows.column(c) for c in aside)],
                names=["doc_id", "n_words", "n_removed", "kept", *others],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    more = "".join(f", `{c}` {documents.schema[c].dataType.simpleString()}" for c in others)
    return marked.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string{more}")


def _spaced(texts: Texts, found: Words, removed: np.ndarray) -> pa.Array:
    """Each text without its removed words and what stands between them and the next word or the end."""
    end = np.repeat(texts.offsets[1:], found.counts())
    upto = np.where(np.append(np.diff(found.text_of()) == 0, False), np.append(found.starts[1:], 0), end) if len(found.starts) else end
    step = np.zeros(len(texts.data) + 1, np.int64)
    np.add.at(step, found.starts[removed], 1)
    np.add.at(step, upto[removed], -1)
    keep = np.cumsum(step[:-1]) == 0
    data = texts.data[keep].tobytes()
    ends = np.concatenate([[0], np.cumsum(keep)])[texts.offsets].tolist()
    return pa.array([data[i:j] for i, j in zip(ends, ends[1:])], pa.binary()).cast(pa.string())


def _joined(texts: Texts, found: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    starts, lengths = found.starts[keep], (found.ends - found.starts)[keep]
    target = np.concatenate([[0], np.cumsum(lengths + 1)])
    spaced = np.full(target[-1], 0x20, np.uint8)
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    spaced[np.repeat(target[:-1], lengths) + within] = texts.data[np.repeat(starts, lengths) + within]
    count = np.diff(np.concatenate([[0], np.cumsum(keep)])[found.offsets])
    upto = np.concatenate([[0], np.cumsum(count)])
    # Each text ends before the space after its last word.
    view = spaced.tobytes()
    begin, end = target[upto[:-1]], target[upto[1:]] - (count > 0)
    return pa.array([view[i:j] for i, j in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()).cast(pa.string())
