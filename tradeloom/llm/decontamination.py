"""Benchmark items inside documents, whole, changed in places or in part, by the q-gram lemma.

Texts are lower-cased, and runs of anything but letters and digits become one space. Items are cut into overlapping
pieces of PIECE bytes. A piece of m bytes that occurs with at most e edits shares at least m - q + 1 - q * e of its q-grams
with the place where it occurs, and all of them lie on diagonals (place in the text less place in the piece) that differ
by at most e. So the q-grams of a document are looked up in an index of the pieces, places are first pruned by how many
q-grams of any piece stand close together, then counted per piece in overlapping bands of 2 * (e + 1) diagonals, and
bands that reach the bound are verified by an alignment within the band. An item is found where the pieces found cover
``least`` of it: an excerpt, or what is left between changed words. Items of less than 2 * q bytes are found as they are,
from word to word.

Pieces are cut in Spark, dealt by hash into blocks of about BLOCK_BYTES, and broadcast block by block; tasks build the
index, and a block's matches are stored before the next one. Null and empty texts and items match nothing; items may
repeat, each is reported; rows that repeat an id are reported one by one, rows equal in id and text once; empty tables
give an empty result; extra columns are dropped.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.texts import Texts, mix, slices
from tradeloom.sources.shared import stored

Q = 8
#: Bytes of a piece, and from one piece to the next.
PIECE, STEP = 48, 16
#: Edits allowed, as a share of the piece's bytes.
EDITS = 0.0834
#: Share of an item that the pieces found must cover.
LEAST = 0.25
#: Bytes of pieces in one broadcast block.
BLOCK_BYTES = 4 << 20

_PLAIN = np.full(256, 0x20, np.uint8)
for _byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _PLAIN[_byte] = _byte
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)

_FILTER_BITS = 21


def _grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q-gram at each place as a 64-bit number: itself up to eight bytes, else a hash."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    result = None
    for at in sorted({*range(0, q - 7, 8), q - 8}):
        eight = np.lib.stride_tricks.sliding_window_view(data, 8)[at : at + n]
        part = np.ascontiguousarray(eight).view("<u8")[:, 0]
        result = part.copy() if result is None else mix(result) + part
    return result


def plain(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, where each text begins among them, and the place in ``texts.data`` of each byte."""
    data = _PLAIN[texts.data]
    keep = data != 0x20
    after = np.zeros(len(data), bool)
    after[1:] = keep[:-1]
    after[texts.offsets[:-1][texts.sizes() > 0]] = False
    at = np.flatnonzero(keep | after)
    return data[at], np.searchsorted(at, texts.offsets), at


@dataclass
class Pieces:
    """A block of pieces with the index of their q-grams; ``short`` are items that are searched for as they are."""

    texts: list[bytes]
    edits: np.ndarray
    least: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    piece: np.ndarray
    place: np.ndarray
    maybe: np.ndarray
    short: re.Pattern | None
    number: dict[bytes, int]


def index(texts: list[bytes], q: int, share: float) -> Pieces:
    """The index of different pieces; those of less than 2 * q bytes are short."""
    long = [n for n, t in enumerate(texts) if len(t) >= 2 * q]
    sizes = np.array([len(t) for t in texts], np.int64)
    edits = np.minimum((share * sizes).astype(np.int64), np.maximum(sizes - q, 0) // q)
    grams = [_grams(np.frombuffer(texts[n], np.uint8), q) for n in long]
    flat = np.concatenate([np.zeros(0, np.uint64), *grams])
    piece = np.repeat(np.array(long, np.int64), [len(g) for g in grams])
    place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])
    order = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[order], return_index=True)
    maybe = np.zeros(1 << _FILTER_BITS, bool)
    maybe[_slot(unique)] = True
    short = sorted((t for t in texts if len(t) < 2 * q), key=len, reverse=True)
    # An item that is a part of another one is found there too, so what follows is only looked at.
    pattern = re.compile(b"(?<![^ ])(?=(" + b"|".join(map(re.escape, short)) + b")(?![^ ]))") if short else None
    return Pieces(texts, edits, sizes - q + 1 - q * edits, unique, np.append(first, len(flat)), piece[order], place[order], maybe, pattern, {t: n for n, t in enumerate(texts)})


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)


def item_pieces(benchmark: DataFrame, q: int) -> DataFrame:
    """(item_id, item, start, size, piece): all pieces of each item; ``item`` tells rows apart that repeat an id."""
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            data, begin, _ = plain(texts)
            rows, starts, sizes, pieces = [], [], [], []
            for row, (at, end) in enumerate(zip(begin.tolist(), begin[1:].tolist())):
                item = data[at:end].tobytes().strip()
                # The last piece ends with the item.
                last = max(len(item) - PIECE, 0)
                for start in sorted({*range(0, last, STEP), last}) if item else ():
                    rows.append(row)
                    starts.append(start)
                    sizes.append(len(item))
                    pieces.append(item[start : start + PIECE])
            of = pa.array(rows, pa.int64())
            columns = [texts.rows.column("item_id").take(of), texts.rows.column("item").take(of), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(pieces, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "item", "start", "size", "piece"])

    items = benchmark.select("item_id", "text", F.xxhash64("text").alias("item"))
    return items.mapInArrow(cut, f"item_id {kind}, item long, start int, size int, piece binary")


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    new = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return keys[new], np.diff(new, append=len(keys))


def candidates(data: np.ndarray, begin: np.ndarray, known: Pieces, q: int) -> list[tuple[int, int, int]]:
    """(text, piece, first diagonal) of bands whose shared q-grams reach the piece's bound."""
    if not len(known.grams):
        return []
    grams = _grams(data, q)
    hit = np.flatnonzero(known.maybe[_slot(grams)])
    number = np.minimum(np.searchsorted(known.grams, grams[hit]), len(known.grams) - 1)
    real = known.grams[number] == grams[hit]
    hit, number = hit[real], number[real]
    text = np.searchsorted(begin, hit, "right") - 1
    inside = hit + q <= begin[text + 1]
    hit, number, text = hit[inside], number[inside], text[inside]
    # Places that are not among enough q-grams of any piece can be in no match.
    long = known.least[known.piece]
    least, reach = int(long.min()), max(len(t) for t in known.texts) - q + int(known.edits.max())
    dense = np.zeros(len(hit), bool)
    if len(hit) >= least:
        # Runs of `least` hits that are close enough together.
        close = np.flatnonzero(hit[least - 1 :] - hit[: len(hit) - least + 1] <= reach)
        step = np.zeros(len(hit) + 1, np.int64)
        np.add.at(step, close, 1)
        np.add.at(step, close + least, -1)
        dense = np.cumsum(step[:-1]) > 0
    hit, number, text = hit[dense], number[dense], text[dense]
    many = known.first[number + 1] - known.first[number]
    total = np.concatenate([[0], np.cumsum(many)])
    posting = np.arange(total[-1]) + np.repeat(known.first[number] - total[:-1], many)
    piece = known.piece[posting]
    diagonal = np.repeat(hit, many) - known.place[posting]
    text = np.repeat(text, many)
    width = known.edits[piece] + 1
    # A diagonal lies in two overlapping bands of twice the width.
    shift = int(known.edits.max()) + max(len(t) for t in known.texts) + 1
    band = (diagonal + shift) // width
    n_bands, n_pieces = len(data) + 2 * shift, len(known.texts)
    found = []
    for step in (0, 1):
        # Below 2^63: texts of a slice, pieces of a block and places of a slice are bounded.
        keys, count = _unique((text * n_pieces + piece) * n_bands + band - step + 1)
        in_piece = keys // n_bands % n_pieces
        good = count >= known.least[in_piece]
        keys, in_piece = keys[good], in_piece[good]
        found.append(np.stack([keys // n_bands // n_pieces, in_piece, (keys % n_bands - 1) * (known.edits[in_piece] + 1) - shift], 1))
    return [tuple(row) for row in np.unique(np.concatenate(found), axis=0).tolist()]


def align(piece: bytes, text: bytes, low: int, high: int, edits: int) -> tuple[int, int] | None:
    """Fewest edits between the piece and any part of ``text`` on diagonals from ``low`` to ``high``, and where that ends.

    Only cells on these diagonals are computed, one row for each byte of the piece; None beyond ``edits``.
    """
    exact = text.find(piece, max(low, 0), max(high, 0) + len(piece))
    if exact >= 0:
        return 0, exact + len(piece)
    width = high - low + 1
    far = edits + 1
    # Cell k of row i is column i + low + k; what lies outside the text is out of reach.
    padded = np.zeros(len(piece) + width + 1, np.int16) - 1
    columns = np.arange(len(padded)) + low
    there = (columns >= 0) & (columns < len(text))
    padded[there] = np.frombuffer(text, np.uint8)[columns[there]]
    place = np.arange(width)
    row = np.where((place + low >= 0) & (place + low <= len(text)), 0, far)
    for i, letter in enumerate(piece):
        # A byte of the piece for one of the text, or for none; then bytes of the text for none.
        best = row + (padded[i : i + width] != letter)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        row = np.minimum.accumulate(best - place) + place
        column = i + 1 + low + place
        row[(column < 0) | (column > len(text))] = far
        if row.min() > edits:
            return None
    at = int(row.argmin())
    return int(row[at]), len(piece) + low + at


#: Of the block that this worker searched for last.
_indexes: dict[str, Pieces] = {}


def _found(texts: Texts, known: Pieces, q: int) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(edits, first, end) of the best place of each (text, piece), in bytes of the text."""
    data, begin, at = plain(texts)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}

    def note(text: int, piece: int, edits: int, start: int, end: int) -> None:
        offset = texts.offsets[text]
        value = (edits, int(at[start] - offset), int(at[end - 1] + 1 - offset))
        best[text, piece] = min(best.get((text, piece), value), value)

    for text, piece, diagonal in candidates(data, begin, known, q):
        if best.get((text, piece), (1,))[0] == 0:
            continue
        edits, size = int(known.edits[piece]), len(known.texts[piece])
        first, last = int(begin[text]), int(begin[text + 1])
        low = max(first, diagonal - edits)
        high = min(last, diagonal + 2 * (edits + 1) + size + edits)
        aligned = align(known.texts[piece], data[low:high].tobytes(), diagonal - edits - low, diagonal + 2 * (edits + 1) + edits - low, edits)
        if aligned and aligned[1]:
            note(text, piece, aligned[0], max(low, low + aligned[1] - size), low + aligned[1])
    if known.short:
        for text in range(len(texts)):
            first = int(begin[text])
            for hit in known.short.finditer(data[first : int(begin[text + 1])].tobytes()):
                note(text, known.number[hit[1]], 0, first + hit.start(1), first + hit.end(1))
    return best


def _search(documents: DataFrame, pieces: list[bytes], q: int, share: float) -> DataFrame:
    """(doc_id, version, piece, edits, first_byte, end_byte): the best place of each piece in each document."""
    shared, block = documents.sparkSession.sparkContext.broadcast(pieces), uuid.uuid4().hex
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Built once per worker and block.
        if block not in _indexes:
            _indexes.clear()
            _indexes[block] = index(shared.value, q, share)
        known = _indexes[block]
        for texts in slices(batches):
            best = _found(texts, known, q)
            order = sorted(best)
            rows = pa.array([t for t, _ in order], pa.int64())
            values = [pa.array([best[k][n] for k in order], kind) for n, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column("doc_id").take(rows), texts.rows.column("version").take(rows), pa.array([known.texts[p] for _, p in order], pa.binary()), *values],
                names=["doc_id", "version", "piece", "edits", "first_byte", "end_byte"],
            )

    rows = documents.select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, version long, piece binary, edits int, first_byte long, end_byte long")


def matches(documents: DataFrame, benchmark: DataFrame, q: int = Q, share: float = EDITS, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, covered, edits, first_byte, end_byte) of each item found in a document.

    ``covered`` is the share of the item that the pieces found cover; the rest is the best place of its best piece.
    """
    cut = stored(item_pieces(benchmark, q), "item-pieces")
    distinct = cut.select("piece").distinct()
    size = distinct.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("piece"), F.lit(max(n_blocks, 1)))
    found = []
    for n in range(n_blocks):
        # One block at a time passes the driver, as plain bytes.
        pieces = sorted(bytes(r.piece) for r in distinct.where(block == n).collect())
        found.append(stored(_search(documents, pieces, q, share), "piece-matches"))
    if not found:
        found = [_search(documents, [], q, share)]
    placed = reduce(DataFrame.unionByName, found).join(cut, "piece")
    place = F.struct("edits", "first_byte", "end_byte")
    items = placed.groupBy("doc_id", "version", "item_id", "item", "size").agg(F.min(place).alias("best"), F.array_sort(F.collect_set("start")).alias("starts"))
    # Each piece found covers up to the next one, the last one to its own end.
    ends = F.zip_with("starts", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.lit(None).cast("int"))), lambda a, b: F.least(F.lit(PIECE), F.coalesce(b - a, F.lit(PIECE))))
    covered = F.least(F.aggregate(ends, F.lit(0), lambda a, b: a + b) / F.col("size"), F.lit(1.0))
    return items.withColumn("covered", covered).where(F.col("covered") >= least).select("doc_id", "item_id", "covered", "best.*")
