"""Removal of bytes that stand in a string of ``length`` bytes which also starts earlier.

Every string of ``length`` bytes is assigned to its sample: the least of its ``gram``-byte hashes, so equal strings have
equal samples at the same place. Consecutive strings with one sample form a stretch. Only stretches whose sample hash
occurs twice can match; of equal stretches all but the earliest are removed whole. What is left, the earliest of each
kind of stretch whose sample also stands in other stretches, is compared byte by byte: the stretches are dealt by sample
hash into shards of bounded size, each shard builds a suffix array (Larsson-Sadakane) and its common prefixes (Kasai),
and suffixes that share ``length`` bytes form a class, of which the earliest stays. A class that may go on in the next
shard is found there by binary search among the sorted strings carried over. A sample with very many stretches is dealt
over several tasks, whose classes meet once more in a grouping by string.

Documents are ordered by id, a null id first, and those that repeat an id by a hash of their text; rows equal in full are
one document and get the same result. A null text is empty; an empty table gives an empty result; extra columns are
dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.occurrences import DOCUMENT, release, repeated_keys, same_document, versioned, with_lists
from tradeloom.llm.suffix_arrays import common_prefixes, suffix_array
from tradeloom.llm.texts import Texts, mix, rolling_hashes, slices, span_hashes, to_long
from tradeloom.sources.shared import discard, stored

LENGTH = 100
GRAM = 32
#: Bytes of a shard's suffix array, and stretches of one sample that one task compares.
SHARD_BYTES = 1 << 20
STRETCHES = 4096

PLACE = [*DOCUMENT, "start"]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """(sample, content, doc_id, version, start, strings): ``content`` hashes the stretch and where its sample stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            n = len(texts.data) - length + 1
            if n <= 0:
                continue
            hashes = rolling_hashes(texts.data, gram)
            ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
            sample = (_least(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            text = np.repeat(np.arange(len(texts)), texts.sizes())[:n]
            whole = np.arange(n) + length <= texts.offsets[text + 1]
            new = np.ones(n, bool)
            new[1:] = (sample[1:] != sample[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
            first = np.flatnonzero(new & whole)
            stops = np.flatnonzero(np.append(new | ~whole, True))
            last = stops[np.searchsorted(stops, first, "right")]
            content = mix(span_hashes(texts.data, first, last + length - 1) + (sample[first] - first).astype(np.uint64))
            rows = pa.array(text[first])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(to_long(hashes[sample[first]])), pa.array(to_long(content)),
                    *(texts.rows.column(c).take(rows) for c in DOCUMENT),
                    pa.array((first - texts.offsets[text[first]]).astype(np.int32)), pa.array((last - first).astype(np.int32)),
                ],
                names=["sample", "content", *PLACE, "strings"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(run, f"sample long, content long, doc_id {kind}, version int, start int, strings int")


def _with_bytes(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` stretches (sample, parts, part, place, strings) with their ``bytes``."""
    chosen = F.struct("sample", "parts", "part", "start", "strings")
    lists = wanted.groupBy(*DOCUMENT).agg(F.collect_set(chosen).alias("wanted"))
    texts = documents.join(lists, same_document(documents, lists)).select(documents["doc_id"], documents["version"], "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slice_ in slices(batches):
            lists = slice_.rows.column("wanted")
            owner = np.repeat(np.arange(len(slice_)), lists.value_lengths().to_numpy(zero_copy_only=False))
            flat = lists.flatten()
            start = flat.field("start").to_numpy(zero_copy_only=False) + slice_.offsets[owner]
            end = start + flat.field("strings").to_numpy(zero_copy_only=False) + length - 1
            data = slice_.data.tobytes()
            rows = pa.array(owner)
            cut = pa.array([data[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(c) for c in ("sample", "parts", "part")), *(slice_.rows.column(c).take(rows) for c in DOCUMENT), flat.field("start"), cut],
                names=["sample", "parts", "part", *PLACE, "bytes"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"sample long, parts int, part int, doc_id {kind}, version int, start int, bytes binary")


_COMPARED = "doc_id {0}, version int, start int, strings int, sample long, slot int, part int, high array<long>, low array<long>, docs array<{0}>, versions array<int>, starts array<int>"


def _ordinals(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Sort keys of places, the least significant first; a null id comes before all others."""
    ids = table.column("doc_id")
    return (
        table.column("start").to_numpy(), table.column("version").to_numpy(),
        pc.fill_null(ids, 0).to_numpy(), pc.is_valid(ids).to_numpy(),
    )


def _distinct(table: pa.Table) -> pa.Table:
    """Each place once: documents that repeat in full bring theirs as often."""
    keys = np.stack(_ordinals(table))
    order = np.lexsort(keys)
    new = np.ones(table.num_rows, bool)
    new[order[1:]] = (keys[:, order[1:]] != keys[:, order[:-1]]).any(0)
    return table if new.all() else table.filter(pa.array(new)).combine_chunks()


def _classes(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and offsets of all strings of a shard, by class and then by place, and which are the first of their class."""
    column = table.column("bytes").combine_chunks()
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    order, shared = suffix_array(data, length)
    shared = common_prefixes(data, order, shared, length, length)
    row_of = np.repeat(np.arange(len(ends)), np.diff(np.append(0, ends)))
    begin = np.append(0, ends)[row_of]
    # Suffixes that leave their stretch are no strings; the classes of the others are the same without them.
    whole = np.arange(len(data)) + length <= ends[row_of]
    keep = whole[order]
    at, number = order[keep], np.cumsum(shared < length)[keep]
    rank = np.empty(len(ends), np.int64)
    rank[np.lexsort(_ordinals(table))] = np.arange(len(ends))
    row, offset = row_of[at], at - begin[at]
    by = np.lexsort((offset, rank[row], number))
    row, offset, number = row[by], offset[by], number[by]
    first = np.ones(len(row), bool)
    first[1:] = number[1:] != number[:-1]
    return row, offset, first, data[(begin[at[by]] + offset)[:, None] + np.arange(length)] if (table.column("parts").to_numpy() > 1).any() else None


def _compare(cut: DataFrame, length: int) -> DataFrame:
    """Removed strings; and of samples in several parts the earliest strings of each part, sorted and cut into slots."""
    kind = cut.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            # Batches are cut so that a shard is bounded even if a batch is not.
            for low in range(0, batch.num_rows, 2048):
                piece = batch.slice(low, 2048)
                held.append(piece)
                size += piece.column("bytes").nbytes
                if size > SHARD_BYTES:
                    table = pa.Table.from_batches(held)
                    sample, part = table.column("sample").to_numpy(), table.column("part").to_numpy()
                    same = np.flatnonzero((sample != sample[-1]) | (part != part[-1]))
                    cut_at = same[-1] + 1 if len(same) else 0
                    if cut_at:
                        yield from shard(table.slice(0, cut_at))
                    # The last sample may go on in the next batch; one part of it has a bounded number of stretches.
                    held = table.slice(cut_at).combine_chunks().to_batches()
                    size = sum(b.column("bytes").nbytes for b in held)
        if held and sum(b.num_rows for b in held):
            yield from shard(pa.Table.from_batches(held))

    def shard(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = _distinct(table.combine_chunks())
        row, offset, first, strings = _classes(table, length)
        yield from removed(table, row[~first], offset[~first])
        if strings is None:
            return
        parts = table.column("parts").to_numpy()
        chosen = np.flatnonzero(first & (parts[row] > 1))
        sample = table.column("sample").to_numpy()
        for number in np.unique(sample[row[chosen]]):
            mine = chosen[sample[row[chosen]] == number]
            digests = np.frombuffer(b"".join(hashlib.blake2b(strings[i].tobytes(), digest_size=16).digest() for i in mine), np.uint64).reshape(-1, 2)
            mine, digests = mine[np.argsort(digests[:, 0])], digests[np.argsort(digests[:, 0])]
            slots = int(parts[row[mine[0]]])
            edges = np.searchsorted(digests[:, 0], np.array([(i << 64) // slots for i in range(1, slots)], np.uint64))
            for slot, inside in enumerate(np.split(np.arange(len(mine)), edges)):
                if len(inside):
                    rows = pa.array(row[mine[inside]])
                    starts = table.column("start").to_numpy()[row[mine[inside]]] + offset[mine[inside]]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.nulls(1, table.schema.field("doc_id").type), "version": pa.nulls(1, pa.int32()), "start": pa.nulls(1, pa.int32()), "strings": pa.nulls(1, pa.int32()),
                            "sample": [int(number)], "slot": pa.array([slot], pa.int32()), "part": table.column("part").combine_chunks().slice(int(row[mine[0]]), 1),
                            "high": [digests[inside, 0].view(np.int64)], "low": [np.ascontiguousarray(digests[inside, 1]).view(np.int64)],
                            "docs": pa.ListArray.from_arrays(pa.array([0, len(inside)], pa.int32()), table.column("doc_id").combine_chunks().take(rows)),
                            "versions": pa.ListArray.from_arrays(pa.array([0, len(inside)], pa.int32()), table.column("version").combine_chunks().take(rows)),
                            "starts": pa.array([starts.astype(np.int32)], pa.list_(pa.int32())),
                        }
                    )

    def removed(table: pa.Table, row: np.ndarray, offset: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Neighbouring strings of a stretch as one row."""
        by = np.lexsort((offset, row))
        row, offset = row[by], offset[by]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)
        first = np.flatnonzero(new)
        strings = np.diff(np.append(first, len(row)))
        rows = pa.array(row[first])
        starts = table.column("start").to_numpy()[row[first]] + offset[first]
        n = len(first)
        lists = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(table.schema.field("doc_id").type), pa.list_(pa.int32()), pa.list_(pa.int32()))]
        names = ["doc_id", "version", "start", "strings", "sample", "slot", "part", "high", "low", "docs", "versions", "starts"]
        yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks().take(rows) for c in DOCUMENT), pa.array(starts.astype(np.int32)), pa.array(strings.astype(np.int32)), *lists], names=names)

    return cut.repartition("sample", "part").sortWithinPartitions("sample", "part").mapInArrow(run, _COMPARED.format(kind))


def _merge(pieces: DataFrame) -> DataFrame:
    """Strings of samples in several parts that stand earlier in another part."""
    kind = pieces.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, high, low, places = None, np.zeros(0, np.uint64), np.zeros(0, np.uint64), []
        for batch in batches:
            out = []
            for piece in batch.to_pylist():
                more_high = np.array(piece["high"], np.int64).view(np.uint64)
                more_low = np.array(piece["low"], np.int64).view(np.uint64)
                more = list(zip(piece["docs"], piece["versions"], piece["starts"], strict=True))
                if key != (piece["sample"], piece["slot"]):
                    key, high, low, places = (piece["sample"], piece["slot"]), more_high, more_low, more
                    continue
                at = np.searchsorted(high, more_high)
                near = np.minimum(at, len(high) - 1)
                known = (high[near] == more_high) & (low[near] == more_low)
                for mine, theirs in zip(np.flatnonzero(known).tolist(), near[known].tolist(), strict=True):
                    early, late = sorted([places[theirs], more[mine]], key=lambda p: (p[0] is not None, p[0] or 0, p[1], p[2]))
                    places[theirs] = early
                    out.append(late)
                fresh = np.flatnonzero(~known)
                held = np.empty(len(places), object)
                held[:] = places
                added = np.empty(len(fresh), object)
                added[:] = [more[i] for i in fresh.tolist()]
                high, low = np.insert(high, at[fresh], more_high[fresh]), np.insert(low, at[fresh], more_low[fresh])
                places = np.insert(held, at[fresh], added).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in out], batch.schema.field("docs").type.value_type), pa.array([p[1] for p in out], pa.int32()), pa.array([p[2] for p in out], pa.int32()), pa.array([1] * len(out), pa.int32())],
                names=[*PLACE, "strings"],
            )

    slots = pieces.select("sample", "slot", "part", "high", "low", "docs", "versions", "starts")
    return slots.repartition("sample", "slot").sortWithinPartitions("sample", "slot", "part").mapInArrow(run, f"doc_id {kind}, version int, start int, strings int")


def repeated_strings(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, version, start, strings): ``strings`` consecutive strings from ``start`` that also start earlier."""
    spark = documents.sparkSession
    found = stretches(documents, length, gram)
    twice = repeated_keys(found, "sample")
    shared = stored(found.join(twice, "sample", "left_semi"), "stretches")
    discard(twice)
    release(spark)
    place = F.struct(*PLACE)
    kinds = stored(shared.groupBy("sample", "content").agg(F.min(place).alias("first"), F.max("strings").alias("strings")), "kinds")
    later = shared.join(kinds.select("sample", "content", "first"), ["sample", "content"]).where(~place.eqNullSafe(F.col("first"))).select(*PLACE, "strings")
    parts = stored(kinds.groupBy("sample").agg(F.count("*").alias("n")).where("n > 1").select("sample", F.ceil(F.col("n") / STRETCHES).cast("int").alias("parts")), "parts")
    mixed = kinds.join(parts, "sample").select("sample", "parts", F.pmod(F.xxhash64("content"), F.col("parts")).cast("int").alias("part"), "first.*", "strings")
    compared = stored(_compare(_with_bytes(documents, mixed, length), length), "compared")
    discard(parts)
    release(spark)
    merged = _merge(compared.where("slot is not null"))
    return later.unionByName(compared.where("slot is null").select(*PLACE, "strings")).unionByName(merged)


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): ``kept`` has the bytes that stay."""
    texts = versioned(documents)
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("strings") + F.lit(length - 1)).alias("end"))
    marked = with_lists(texts, repeated_strings(texts, length, gram), span, "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slice_ in slices(batches):
            removed, n_spans = _covered(slice_)
            upto = np.concatenate([[0], np.cumsum(removed)])[slice_.offsets]
            kept = slice_.data[~removed].tobytes()
            ends = (slice_.offsets - upto).tolist()
            yield pa.RecordBatch.from_arrays(
                [slice_.rows.column("doc_id"), pa.array(slice_.sizes()), pa.array(np.diff(upto)), pa.array(n_spans), pa.array([kept[i:j] for i, j in zip(ends, ends[1:])], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def _covered(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are in a span, and how many maximal runs of them each text has."""
    lists = texts.rows.column("spans")
    owner = np.repeat(np.arange(len(texts)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    step = np.zeros(len(texts.data) + 1, np.int64)
    np.add.at(step, flat.field("start").to_numpy(zero_copy_only=False) + texts.offsets[owner], 1)
    np.add.at(step, flat.field("end").to_numpy(zero_copy_only=False) + texts.offsets[owner], -1)
    removed = np.cumsum(step[:-1]) > 0
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[texts.offsets] = True
    begins = removed & (np.concatenate([[True], ~removed[:-1]]) | edge[:-1]) if len(removed) else removed
    return removed, np.diff(np.searchsorted(np.flatnonzero(begins), texts.offsets))
