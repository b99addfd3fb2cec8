"""SimHash near-duplicates, compared bit plane by bit plane.

A document's fingerprint has the majority bits of its shingles' hashes. Equal fingerprints are one node. Fingerprints
that share the bits of a table's key meet in a bucket; tables are chosen so that no pair within the radius is missed
(``exact_tables``), or few are (``sampled_tables``). In a bucket the bits are stored vertically, 64 fingerprints to a
machine word, so that one XOR compares a fingerprint with 64 others. Carry-save adders count the differing planes of all
64 at once; a counter that starts at 2^k - 1 - radius overflows exactly when the radius is exceeded, and a word whose 64
counters have all overflowed is dropped before its remaining planes are read. A large bucket is dealt by hash into
chunks, and each pair of chunks is one group. A task returns a spanning forest of the links it found, never all pairs.

A null or empty text has no shingles and fingerprint zero, linked like any other; rows that repeat an id are nodes by
their texts; a null id is ignored where the smallest id of a component is sought; an empty table gives an empty result;
extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.texts import Texts, mix, slices, words
from tradeloom.sources.shared import discard, stored

SEED = 42
#: Fingerprints of a bucket that are compared in one group; a larger bucket is dealt into chunks of about this size.
CHUNK = 1024
#: (fingerprint, word) comparisons that are in memory at once.
COMPARED = 1 << 15
#: Planes between two looks for words that can be dropped.
PLANES = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _fingerprints(texts: Texts, shingle: int, parts: int) -> np.ndarray:
    """(texts, parts) 64-bit words; part 0 has the majority bits of the hashes themselves, the others of remixed ones."""
    n = len(texts)
    data = _LOWER[texts.data]
    found = words(Texts(texts.rows, data, texts.offsets))
    lengths = found.ends - found.starts
    # All words with one space after each.
    target = np.concatenate([[0], np.cumsum(lengths + 1)])
    spaced = np.full(target[-1], 0x20, np.uint8)
    spaced[np.arange(lengths.sum()) + np.repeat(np.arange(len(lengths)), lengths)] = data[_ranges(found.starts, lengths)]
    counts = found.counts()
    n_shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = _ranges(found.offsets[:-1], n_shingles)
    last = first + np.repeat(np.minimum(counts, shingle), n_shingles) - 1
    view, digest = memoryview(spaced), xxhash.xxh64_intdigest
    begin, end = target[first].tolist(), (target[last + 1] - 1).tolist()
    hashes = np.fromiter((digest(view[i:j], SEED) for i, j in zip(begin, end, strict=True)), np.uint64, len(begin))
    result = np.zeros((n, parts), np.uint64)
    some = np.flatnonzero(n_shingles)
    upto = np.concatenate([[0], np.cumsum(n_shingles)])
    for part in range(parts if len(some) else 0):
        values = hashes if part == 0 else mix(hashes + np.uint64(part))
        for low in range(0, len(some), 512):
            group = some[low : low + 512]
            inside = values[upto[group[0]] : upto[group[-1] + 1]]
            bits = np.unpackbits(inside.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, upto[group] - upto[group[0]], axis=0, dtype=np.int32)
            major = np.packbits(2 * ones > n_shingles[group, None], axis=1, bitorder="little")
            result[group, part] = major.reshape(-1, 8).copy().view("<u8")[:, 0]
    return result


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] ... starts[0] + lengths[0] - 1, starts[1] ..."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)


def fingerprints(documents: DataFrame, shingle: int = 3, parts: int = 1) -> DataFrame:
    """(doc_id, fingerprint): ``8 * parts`` bytes, each part most significant byte first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            packed = _fingerprints(texts, shingle, parts).astype(">u8").tobytes()
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * (8 * parts)
            column = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
            yield pa.RecordBatch.from_arrays([texts.rows.column("doc_id"), column], names=["doc_id", "fingerprint"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint binary")


def exact_tables(bits: int, radius: int, agreeing: int = 2) -> list[list[int]]:
    """Bits cut into radius + agreeing blocks: a pair within the radius agrees on at least ``agreeing`` of them."""
    blocks = np.array_split(np.arange(bits), radius + agreeing)
    return [np.concatenate(chosen).tolist() for chosen in combinations(blocks, agreeing)]


def sampled_tables(bits: int, width: int, tables: int) -> list[list[int]]:
    """``tables`` random choices of ``width`` bits, the same on each call."""
    random = np.random.default_rng(SEED)
    return [sorted(random.choice(bits, width, replace=False).tolist()) for _ in range(tables)]


def _bits(fingerprints: pa.Array) -> np.ndarray:
    """(rows, bits) of 0 and 1."""
    if not len(fingerprints):
        return np.zeros((0, 64), np.uint8)
    return np.unpackbits(np.frombuffer(b"".join(fingerprints.to_pylist()), np.uint8).reshape(len(fingerprints), -1), axis=1)


def _full_adder(a, b, c):
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def compare(bits: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """For each row the smallest row that it is linked with, directly or not, by pairs within the radius in a bucket.

    ``bits``: (rows, bits), rows of a bucket in a row; ``ends``: for each row the end of its bucket.
    """
    n, width = bits.shape
    label = np.arange(n)
    padded = np.zeros((width, -(-n // 64) * 64), np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")
    # Each row meets the words that hold later rows of its bucket.
    rows = np.flatnonzero(ends > np.arange(n) + 1)
    if not len(rows):
        return label
    first, last = (rows + 1) >> 6, (ends[rows] - 1) >> 6
    order = np.repeat(rows, last - first + 1)
    word = _ranges(first, last - first + 1)
    for low in range(0, len(order), COMPARED):
        row, lane = _close(bits, planes, ends, order[low : low + COMPARED], word[low : low + COMPARED], radius)
        _join(label, row, lane)
    return label


def _close(bits, planes, ends, row, word, radius):
    """Pairs (row, later row in the word) of one bucket within the radius."""
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    low, high = np.clip(row + 1 - 64 * word, 0, 64), np.clip(ends[row] - 64 * word, 0, 64)

    def below(k):
        return np.where(k >= 64, every, (np.uint64(1) << np.minimum(k, 63).astype(np.uint64)) - np.uint64(1))

    valid = below(high) & ~below(low)
    levels = max(2, int(radius).bit_length())
    start = 2**levels - 1 - radius
    count = [np.full(len(row), every if start >> k & 1 else 0, np.uint64) for k in range(levels)]
    over = ~valid
    width = bits.shape[1]
    for plane in range(0, width, 4):
        differ = [planes[p, word] ^ np.where(bits[row, p], every, np.uint64(0)) for p in range(plane, plane + 4)]
        count[0], two_a = _full_adder(count[0], differ[0], differ[1])
        count[0], two_b = _full_adder(count[0], differ[2], differ[3])
        count[1], carry = _full_adder(count[1], two_a, two_b)
        for k in range(2, levels):
            count[k], carry = count[k] ^ carry, count[k] & carry
        over |= carry
        if plane % PLANES == PLANES - 4:
            alive = over != every
            if np.count_nonzero(alive) < 0.75 * len(alive):
                row, word, over = row[alive], word[alive], over[alive]
                count = [c[alive] for c in count]
    hit = np.flatnonzero(over != every)
    lanes = np.unpackbits((~over[hit]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, lane = np.nonzero(lanes)
    return row[hit[which]], 64 * word[hit[which]] + lane


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of a[i] and b[i]; a label is the smallest row of its set."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def links(nodes: DataFrame, radius: int, tables: list[list[int]]) -> DataFrame:
    """(a, b) that span all links within the radius among distinct ``fingerprint`` values that meet in a table."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [np.uint64(1) << np.arange(len(t), dtype=np.uint64) for t in tables]
        for batch in batches:
            bits = _bits(batch.column(0))
            for number, (chosen, weight) in enumerate(zip(tables, weights, strict=True)):
                key = (bits[:, chosen] * weight).sum(1, dtype=np.uint64) if len(bits) else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bits), number, np.int16)), pa.array(key.view(np.int64)), batch.column(0)], names=["number", "key", "fingerprint"])

    return links_within(nodes.select("fingerprint").mapInArrow(keys, "number short, key long, fingerprint binary"), radius)


def links_within(placed: DataFrame, radius: int) -> DataFrame:
    """(a, b) that span all links within the radius among ``fingerprint`` values that share number and key of a table."""
    # Buckets beyond a chunk: few, as each has more than CHUNK rows.
    large = stored(placed.groupBy("number", "key").count().where(F.col("count") > CHUNK), "large-buckets")
    chunks = F.coalesce(F.ceil(F.col("count") / CHUNK), F.lit(1))
    dealt = placed.join(large, ["number", "key"], "left").withColumns({"chunks": chunks.cast("int"), "chunk": F.pmod(F.xxhash64("fingerprint"), chunks).cast("int")})
    # A row meets each chunk of its bucket, its own included, in the group of both numbers.
    grouped = dealt.select(
        "number", "key", "fingerprint", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).select("number", "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "fingerprint")
    group = ["number", "key", "low", "high"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            starts = _group_starts(table)
            # The last group may go on in the next batch.
            yield from linked(table.slice(0, starts[-1]), starts[:-1])
            rest = table.slice(starts[-1]).combine_chunks()
        if rest is not None:
            yield from linked(rest, _group_starts(rest))

    def _group_starts(table: pa.Table) -> np.ndarray:
        change = np.zeros(table.num_rows, bool)
        change[0] = True
        for name in group:
            values = table.column(name).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(change)

    def linked(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = np.diff(np.append(starts, table.num_rows))
        several = np.repeat(sizes > 1, sizes)
        if not several.any():
            return
        column = table.column("fingerprint").combine_chunks().filter(pa.array(several))
        column = pa.chunked_array([column]).combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        kept = sizes[sizes > 1]
        label = compare(_bits(column), np.repeat(np.cumsum(kept), kept), radius)
        found = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([column.take(pa.array(found)), column.take(pa.array(label[found]))], names=["a", "b"])

    # A group stands together in one task, in the order of its key.
    return grouped.repartition(*group).sortWithinPartitions(*group).mapInArrow(search, "a binary, b binary").distinct()


def near_duplicates(documents: DataFrame, radius: int = 3, shingle: int = 3, parts: int = 1, tables: list[list[int]] | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id): the component has the smallest id that links within the radius reach."""
    tables = tables or exact_tables(64 * parts, radius)
    marked = stored(fingerprints(documents, shingle, parts), "fingerprints")
    nodes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    reached = components(links(nodes, radius, tables))
    of_node = nodes.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = stored(of_node.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    named = stored(of_node.join(least, "component").select("fingerprint", "component_id"), "components")
    discard(least)
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")
