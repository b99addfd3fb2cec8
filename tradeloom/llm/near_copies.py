"""Near copies by SimHash: candidates by fingerprints of shingle sets, each link verified exactly.

A text's shingles are its runs of ``shingle`` words, lower-cased (ASCII) and each counted once; a shorter text is one
shingle. Texts with equal sets are one node. Its SimHash has BANDS * ROWS bits, each the majority of one bit of the set's
hashes. Two sets differ in each bit with a probability of their angle / pi, whatever their size: 0.15 at a similarity of
0.8. Each ROWS bits are a table's key, and nodes that share one are compared bit plane by bit plane (``simhash``) over the
first COMPARED bits. Those within RADIUS are candidates; two sets of similarity 0.8 miss each other with a probability of
about (1 - 0.85 ** ROWS) ** BANDS = 0.001 by the keys and 0.0001 by the radius. The nodes that candidates or equal bits
connect are a candidate group; a spanning forest is stored for it, never its pairs.

Links of a group are then found among the sets themselves. The texts of a group come together in one task, and two nodes
are linked only if their sets reach the threshold. Pairs that verified links connect already are not compared again, so a
task returns a forest of verified links. A group beyond the limits of a task is cut by its keys or dealt by hash into
chunks, of which each two meet in a task, whichever moves less; either way all its pairs that share a key are compared.
Pairs of a group that share no key are compared too unless it is cut.

Texts without a shingle are one node without links. Null texts are taken for empty ones; rows may repeat, and need no id.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm import simhash
from tradeloom.llm.components import components
from tradeloom.llm.texts import Texts, mix, slices, span_hashes, words
from tradeloom.sources.shared import discard, stored

#: Keys of a set, and bits in a key.
BANDS, ROWS = 64, 14
#: Bits that are compared, and how many of them may differ between candidates.
COMPARED, RADIUS = 128, 34
#: Sets whose bits are counted together.
TOGETHER = 1024
#: Nodes and shingles of one chunk of a group.
CHUNK, CHUNK_SHINGLES = 1024, 4_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LANES = np.uint64(0x0101010101010101)
_WEIGHTS = 1 << np.arange(ROWS)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] ... starts[0] + lengths[0] - 1, starts[1] ..."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)


def shingle_sets(texts: Texts, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and the range of each text."""
    data = _LOWER[texts.data]
    found = words(Texts(texts.rows, data, texts.offsets))
    lengths = found.ends - found.starts
    # All words with one space after each.
    target = np.concatenate([[0], np.cumsum(lengths + 1)])
    spaced = np.full(target[-1], 0x20, np.uint8)
    spaced[np.arange(lengths.sum()) + np.repeat(np.arange(len(lengths)), lengths)] = data[_ranges(found.starts, lengths)]
    counts = found.counts()
    many = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = _ranges(found.offsets[:-1], many)
    last = first + np.repeat(np.minimum(counts, shingle), many) - 1
    hashes = span_hashes(spaced, target[first], target[last + 1] - 1)
    of = np.repeat(np.arange(len(texts)), many)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def set_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, BANDS * ROWS) bits of 0 and 1, each the majority of a bit of the set's remixed hashes; no set may be empty.

    Bits are counted eight to a word, in runs of at most 255 hashes, so that no count reaches the next one.
    """
    sizes = np.diff(offsets)
    runs = -(-sizes // 255)
    first = np.cumsum(runs) - runs
    starts = np.repeat(offsets[:-1] - offsets[0], runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    inside = hashes[offsets[0] : offsets[-1]]
    bits = np.empty((len(sizes), -(-BANDS * ROWS // 64), 8, 8), np.uint8)
    for part in range(bits.shape[1]):
        values = mix(inside + np.uint64(part))
        for lane in range(8):
            ones = np.add.reduceat(values >> np.uint64(lane) & _LANES, starts).astype("<u8")
            counts = np.add.reduceat(ones.view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
            bits[:, part, lane] = 2 * counts > sizes[:, None]
    return bits.reshape(len(sizes), -1)[:, : BANDS * ROWS]


def _marked(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sets, BANDS) keys and (sets, COMPARED / 8) bytes of the bits that are compared."""
    keys = np.empty((len(offsets) - 1, BANDS), np.int16)
    compared = np.empty((len(keys), COMPARED // 8), np.uint8)
    for low in range(0, len(keys), TOGETHER):
        bits = set_bits(hashes, offsets[low : low + TOGETHER + 1])
        keys[low : low + TOGETHER] = bits.reshape(-1, BANDS, ROWS) @ _WEIGHTS
        compared[low : low + TOGETHER] = np.packbits(bits[:, :COMPARED], axis=1)
    return keys, compared


def band_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys; no set may be empty."""
    return _marked(hashes, offsets)[0]


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def marks(documents: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, mark, node, n, keys, fingerprint): a row's set by its hash, the size of the set, its keys and compared bits.

    Needs doc_id, mark, text. An empty set has no keys, and an empty fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in slices(batches):
            hashes, offsets = shingle_sets(texts, shingle)
            n = np.diff(offsets)
            raw = memoryview(hashes.astype("<u8").tobytes())
            nodes = [xxhash.xxh3_128_digest(raw[8 * i : 8 * j]) for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            some = np.flatnonzero(n)
            keys, compared = _marked(hashes, np.append(offsets[some], offsets[-1]))
            ends = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
            fingerprints = [b""] * len(n)
            for row, value in zip(some.tolist(), compared, strict=True):
                fingerprints[row] = value.tobytes()
            columns = [texts.rows.column("doc_id"), texts.rows.column("mark"), _binary(nodes), pa.array(n.astype(np.int64)), lists, _binary(fingerprints)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "node", "n", "keys", "fingerprint"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, mark string, node binary, n long, keys array<smallint>, fingerprint binary"
    return documents.select("doc_id", "mark", "text").mapInArrow(run, result)


def verified(hashes: np.ndarray, offsets: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Pairs (row, row) of sets that reach the threshold: a forest that spans all such pairs."""
    sizes = np.diff(offsets)
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    # Values as numbers, sets one after another from the smallest to the largest.
    values, flat = np.unique(hashes[_ranges(offsets[order], sizes)], return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    label = np.arange(len(sizes))
    mine = np.zeros(len(values), bool)
    up, down = threshold.numerator, threshold.denominator
    found = []
    for row in range(len(sizes) - 1):
        # Larger sets only while the smaller one can be a large enough part of them.
        upto = int(np.searchsorted(sizes, sizes[row] * down // up, "right"))
        others = row + 1 + np.flatnonzero(label[row + 1 : upto] != label[row])
        if not len(others):
            continue
        mine[flat[ends[row] : ends[row + 1]]] = True
        starts = np.concatenate([[0], np.cumsum(sizes[others])])
        shared = np.add.reduceat(mine[flat[_ranges(ends[others], sizes[others])]], starts[:-1], dtype=np.int64)
        mine[flat[ends[row] : ends[row + 1]]] = False
        # shared / (both - shared) >= up / down
        close = others[(up + down) * shared >= up * (sizes[row] + sizes[others])]
        for other in close.tolist():
            if label[other] != label[row]:
                found.append((order[row], order[other]))
                label[label == label[other]] = label[row]
    return np.array(found, np.int64).reshape(-1, 2)


def _groups(nodes: DataFrame) -> DataFrame:
    """(node, mark, group, low, high): nodes that have to be compared in one task."""
    some = nodes.where("n > 0")
    number_and_key = F.posexplode("keys").alias("number", "key")
    placed = some.select(number_and_key, "fingerprint").select(F.col("number").cast("short"), F.col("key").cast("long"), "fingerprint")
    reached = stored(components(simhash.links_within(placed, RADIUS)).withColumnRenamed("node", "fingerprint"), "candidates")
    # Sets of one fingerprint are candidates of each other.
    component = F.coalesce("component", "fingerprint").alias("component")
    members = stored(some.join(reached, "fingerprint", "left").select("node", component, "least.mark", "n"), "members")

    def chunks(many: str, total: str):
        return F.ceil(F.greatest(F.col(many) / CHUNK, F.col(total) / CHUNK_SHINGLES)).cast("int")

    sizes = members.groupBy("component").agg(F.count("*").alias("many"), F.sum("n").alias("total")).where("many > 1")
    sized = stored(sizes.withColumn("chunks", chunks("many", "total")), "group-sizes")
    columns = ["node", "mark", "group", "chunks"]
    small = members.join(sized.where("chunks = 1"), "component").withColumn("group", F.xxhash64("component")).select(columns)
    if sized.where("chunks > 1").isEmpty():
        wanted = small
    else:
        large = stored(members.join(sized.where("chunks > 1"), "component"), "large-groups")
        keyed = stored(large.join(some.select("node", number_and_key), "node"), "keyed")
        shared = keyed.groupBy("component", "number", "key").agg(F.count("*").alias("many_here"), F.sum("n").alias("total_here")).where("many_here > 1")
        dealt = stored(shared.withColumn("dealt", chunks("many_here", "total_here")), "shared-keys")
        # What is moved either way, in shingles.
        cost = dealt.groupBy("component").agg(F.sum(F.col("total_here") * F.col("dealt")).alias("keyed"))
        way = stored(
            sized.where("chunks > 1").join(cost, "component").select("component", (F.col("keyed") < F.col("total") * F.col("chunks")).alias("cut")), "ways"
        )
        by_key = keyed.join(way.where("cut"), "component").join(dealt.select("component", "number", "key", "dealt"), ["component", "number", "key"])
        cut = by_key.select("node", "mark", F.xxhash64("component", "number", "key").alias("group"), F.col("dealt").alias("chunks"))
        whole = large.join(way.where("not cut"), "component").withColumn("group", F.xxhash64("component")).select(columns)
        wanted = small.unionByName(cut).unionByName(whole)
    dealt = wanted.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    # A node meets each chunk of its group, its own included, in the task of both numbers.
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.select("node", "mark", "group", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))


def links(nodes: DataFrame, documents: DataFrame, threshold: Fraction, shingle: int) -> DataFrame:
    """(a, b) that connect exactly the nodes that links of the threshold or more connect."""
    key = ["group", "low", "high"]
    # Grouped rows first: their stored size decides between a broadcast and a sort-merge join.
    grouped = stored(_groups(nodes), "groups")
    with_text = grouped.join(documents.select("mark", "text"), "mark").select(*key, "node", "text")

    def sets(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Verified links of one group."""
        names, parts, sizes, seen = [], [], [], set()
        for texts in slices(iter(rows)):
            hashes, offsets = shingle_sets(texts, shingle)
            parts.append(hashes)
            sizes.append(np.diff(offsets))
            names += texts.rows.column("node").to_pylist()
        hashes, size = np.concatenate(parts), np.concatenate(sizes)
        # Repeated rows have the same set.
        single = np.array([not (name in seen or seen.add(name)) for name in names], bool)
        starts = (np.cumsum(size) - size)[single]
        hashes, size = hashes[_ranges(starts, size[single])], size[single]
        kept = [name for name, first in zip(names, single, strict=True) if first]
        found = verified(hashes, np.concatenate([[0], np.cumsum(size)]), threshold)
        if len(found):
            yield pa.RecordBatch.from_arrays([_binary([kept[i] for i in found[:, 0]]), _binary([kept[i] for i in found[:, 1]])], names=["a", "b"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(name).to_numpy() for name in key], 1)
            starts = np.concatenate([[0], 1 + np.flatnonzero((places[1:] != places[:-1]).any(1)), [len(places)]]).tolist()
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                if rows and tuple(places[start]) != last:
                    yield from sets(rows)
                    rows = []
                last = tuple(places[start])
                rows.append(batch.slice(start, end - start))
        if rows:
            yield from sets(rows)

    # A group stands together in one task, in the order of its key.
    return with_text.repartition(*key).sortWithinPartitions(*key).mapInArrow(search, "a binary, b binary").distinct()


def representatives(documents: DataFrame, threshold: Fraction, shingle: int) -> DataFrame:
    """(doc_id, mark) of the first row of each group of near copies, by doc_id, then mark; rows without an id come last.

    ``documents`` has doc_id, text and mark, which is never null and tells all rows apart.
    """
    marked = marks(documents, shingle)
    place = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "mark")
    nodes = stored(marked.groupBy("node").agg(F.min(place).alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("fingerprint").alias("fingerprint")), "nodes")
    reached = components(links(nodes, documents, threshold, shingle))
    of_node = nodes.join(reached, "node", "left").select("least", F.coalesce("component", "node").alias("component"))
    chosen = stored(of_node.groupBy("component").agg(F.min("least").alias("least")).select("least.doc_id", "least.mark"), "chosen")
    discard(nodes)
    return chosen
