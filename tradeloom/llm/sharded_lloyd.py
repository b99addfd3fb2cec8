"""Lloyd's clustering of whole-number vectors, with the dimensions dealt over shards.

Vectors are kept as column blocks: a row has ``width`` columns of some thousand vectors (a chunk) as one matrix, and the
table is partitioned by block and bucketed by chunk. A round has three steps. Each column block is compared with its
slice of the centroids alone, which gives exact partial distances. These are added up over the blocks of a chunk, and the
smallest sum names the cluster of each vector. The cluster numbers go back to the blocks, a join that moves numbers only
since the blocks lie in buckets, and each block sums up its own slice of the new centroids. Only centroids (clusters x
dimensions whole numbers, both parameters) pass through the driver.

Vectors of another length or with a null, infinite or NaN component are left out, null vectors too. Components beyond
+-2^27 after scaling count as +-2^27, so that no squared distance leaves 64 bits. Rows that repeat an id or a vector are
vectors of their own; a null id is written as an empty one; equal distances go to the smaller number; fewer vectors than
clusters give that many clusters; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.shared import discard, new_path, stored

#: Columns of one block, and vectors of one chunk.
WIDTH = 32
CHUNK = 2048
#: Scaled components are at most this far from zero.
FARTHEST = 1 << 27


def whole_vectors(embeddings: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component of the vectors that are complete."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.least(F.greatest(x.cast("double") * float(scale), F.lit(float(-FARTHEST))), F.lit(float(FARTHEST)))).cast("int"))
    return embeddings.where((F.size("embedding") == dimensions) & finite).select("vec_id", scaled.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest sha256 of ``<seed>:<vec_id>``; ties go to the smaller vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.vector for r in vectors.orderBy(key, "vector").limit(clusters).collect()], np.int64)


def column_blocks(vectors: DataFrame, dimensions: int, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """(chunk, block, ids, cells): matrices of 32-bit numbers, a table partitioned by block and bucketed by chunk."""
    spark = vectors.sparkSession
    starts = range(0, dimensions, width)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, len(batch), chunk):
                part = batch.slice(at, chunk)
                cells = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(part), dimensions)
                ids = part.column("vec_id")
                whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                nothing = pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), ids[:0])
                for block, start in enumerate(starts):
                    matrix = np.ascontiguousarray(cells[:, start : start + width], np.int32).tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n], pa.int64()), pa.array([block], pa.int32()), nothing if block else whole, pa.array([matrix], pa.binary())],
                        names=["chunk", "block", "ids", "cells"],
                    )
                n += 1

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, "shards")
    table = f"shards_{path.rsplit('-', 1)[-1]}"
    rows = vectors.mapInArrow(cut, f"chunk long, block int, ids array<{kind}>, cells binary")
    # One file a bucket and block.
    dealt = rows.repartition(buckets, "chunk").write.partitionBy("block").bucketBy(buckets, "chunk").sortBy("chunk")
    dealt.option("path", path).saveAsTable(table)
    found = spark.table(table)
    found._stored_at, found._name, found._width = path, table, width
    return found


def _cells(data: pa.Scalar, width: int) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), np.int32).reshape(-1, width)


def _squared(cells: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(vectors, clusters) squared distances, exact in 64 bits."""
    found = np.empty((len(cells), len(centroids)), np.int64)
    cells = cells.astype(np.int64)
    for cluster, centroid in enumerate(centroids):
        apart = cells - centroid
        np.einsum("ij,ij->i", apart, apart, out=found[:, cluster])
    return found


def assign(shards: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(chunk, clusters, distances) of each chunk, as 32-bit and 64-bit numbers of its vectors in order."""
    shared = shards.sparkSession.sparkContext.broadcast(centroids)
    (n_clusters, dimensions), width = centroids.shape, shards._width

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for block, data in zip(batch.column("block").to_pylist(), batch.column("cells")):
                part = shared.value[:, block * width : (block + 1) * width]
                found = _squared(_cells(data, part.shape[1]), part)
                narrow = found.max(initial=0) < 1 << 31
                sums.append((found.astype(np.int32) if narrow else found).tobytes())
            narrow_or_wide = pa.array(sums, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("size"), narrow_or_wide], names=["chunk", "size", "partial"])

    def least(total: np.ndarray) -> tuple[bytes, bytes]:
        best = total.argmin(axis=1)
        return best.astype(np.int32).tobytes(), total[np.arange(len(best)), best].tobytes()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = None, None
        for batch in batches:
            done = []
            for key, size, data in zip(batch.column("chunk").to_pylist(), batch.column("size").to_pylist(), batch.column("partial")):
                raw = data.as_buffer()
                kind = np.int32 if raw.size == 4 * size * n_clusters else np.int64
                part = np.frombuffer(raw, kind).reshape(size, n_clusters)
                if key == chunk:
                    total += part
                else:
                    if chunk is not None:
                        done.append((chunk, *least(total)))
                    chunk, total = key, part.astype(np.int64)
            yield rows(done)
        if chunk is not None:
            yield rows([(chunk, *least(total))])

    def rows(done: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds)], names=["chunk", "clusters", "distances"])

    # The last block may have fewer columns.
    columns = F.least(F.lit(width), dimensions - F.col("block") * width)
    size = (F.octet_length("cells") / (4 * columns)).cast("int")
    partials = shards.select("chunk", "block", size.alias("size"), "cells").mapInArrow(compare, "chunk long, size int, partial binary")
    return partials.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, clusters binary, distances binary")


def updated(shards: DataFrame, assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids as the floor of the mean of their vectors; those without vectors stay as they are."""
    (n_clusters, dimensions), width = centroids.shape, shards._width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_clusters, dimensions), np.int64)
        counts = np.zeros((n_clusters, dimensions), np.int64)
        for batch in batches:
            for block, data, clusters in zip(batch.column("block").to_pylist(), batch.column("cells"), batch.column("clusters")):
                columns = slice(block * width, min((block + 1) * width, dimensions))
                cells = _cells(data, columns.stop - columns.start)
                cluster = np.frombuffer(clusters.as_buffer(), np.int32)
                order = np.argsort(cluster, kind="stable")
                some, first = np.unique(cluster[order], return_index=True)
                sums[some, columns] += np.add.reduceat(cells[order].astype(np.int64), first, axis=0)
                counts[some, columns] += np.diff(first, append=len(cluster))[:, None]
        cluster, dimension = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.astype(np.int32)), pa.array(dimension.astype(np.int32)), pa.array(sums[cluster, dimension]), pa.array(counts[cluster, dimension])],
            names=["cluster", "dimension", "total", "n"],
        )

    both = shards.select("chunk", "block", "cells").join(assigned.select("chunk", "clusters"), "chunk")
    sums = both.select("block", "cells", "clusters").mapInArrow(add, "cluster int, dimension int, total long, n long")
    slices = sums.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    floor = F.expr("(total - pmod(total, n)) div n")
    after = centroids.copy()
    for row in slices.select("cluster", "dimension", floor.alias("mean")).collect():
        after[row.cluster, row.dimension] = row.mean
    return after


def cluster(embeddings: DataFrame, clusters: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, seed: str = "3", width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of the vectors in ``embedding``."""
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings.select("vec_id", "embedding"), dimensions, scale)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    shards = column_blocks(vectors, dimensions, width, chunk)
    for _ in range(rounds):
        centroids = updated(shards, assign(shards, centroids), centroids)
    ids = shards.where("block = 0").select("chunk", "ids")
    numbered = ids.join(assign(shards, centroids), "chunk").select("ids", "clusters", "distances")

    def vectors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                part = [np.frombuffer(batch.column(c)[n].as_buffer(), kind) for c, kind in (("clusters", np.int32), ("distances", np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(n, 1).flatten(), *map(pa.array, part)], names=["vec_id", "cluster", "distance"])

    found = stored(numbered.mapInArrow(vectors_of, f"vec_id {kind}, cluster int, distance long"), "clustered")
    spark.sql(f"DROP TABLE {shards._name}")
    discard(shards)
    # One row a cluster.
    totals = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    per_cluster = [(c, total, sum(totals.values()), centroids[c].tolist()) for c, total in totals.items()]
    about = spark.createDataFrame(per_cluster, "_cluster int, cluster_inertia long, inertia long, centroid array<long>")
    joined = found.join(F.broadcast(about), found["cluster"] == about["_cluster"])
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
