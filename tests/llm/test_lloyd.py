from __future__ import annotations

import hashlib
import math
import random

import pytest
from compare import SMALL as FOLDER
from compare import connect, difference

from tradeloom.llm import queries, sharded_lloyd


def brute(rows, clusters=8, rounds=10, dimensions=64):
    """Rows of (vec_id, embedding) one by one, in Python's whole numbers."""
    far = 1 << 27
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(min(max(1024.0 * x, -far), far)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), m in zip(kept, members) if m == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [(vec_id, *nearest(v)[::-1]) for vec_id, v in kept]
    inertia = sum(d for _, _, d in found)
    per = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    return sorted((str(i), k, d, per[k], inertia, centroids[k]) for i, k, d in found)


def rows_of(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in df.collect())


def test_query_equals_sql(llm):
    found = queries.queries()["op13_sharded_lloyd"](llm, FOLDER)
    assert difference(found, connect(FOLDER), queries.oracle_sql()["op13_sharded_lloyd"]) is None


@pytest.mark.parametrize("width,chunk", [(7, 5), (64, 3), (1, 11)])
def test_every_cut_of_the_matrix(llm, width, chunk):
    draw = random.Random(width)
    rows = [(i, [draw.gauss(i % 3, 0.3) for _ in range(10)]) for i in range(60)]
    found = sharded_lloyd.cluster(llm.createDataFrame(rows, "vec_id long, embedding array<double>"), 4, 3, 10, width=width, chunk=chunk)
    assert rows_of(found) == brute(rows, 4, 3, 10)


def test_odd_vectors(llm):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(i % 4, 1.0) for _ in range(64)]) for i in range(40)]
    rows += [(i % 5, rows[i][1]) for i in range(20)]  # repeated ids and vectors
    rows += [(None, rows[0][1]), (None, rows[1][1]), (100, None), (101, []), (102, [1.0] * 63), (103, [None] * 64), (104, [float("nan")] * 64)]
    rows += [(105, [float("inf")] + [0.0] * 63), (106, [1e300, -1e300] * 32), (107, [-0.0] * 64), (108, [1e-9, -1e-9] * 32)]
    frame = llm.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, chunk int")
    assert rows_of(sharded_lloyd.cluster(frame)) == brute(rows)


def test_few_equal_and_no_vectors(llm):
    schema = "vec_id string, embedding array<float>"
    same = [(f"v{i}", [0.5] * 64) for i in range(30)]
    assert rows_of(sharded_lloyd.cluster(llm.createDataFrame(same, schema))) == brute(same)
    assert rows_of(sharded_lloyd.cluster(llm.createDataFrame(same[:3], schema))) == brute(same[:3])
    assert sharded_lloyd.cluster(llm.createDataFrame([], schema)).collect() == []


def test_a_vector_in_a_third_of_all_rows(llm):
    draw = random.Random(3)
    rows = [(i, [1.0] * 64 if i % 3 == 0 else [draw.gauss(0, 1) for _ in range(64)]) for i in range(3000)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(16)
    assert rows_of(sharded_lloyd.cluster(frame, rounds=3)) == brute(rows, rounds=3)
