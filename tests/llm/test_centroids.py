"""Centroid clustering against plain rounds, and its search against all distances."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import centroids, queries
from ledgerline.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"
CLASH = "vec_id long, embedding array<double>, values array<string>, vector string, cluster string, distance int, inertia string"


def plain(vectors, k=8, rounds=10):
    """Rows of (vec_id, cluster, distance) and the centroids, in plain integers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in vectors
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    rank = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(),)
    centres = [v for _, v in sorted(kept, key=rank)[:k]]

    def assign():
        out = []
        for i, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((i, far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        rows = assign()
        for c in range(len(centres)):
            own = [v for (_, v), row in zip(kept, rows) if row[1] == c]
            if own:
                centres[c] = [sum(x) // len(own) for x in zip(*own)]
    return assign(), centres


def expected(vectors):
    rows, centres = plain(vectors)
    total = sum(r[2] for r in rows)
    by = {c: sum(r[2] for r in rows if r[1] == c) for c in range(len(centres))}
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, by[c], total, name[c]) for i, c, d in rows), key=str)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 60), st.integers(1, 20), st.integers(0, 40), st.integers(0, 2**32))
def test_search_finds_the_first_nearest(n, k, d, size, seed):
    rng = np.random.default_rng(seed)
    big = 1 << rng.integers(0, 28)
    rows = rng.integers(-big, big + 1, (n, d)) // (1 + size)
    centres = rng.integers(-big, big + 1, (k, d)) // (1 + size)
    centres[rng.integers(0, k, k // 2)] = centres[0]  # ties
    far = ((rows[:, None, :] - centres[None]) ** 2).sum(axis=2)
    found, best, computed = centroids.nearest(rows, centres)
    assert (found == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert computed <= n * k


def test_search_rejects_most_centroids():
    rng = np.random.default_rng(5)
    centres = rng.integers(-2000, 2000, (256, 1)) + rng.integers(-40, 40, (256, 64))
    rows = centres[rng.integers(0, 256, 2000)] + rng.integers(-9, 9, (2000, 64))
    _, _, computed = centroids.nearest(rows, centres)
    assert computed < 0.05 * 2000 * 256


def test_odd_vectors(spark):
    ship(spark)
    rng = np.random.default_rng(7)
    vectors = [(i, rng.normal(0, 1, 64).tolist()) for i in range(30)]
    vectors += [(3, vectors[3][1])] * 5 + [(100, [0.0] * 64), (101, [-1e5] * 64), (102, None), (103, [])]
    vectors += [(104, [1.0] * 63), (105, [None] + [1.0] * 63), (106, [float("nan")] + [1.0] * 63)]
    vectors += [(107, [float("-inf")] + [1.0] * 63), (108, [1.0] * 65), (None, [0.5] * 64)]
    frame = spark.createDataFrame([(i, v, ["x"], "v", "c", 1, "t") for i, v in vectors], CLASH)
    got = centroids.clustered(frame)
    assert sorted(map(tuple, got.collect()), key=str) == expected(vectors)
    assert centroids.clustered(frame.where("false")).collect() == []
    few = frame.where("vec_id in (100, 101)")
    assert sorted(map(tuple, centroids.clustered(few).collect()), key=str) == expected(vectors[35:37])
    with pytest.raises(Exception, match="64 bits"):
        huge = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
        centroids.clustered(huge).collect()


def test_op12(spark):
    vectors = duckdb.sql(f"select vec_id, embedding from '{SF_DIR}/embeddings.parquet'").fetchall()
    got = queries.op12_centroids(spark, SF_DIR)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(vectors)


def test_op12_agrees_with_sql(spark):
    check = differences(queries.op12_centroids(spark, SF_DIR), connect(SF_DIR), queries.CHECKS["op12_centroids"])
    assert check == []
