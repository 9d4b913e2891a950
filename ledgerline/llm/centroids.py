"""Centroid clustering with an equal-average equal-variance nearest-centroid search.

Centroids are sorted by the mean of their components.  A vector starts at the place of
its own mean and looks outward on both sides, the nearer mean first.  With sums ``S`` of
``d`` components and ``V = d * sum(x * x) - S * S`` (both whole numbers), the squared
distance ``D`` of a vector and a centroid obeys

    d * D >= (Sx - Sc) ** 2                                    by the means, and
    d * D >= (Sx - Sc) ** 2 + (sqrt(Vx) - sqrt(Vc)) ** 2       by means and deviations.

The first one ends a vector's search on that side, the second one rejects a single
centroid; only what passes both is computed, in whole numbers.  The bounds are taken with
room for rounding, so no nearest centroid, and no tie, is lost to it.

Components are ``floor(SCALE * x)``.  Vectors are written once as packed integers; each
round passes over them once, a task sends one row of sums per centroid, and only the
centroids (``k`` rows of ``d`` numbers) pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written

SCALE = 1024
DIMENSION = 64
# Beyond it, a squared distance of 64 components may not fit 64 bits.
LARGEST = 1 << 27
PACKED = "vec_id long, vector binary"


def packed(vectors: DataFrame, column: str = "embedding", dimension: int = DIMENSION) -> DataFrame:
    """``vec_id`` and ``vector``: packed 64-bit integers of the rows that take part.

    Left out are vectors that are null, have another number of components or hold null
    or non-finite ones.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(values.astype(np.float64) * SCALE)
            if len(whole) and np.abs(whole).max() > LARGEST:
                raise ValueError(f"a component beyond {LARGEST // SCALE}: distances don't fit 64 bits")
            rows = whole.astype(np.int64).reshape(-1, dimension)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["vec_id", "vector"],
            )

    plain = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("values"),
    )
    finite = F.forall(
        "values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    good = (F.size("values") == dimension) & finite
    return plain.where(F.coalesce(good, F.lit(False))).mapInArrow(pack, PACKED)


def unpacked(rows: list[bytes]) -> np.ndarray:
    joined = np.frombuffer(b"".join(rows), np.int64)
    return joined.reshape(len(rows), len(joined) // max(1, len(rows)))


def _spread(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums, and square roots of ``V``, of each row."""
    sums = rows.sum(axis=1)
    # Sums of squares of 2**27 and of 64 of them, times 64, leave 64 bits: floats do.
    wide = rows.astype(np.float64)
    squares = np.einsum("ij,ij->i", wide, wide)
    v = rows.shape[1] * squares - sums.astype(np.float64) ** 2
    return sums, np.sqrt(np.maximum(v, 0))


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid (ties: smaller number),
    and how many distances were computed."""
    n, d = rows.shape
    k = len(centroids)
    c_sums, c_devs = _spread(centroids)
    order = np.argsort(c_sums, kind="stable")
    c_sums, c_devs = c_sums[order], c_devs[order]
    sums, devs = _spread(rows)
    # Twice the error that rounding can put into a deviation of this size.
    doubt = 1e-6 * (np.abs(sums).max(initial=0) + devs.max(initial=0) + c_devs.max() + np.abs(c_sums).max() + 1)
    best = np.full(n, np.iinfo(np.int64).max)
    found = np.full(n, k)
    right = np.searchsorted(c_sums, sums)
    left = right - 1
    active = np.arange(n)
    computed = 0
    far = np.iinfo(np.int64).max
    while len(active):
        lo, hi = left[active], right[active]
        s = sums[active]
        low = np.where(lo >= 0, s - c_sums[np.maximum(lo, 0)], far)
        high = np.where(hi < k, c_sums[np.minimum(hi, k - 1)] - s, far)
        below = low <= high
        gap = np.where(below, low, high)
        limit = best[active].astype(np.float64) * d
        # Means further out differ more: the search of these vectors is over.
        on = (gap != far) & (np.square(gap.astype(np.float64)) * (1 - 1e-9) <= limit)
        active, below, gap, limit = active[on], below[on], gap[on], limit[on]
        place = np.where(below, left[active], right[active])
        left[active[below]] -= 1
        right[active[~below]] += 1
        apart = np.maximum(np.abs(devs[active] - c_devs[place]) - doubt, 0)
        near = (np.square(gap.astype(np.float64)) + np.square(apart)) * (1 - 1e-9) <= limit
        who, which = active[near], order[place[near]]
        for at in range(0, len(who), 16_384):
            a, b = who[at : at + 16_384], which[at : at + 16_384]
            apart2 = rows[a] - centroids[b]
            exact = np.einsum("ij,ij->i", apart2, apart2)
            better = (exact < best[a]) | ((exact == best[a]) & (b < found[a]))
            best[a[better]], found[a[better]] = exact[better], b[better]
        computed += len(who)
    return found, best, computed


def first_centroids(points: DataFrame, k: int, rank: Column) -> np.ndarray:
    """The vectors of smallest ``rank``; equal ranks go by id and components."""
    rows = points.orderBy(rank, "vec_id", "vector").limit(k).select("vector").collect()
    return unpacked([bytes(r["vector"]) for r in rows])


def _moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids at the floor of their vectors' means; empty ones stay."""
    schema = "cluster int, n long, sums array<long>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(centroids.shape, np.int64)
        counts = np.zeros(len(centroids), np.int64)

        def told() -> pa.RecordBatch:
            used = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array(counts[used]),
                    pa.array(list(sums[used]), pa.list_(pa.int64())),
                ],
                ["cluster", "n", "sums"],
            )

        for batch in batches:
            rows = unpacked(batch.column(1).to_pylist())
            if not len(rows):
                continue
            cluster, _, _ = nearest(rows, centroids)
            if counts.sum() + len(rows) > 1 << 34:  # before 64 bits could overflow
                yield told()
                sums[:], counts[:] = 0, 0
            np.add.at(counts, cluster, 1)
            order = np.argsort(cluster, kind="stable")
            firsts = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            sums[cluster[order][firsts]] += np.add.reduceat(rows[order], firsts, axis=0)
        yield told()

    total = (
        points.mapInArrow(add, schema)
        .groupBy("cluster")
        .agg(
            F.sum("n").alias("n"),
            *(
                F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}")
                for i in range(centroids.shape[1])
            ),
        )
    )
    moved = centroids.copy()
    for row in total.collect():
        moved[row["cluster"]] = [int(x) // row["n"] for x in row[2:]]
    return moved


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clusters(points: DataFrame, first: np.ndarray, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and squared ``distance`` of each packed vector, and the
    final centroids, after ``rounds`` of assigning vectors and moving centroids."""
    centroids = first
    for _ in range(rounds if len(first) else 0):
        moved = _moved(points, centroids)
        if (moved == centroids).all():
            break  # nothing would change in the rounds left
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = unpacked(batch.column(1).to_pylist())
                cluster, distance, _ = nearest(rows, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    return points.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids


def clustered(
    vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, column: str = "embedding"
) -> DataFrame:
    """Clusters of vectors, and how tight they are.

    ``vectors`` needs ``vec_id`` and the vector's column; further columns are ignored.
    Left out are vectors that are null, have not just ``DIMENSION`` components or hold null
    or non-finite ones.  Rows that repeat an id, or have none, are vectors of their own.
    The first centroids are the vectors with smallest sha256 of ``<seed>:<vec_id>`` (no id:
    an empty one; equal hashes go by components).  Fewer than ``k`` vectors make as many
    centroids, none an empty result.  A component of 131,072 or more fails the run, as
    distances would not fit their column.

    Returns ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` (of its components as decimals joined by commas).
    """
    spark = vectors.sparkSession
    points = written(packed(vectors, column), "cluster-points")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    assigned, centroids = clusters(points, first_centroids(points, k, rank), rounds)
    assigned = written(assigned, "cluster-members")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    total = int(sum(r["sum"] for r in sums))
    told = spark.createDataFrame(
        [(r["cluster"], int(r["sum"]), total, digest(centroids[r["cluster"]])) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
