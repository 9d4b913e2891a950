"""Near-duplicate vectors by cosine, from randomised-rotation binary codes.

Each unit vector ``o`` is turned by seeded random rotations; its code is the signs of
the turned coordinates, and beside it stands the correction factor ``f``, the inner
product of the vector with its own code.  For another vector ``q`` the inner product of
the turned ``q`` with the code of ``o``, divided by ``f``, is an unbiased estimate of
their cosine, with an error of order ``sqrt((1 - f**2) / f**2 / (d - 1))``.

Candidates share one of ``T`` keys of ``k`` sign bits; ``k`` grows with the logarithm of
the number of vectors, so that a key holds a few unlike vectors, and ``T`` follows from
the recall asked for at the threshold.  A candidate is dropped where the upper
confidence bound of its estimate lies below the threshold; every other one is computed
anew in double precision.  A pair that shares several keys is judged under the first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import cells
from ledgerline.llm.common import components, written

SEED = 20_240_531
BLOCK = 512
PER_KEY = 16
CONFIDENCE = 4.0  # standard errors of an estimate
INDEX = "rep long, n_same long, vector binary, code binary, factors binary, keys array<long>"


@dataclass(frozen=True)
class Plan:
    """Bits per key, keys and rotations for a number of vectors."""

    bits: int
    tables: int

    @staticmethod
    def of(rows: int, threshold: float, recall: float) -> Plan:
        agree = 1 - math.acos(threshold) / math.pi
        bits = min(30, max(8, math.ceil(math.log2(max(2, rows / PER_KEY)))))
        tables = math.ceil(math.log(1 - recall) / math.log(1 - agree**bits))
        return Plan(bits, tables)


@lru_cache(maxsize=8)
def rotations(dim: int, plan: Plan) -> np.ndarray:
    """Random rotations side by side: enough columns for the bits of all keys."""
    count = -(-plan.bits * plan.tables // dim)
    made = []
    for n in range(count):
        noise = np.random.default_rng([SEED, dim, n]).standard_normal((dim, dim))
        q, r = np.linalg.qr(noise)
        made.append(q * np.sign(np.diag(r)))
    return np.hstack(made)


def _signs(codes: list[bytes], width: int) -> np.ndarray:
    bits = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return np.unpackbits(bits, axis=1, count=width)


def _keys(signs: np.ndarray, dim: int, plan: Plan) -> np.ndarray:
    """One key per table, with the table and the dimension in it."""
    use = signs[:, : plan.bits * plan.tables].reshape(len(signs), plan.tables, plan.bits)
    keys = use.astype(np.int64) @ (1 << np.arange(plan.bits, dtype=np.int64))
    mark = np.arange(plan.tables, dtype=np.int64) + plan.tables * dim
    return (mark << plan.bits) + keys


def _coded(vectors: DataFrame, plan: Plan) -> DataFrame:
    """The index: codes, correction factors and keys of distinct valid vectors."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            lengths = np.array([len(x) // 8 for x in raw])
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                v = np.frombuffer(b"".join(raw[r] for r in rows)).reshape(-1, dim)
                unit = v / np.linalg.norm(v, axis=1)[:, None]
                turned = unit @ rotations(int(dim), plan)
                signs = turned > 0
                parts = np.abs(turned).reshape(len(v), -1, dim).sum(2) / math.sqrt(dim)
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        taken.column("rep"),
                        taken.column("n_same"),
                        taken.column("vector"),
                        pa.array([x.tobytes() for x in np.packbits(signs, axis=1)], pa.binary()),
                        pa.array([x.tobytes() for x in parts], pa.binary()),
                        pa.array(list(_keys(signs, int(dim), plan)), pa.list_(pa.int64())),
                    ],
                    ["rep", "n_same", "vector", "code", "factors", "keys"],
                )

    return vectors.mapInArrow(code, INDEX)


def _packed(vectors: DataFrame) -> DataFrame:
    """Each row's vector as packed doubles; null where it links with nothing."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for values in batch.column(1):
                if not values.is_valid or values.values.null_count or not len(values):
                    out.append(None)
                    continue
                v = np.asarray(values.values.to_numpy(zero_copy_only=False), np.float64)
                with np.errstate(all="ignore"):
                    norm = np.linalg.norm(v)
                # Minus zero and zero are one value, so equal vectors have equal bytes.
                usable = np.isfinite(v).all() and 0 < norm < np.inf
                out.append((v + 0.0).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vector"]
            )

    return vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding"
    ).mapInArrow(pack, "vec_id long, vector binary")


def _judge(threshold: float, plan: Plan):
    def judge(table: pa.Table, links: cells.Links) -> None:
        raw = table.column("vector").to_pylist()
        dim = len(raw[0]) // 8  # a key holds vectors of one dimension
        same = np.array([len(x) // 8 for x in raw])
        weights = table.column("n_same").to_numpy().astype(np.float64)
        codes = table.column("code").to_pylist()
        factors_of = table.column("factors").to_pylist()
        for dim in np.unique(same):
            dim = int(dim)
            if (same == dim).all():
                rows = None
            else:
                rows = np.flatnonzero(same == dim)
            pick = range(len(raw)) if rows is None else rows
            place = np.full(len(raw), -1)
            place[np.asarray(pick)] = np.arange(len(pick))
            v = np.frombuffer(b"".join(raw[r] for r in pick)).reshape(-1, dim)
            norms = np.linalg.norm(v, axis=1)
            base = rotations(dim, plan)
            turned = ((v / norms[:, None]) @ base).astype(np.float32)
            bits = _signs([codes[r] for r in pick], base.shape[1])
            signs = bits.astype(np.float32) * 2 - 1
            factors = np.frombuffer(b"".join(factors_of[r] for r in pick))
            factors = factors.reshape(len(v), -1)
            # The estimate is the mean over rotations of <turned q, code> / f.
            scale = np.repeat(1 / factors, dim, axis=1) / math.sqrt(dim) / factors.shape[1]
            scaled = signs * scale.astype(np.float32)
            spread = (1 - factors**2).clip(0) / factors**2 / max(1, dim - 1)
            error = CONFIDENCE * np.sqrt(spread.mean(1) / factors.shape[1])
            keys = _keys(bits, dim, plan)
            own = table.column("cell_key").to_numpy()
            own_table = (own >> plan.bits) - plan.tables * dim
            for a, b in cells.pairs(table):
                mine = (place[a] >= 0) & (place[b] >= 0)
                a, b = a[mine], b[mine]
                if not len(a):
                    continue
                pa_, pb = place[a], place[b]
                first = (keys[pa_] == keys[pb]).argmax(1) == own_table[a]
                a, b, pa_, pb = a[first], b[first], pa_[first], pb[first]
                estimate = np.einsum("ij,ij->i", turned[pa_], scaled[pb])
                open_ = estimate + error[pb] >= threshold
                a, b, pa_, pb = a[open_], b[open_], pa_[open_], pb[open_]
                exact = np.einsum("ij,ij->i", v[pa_], v[pb]) / (norms[pa_] * norms[pb])
                linked = exact >= threshold
                links.add(a[linked], b[linked], weights)

    return judge


def near_vectors(
    vectors: DataFrame, threshold: float = 0.95, recall: float = 0.995
) -> DataFrame:
    """Links and components of vectors with cosine of ``threshold`` or more.

    ``vectors`` needs ``vec_id`` and ``embedding``; further columns are ignored.  Null,
    empty or zero vectors and those with null or non-finite components link with
    nothing, nor do vectors of different dimensions.  Rows without an id are left out
    of the links and keep a row of their own with null component.  Equal vectors count
    as links of each other and are compared once.

    Returns ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links)
    and ``kept`` for every row.
    """
    packed = written(_packed(vectors), "vectors")
    usable = packed.where("vector is not null and vec_id is not null")
    distinct = usable.groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n_same")
    )
    plan = Plan.of(usable.count(), threshold, recall)
    index = written(_coded(distinct, plan), "vector-codes")

    keyed = index.select(
        F.explode("keys").alias("key"), "rep", "n_same", "vector", "code", "factors"
    )
    parts = (
        index.select(F.explode("keys").alias("key"))
        .groupBy("key")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("g"))
        .where("g > 1")
    )
    found = written(
        cells.compared(
            cells.spread(keyed, "key", "rep", parts), _judge(threshold, plan), "rep"
        ),
        "vector-links",
    )
    counts = found.groupBy("id").agg(F.sum("n_links").alias("n_other"))
    roots = components(found.select(F.col("id").alias("a"), F.col("head").alias("b")))
    groups = (
        index.select("rep", "n_same", "vector")
        .join(counts, F.col("rep") == counts["id"], "left")
        .join(roots, F.col("rep") == roots["node"], "left")
        .select(
            "vector",
            (F.coalesce("n_other", F.lit(0)) + F.col("n_same") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    linked = usable.join(groups, "vector").select("vec_id", "n_links", "component_id")
    alone = packed.where("vector is null or vec_id is null").select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
