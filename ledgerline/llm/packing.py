"""Harmonic packing of token ids into sequences of fixed capacity.

A document is cut into whole sequences and a rest.  A length ``r`` with
``capacity // (k + 1) < r <= capacity // k`` is of class ``k``; a sequence of class
``k`` takes exactly ``k`` pieces.  So that classes fill well, a rest is cut up to
``CUTS`` times at ``capacity // k``, the longest length of a class that it covers;
what is left falls into its own class as it is.

Every worker fills the sequences of each class by itself.  Its unfinished ones, under
``k`` pieces a class, are numbered over all workers from their counts and filled in the
same way; then under ``k`` pieces a class are left in all.  Those, a number fixed by
the capacity alone, are laid end to end and cut at the capacity: one sequence at most
needs padding there.

Sequences are numbered in the order in which the documents complete them, partition
after partition; only the last few, of a number fixed by the capacity, come at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import small_side, whole_text, written
from ledgerline.llm.tokens import encoder

CAPACITY = 1024
CUTS = 2
DOCS_AT_ONCE = 256
# Sequence ids: workers count from worker * 2**32; a joined sequence lies above those of
# the worker that has its last piece, which completes one sequence of a class at most.
WORKER_BITS = 32
JOINED = 1 << 31
LAST = 1 << 62
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, class int, "
    "worker long, slot long, sequence_id long, offset long, ids binary"
)
PACKED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def class_of(length: int, capacity: int) -> int:
    return capacity // length


def cut_rest(rest: int, capacity: int, cuts: int = CUTS) -> list[int]:
    """Lengths that a rest below the capacity is cut into."""
    parts = []
    for _ in range(cuts):
        if not rest:
            break
        full = capacity // -(-capacity // rest)
        parts.append(full)
        rest -= full
    return [*parts, rest] if rest else parts


def _cut(packed: bytes, width: int, capacity: int):
    """Start, length and class of each piece of a document."""
    n = len(packed) // width
    whole = n - n % capacity
    lengths = [capacity] * (n // capacity) + cut_rest(n % capacity, capacity)
    start = 0
    for length in lengths:
        yield start, length, class_of(length, capacity)
        start += length
    assert whole <= start == n


def pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents; ``sequence_id`` is null where a worker left one open."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        width = tool.width
        end = end_id.to_bytes(width, "little")
        worker, sequence = TaskContext.get().partitionId(), 0
        opened: dict[int, list] = {}

        def rows(found) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 10
            ids = [
                np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()
                for x in columns[9]
            ]
            kinds = [pa.int64()] * 4 + [pa.int32()] + [pa.int64()] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = [part.split()[0] for part in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                found = []
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns[:2])):
                    packed = tool.encode(text) + end
                    n = len(packed) // width
                    for start, length, kind in _cut(packed, width, capacity):
                        ids = packed[start * width : (start + length) * width]
                        held = opened.setdefault(kind, [])
                        held.append((doc_id, start, length, n, kind, ids))
                        if len(held) == kind:
                            number, offset = (worker << WORKER_BITS) + sequence, 0
                            for slot, x in enumerate(held):
                                found.append((*x[:5], worker, slot, number, offset, x[5]))
                                offset += x[2]
                            sequence += 1
                            opened[kind] = []
                yield rows(found)
        yield rows(
            [
                (*x[:5], worker, slot, None, None, x[5])
                for held in opened.values()
                for slot, x in enumerate(held)
            ]
        )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).mapInArrow(fill, PIECES)


def _joined(left: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """What workers left open, filled class by class; and the last few pieces."""
    # One row per worker and class.
    counts = left.groupBy("worker", "class").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("class")
        .orderBy("worker")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    places = counts.select(
        "worker",
        "class",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("class")).alias("of_class"),
    )
    ranked = left.join(small_side(places), ["worker", "class"]).withColumn(
        "place", F.col("before") + F.col("slot")
    )
    number = F.floor(F.col("place") / F.col("class"))
    ranked = ranked.withColumn("bin", number).withColumn(
        "full", number < F.floor(F.col("of_class") / F.col("class"))
    )
    inside = (
        Window.partitionBy("class", "bin")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last = F.max("worker").over(Window.partitionBy("class", "bin"))
    full = ranked.where("full").select(
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        (last * F.lit(1 << WORKER_BITS) + F.lit(JOINED) + F.col("class")).alias(
            "sequence_id"
        ),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
        "ids",
    )
    return full, ranked.where("not full")


def _laid_out(rest: DataFrame, capacity: int) -> DataFrame:
    """The last pieces end to end, cut at the capacity."""

    def lay(frame: pd.DataFrame) -> pd.DataFrame:
        out, at = [], 0
        frame = frame.sort_values(["class", "place"])
        for row in frame.itertuples(index=False):
            done = 0
            while done < row.length:
                room = min(capacity - at % capacity, row.length - done)
                out.append(
                    (
                        row.doc_id,
                        row.start + done,
                        room,
                        row.doc_tokens,
                        LAST + at // capacity,
                        at % capacity,
                        row.ids[4 * done : 4 * (done + room)],
                    )
                )
                done += room
                at += room
        made = pd.DataFrame(out, columns=[x.split()[0] for x in PACKED.split(", ")])
        return made.astype({"doc_id": "Int64"})

    return (
        rest.select("doc_id", "start", "length", "doc_tokens", "class", "place", "ids")
        .groupBy(F.lit(0).alias("all"))
        .applyInPandas(lay, PACKED)
    )


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents with their sequence and offset there.

    ``docs`` needs ``doc_id`` and ``text``; a null text counts as empty, further columns
    are ignored, rows with the same or no ``doc_id`` are documents of their own.
    Returns ``doc_id``, ``start``, ``length``, ``doc_tokens`` (the end id included),
    ``sequence_id``, ``offset`` and ``ids`` (little-endian unsigned 32-bit integers).
    """
    cut = written(pieces(docs, vocabulary, end_id, capacity), "packed-pieces")
    columns = [part.split()[0] for part in PACKED.split(", ")]
    closed = cut.where("sequence_id is not null").select(columns)
    full, rest = _joined(cut.where("sequence_id is null"), capacity)
    return closed.unionByName(full).unionByName(_laid_out(rest, capacity))


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per sequence: its ids in order, tokens, padding and documents.

    A sequence holds ``capacity`` ids at most, so a group is bounded.
    """
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
            F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("n_tokens"),
            F.transform("parts", lambda x: x["doc_id"]).alias("doc_ids"),
            F.transform("parts", lambda x: x["offset"]).alias("offsets"),
        )
        .withColumn("n_padding", F.lit(capacity) - F.col("n_tokens"))
    )
