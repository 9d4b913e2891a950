"""Removal of byte strings that occur more than once in a corpus.

A whole corpus' suffixes would shuffle tens of times its size, so only text that can
repeat is sorted.

1. Anchors.  Among the ``LENGTH - Q + 1`` runs of ``Q`` bytes within any string of
   ``LENGTH`` bytes, the one with the smallest hash (the first of equal ones) is its
   anchor.  Equal strings have their anchor at the same place, so strings with
   different anchor runs differ.  A document's strings with the same anchor lie one
   byte apart and make up one stretch.
2. Stretches that are equal as a whole, anchor place included, repeat in every string.
   They are counted by hash with partial aggregation; copies go no further.
3. Of the stretches left, one of each kind whose anchor run occurs in another kind is
   compared: grouped by anchor run, their suffixes are put in order by the difference
   cover modulo 3 (``suffix_array``), and strings that equal a neighbour's repeat.
   Groups are dealt over tasks and sorted some hundred thousand bytes at a time.
4. A run shared by more than ``MOST_KINDS`` kinds, such as a very common line, would not
   fit one task.  Its stretches are cut into bands of ``BAND`` strings, and the bytes that
   all strings of a band share become the band's anchor: groups fall apart wherever texts
   differ there.  Should a band's bytes still be shared by that many, every string of it
   is grouped by a 128-bit digest of its own.  The result is the same each way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS, small_side, whole_text, written
from ledgerline.llm.suffix_array import repeated_places, suffix_array

LENGTH = 400
Q = 32
MOST_KINDS = 512
BAND = 46
SORT_BYTES = 250_000
READ_BYTES = 1 << 19
MOST_ITEMS = 1_500_000  # some 64 bytes each
HOT_ROWS = 100_000
STRETCHES = "doc_key long, anchor long, kind long, first int, last int, at int"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def rolled(data: np.ndarray, length: int, salt: int = 1) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(salt)) * _ODD
    h ^= h >> np.uint64(29)
    made, covered, span = None, 0, 1
    while True:
        if length & span:
            if made is None:
                made, covered = h, span
            else:
                n = len(data) - covered - span + 1
                made = (made[:n] * _M1 + h[covered : covered + n]) * _M2
                made ^= made >> np.uint64(31)
                covered += span
        if span * 2 > length:
            return made
        n = len(data) - 2 * span + 1
        h = (h[:n] * _M2 + h[span : span + n]) * _M1
        h ^= h >> np.uint64(30)
        span *= 2


def first_smallest(values: np.ndarray, window: int) -> np.ndarray:
    """The smallest of each ``window`` values: running minima within blocks."""
    n = len(values)
    top = np.iinfo(values.dtype).max
    blocks = -(-n // window)
    padded = np.full(blocks * window, top, values.dtype)
    padded[:n] = values
    rows = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - window + 1], ahead[window - 1 : n])


def stretches(data: np.ndarray, bounds: np.ndarray):
    """Anchors of all strings of joined documents with ends at ``bounds``.

    Yields arrays: document number, anchor place, first and last string place (all
    places within ``data``), and the hash of the anchor run.
    """
    window = LENGTH - Q + 1
    hashes = rolled(data, Q)
    # The place breaks ties, so equal runs within a string give the first one.
    keys = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(
        len(hashes), dtype=np.uint64
    )
    anchors = (first_smallest(keys, window) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    places = np.arange(len(anchors))
    doc = np.searchsorted(bounds, places, "right")
    inside = places + LENGTH <= bounds[doc]
    new = np.ones(len(anchors), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    firsts = np.flatnonzero(new & inside)
    ends = np.flatnonzero(inside & np.r_[new[1:] | ~inside[1:], True])
    return doc[firsts], anchors[firsts], firsts, ends, hashes[anchors[firsts]]


def _joined(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in joined lots of about ``READ_BYTES``: their numbers, where the parts
    begin in them, the bytes, and the ends of the parts.

    A longer text comes in parts that share ``LENGTH - 1`` bytes, so that every string
    is whole in one of them.
    """
    lot, size = [], 0
    for n, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), READ_BYTES):
            part = text[at : at + READ_BYTES + LENGTH - 1]
            if len(part) < LENGTH:
                continue
            if lot and size + len(part) > READ_BYTES:
                yield _lot(lot)
                lot, size = [], 0
            lot.append((n, at, part))
            size += len(part)
    if lot:
        yield _lot(lot)


def _lot(lot):
    numbers, offsets, parts = zip(*lot)
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(x) for x in parts])
    return np.array(numbers), np.array(offsets), data, ends


def _bytes_of(column) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def all_stretches(docs: DataFrame) -> DataFrame:
    """Every stretch of every document; places count from the document's start."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                texts, doc_keys = _bytes_of(part.column(0)), part.column(1).to_numpy()
                for numbers, offsets, data, ends in _joined(texts):
                    starts = np.r_[0, ends[:-1]] - offsets
                    keys = doc_keys[numbers]
                    doc, at, first, last, hashes = stretches(data, ends)
                    whole = memoryview(data)
                    kinds = [
                        _signed(xxhash.xxh3_64_intdigest(whole[a : b + LENGTH], c - a))
                        for a, b, c in zip(first.tolist(), last.tolist(), at.tolist())
                    ]
                    base = starts[doc]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[doc]),
                            pa.array(hashes.view(np.int64)),
                            pa.array(kinds, pa.int64()),
                            pa.array((first - base).astype(np.int32)),
                            pa.array((last - base).astype(np.int32)),
                            pa.array((at - base).astype(np.int32)),
                        ],
                        [x.split()[0] for x in STRETCHES.split(", ")],
                    )

    return with_key(docs).select("text", "doc_key").mapInArrow(find, STRETCHES)


def with_key(docs: DataFrame) -> DataFrame:
    """Documents with one number for their id and text; rows that share both share it."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return plain.withColumn("doc_key", F.xxhash64("doc_id", "text"))


def _small_lists(frame: DataFrame, name: str) -> DataFrame:
    """Marked for broadcast where all lists of a column have ``MOST_ITEMS`` at most."""
    items = frame.agg(F.coalesce(F.sum(F.size(name)), F.lit(0))).head()[0]
    return F.broadcast(frame) if items <= MOST_ITEMS else frame


WANTED = "anchor long, doc_key long, first int, last int, at int, single boolean, data binary"


def _cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted stretches.  ``wanted``: ``doc_key`` and its ``parts``.

    Rows that share a key have the same text: a task cuts out the first of them only.
    """
    names = [x.split()[0] for x in WANTED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for text, parts in zip(_bytes_of(part.column(0)), part.column(1).to_pylist()):
                    if parts[0]["doc_key"] in done:
                        continue
                    done.add(parts[0]["doc_key"])
                    for p in parts:
                        rows.append((p["anchor"], p["doc_key"], p["first"], p["last"], p["at"], p["single"], text[p["first"] : p["last"] + LENGTH]))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return with_key(docs).join(_small_lists(wanted, "parts"), "doc_key").select("text", "parts").mapInArrow(cut, WANTED)


SPANS = "doc_key long, first int, last int"


def _sorted_repeats(cuts: DataFrame) -> DataFrame:
    """Repeated strings of stretches, by suffix order within lots of whole groups."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, anchor, seen = [], 0, None, set()
        for row in (row for batch in batches for row in _rows(batch)):
            if row["anchor"] != anchor:
                anchor, seen = row["anchor"], set()
                if size >= SORT_BYTES:
                    yield _repeats_of(held)
                    held, size = [], 0
            # Tasks may have cut out the same stretch of rows with one key.
            place = (row["doc_key"], row["first"])
            if place in seen:
                continue
            seen.add(place)
            held.append(row)
            size += len(row["data"]) + 1
        yield _repeats_of(held)

    return (
        cuts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(order, SPANS)
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, some hundred at a time as Python objects."""
    for lo in range(0, batch.num_rows, 512):
        yield from batch.slice(lo, 512).to_pylist()


def _repeats_of(rows: list[dict]) -> pa.RecordBatch:
    keys, firsts, lasts = [], [], []
    if rows:
        sizes = np.array([len(r["data"]) + 1 for r in rows])
        data = np.frombuffer(b"".join(r["data"] + b"\0" for r in rows), np.uint8)
        starts = np.cumsum(sizes) - sizes
        text = data.astype(np.int64) + 2
        text[starts + sizes - 1] = 1
        valid = np.zeros(len(data), bool)
        for start, row in zip(starts, rows):
            valid[start : start + row["last"] - row["first"] + 1] = True
        found = repeated_places(text, suffix_array(text), valid, LENGTH)
        for start, row in zip(starts, rows):
            if row["single"]:
                hits = found[start : start + row["last"] - row["first"] + 1]
                _runs(hits, row, keys, firsts, lasts)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32())],
        ["doc_key", "first", "last"],
    )


def _runs(hits: np.ndarray, row: dict, keys: list, firsts: list, lasts: list) -> None:
    edges = np.flatnonzero(np.diff(np.r_[False, hits, False].astype(np.int8)))
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
        keys.append(row["doc_key"])
        firsts.append(row["first"] + lo)
        lasts.append(row["first"] + hi - 1)


def _banded(cuts: DataFrame) -> DataFrame:
    """Stretches cut into bands, each under the bytes that all its strings share."""
    names = [x.split()[0] for x in WANTED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = []
                for r in batch.slice(lo, 512).to_pylist():
                    # Bands are laid from the anchor, so equal strings share theirs.
                    first, last, at, data = r["first"], r["last"], r["at"], r["data"]
                    low = (first - at) // BAND
                    for band in range(low, (last - at) // BAND + 1):
                        start = at + band * BAND
                        a, b = max(first, start), min(last, start + BAND - 1)
                        shared = data[start + BAND - 1 - first : start + LENGTH - first]
                        key = xxhash.xxh3_64_intdigest(shared, band & 0xFFFF)
                        rows.append((_signed(key), r["doc_key"], a, b, at, r["single"], data[a - first : b - first + LENGTH]))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return cuts.mapInArrow(cut, WANTED)


def _banded_repeats(cuts: DataFrame) -> DataFrame:
    """Repeated strings of stretches whose anchor too many share."""
    cuts = cuts.dropDuplicates(["anchor", "doc_key", "first"])
    bands = written(_banded(cuts), "repeat-bands")
    sizes = written(
        bands.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
        "repeat-band-sizes",
    )
    few = small_side(sizes.where(F.col("n") <= MOST_KINDS).select("anchor"))
    many = small_side(sizes.where(F.col("n") > MOST_KINDS).select("anchor"))
    return _sorted_repeats(bands.join(few, "anchor", "left_semi")).unionByName(
        _digested_repeats(bands.join(many, "anchor", "left_semi"))
    )


def _digested_repeats(cuts: DataFrame) -> DataFrame:
    """Repeated strings of stretches, each string by a digest of its own."""
    kind = "high long, low long, doc_key long, place int, single boolean"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512).to_pylist()
                data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
                counts = np.array([r["last"] - r["first"] + 1 for r in rows])
                starts = np.cumsum([0] + [len(r["data"]) for r in rows[:-1]])
                inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                places = np.repeat(starts, counts) + inside
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rolled(data, LENGTH, 1)[places].view(np.int64)),
                        pa.array(rolled(data, LENGTH, 257)[places].view(np.int64)),
                        pa.array(np.repeat(np.array([r["doc_key"] for r in rows]), counts)),
                        pa.array((np.repeat(np.array([r["first"] for r in rows]), counts) + inside).astype(np.int32)),
                        pa.array(np.repeat(np.array([r["single"] for r in rows]), counts)),
                    ],
                    [x.split()[0] for x in kind.split(", ")],
                )

    strings = written(cuts.mapInArrow(digest, kind), "repeat-digests")
    again = strings.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        strings.where("single")
        .join(again.select("high", "low"), ["high", "low"], "left_semi")
        .select("doc_key", F.col("place").alias("first"), F.col("place").alias("last"))
    )


def _of_kinds(every: DataFrame, kinds: DataFrame) -> DataFrame:
    """Stretches of the given kinds, ``anchor``, ``kind`` and their number ``n`` of rows.

    Kinds that fit are broadcast.  Else those of ``HOT_ROWS`` rows and more are: there is
    one for so many stretches at most.  What is left to a shuffle holds no hot key.
    """
    keys = ["anchor", "kind"]
    if kinds.count() <= BROADCAST_ROWS:
        return every.join(F.broadcast(kinds.select(keys)), keys, "left_semi")
    hot = small_side(kinds.where(F.col("n") >= HOT_ROWS).select(keys))
    rest = kinds.where(F.col("n") < HOT_ROWS).select(keys)
    return every.join(hot, keys, "left_semi").unionByName(
        every.join(hot, keys, "left_anti").join(rest, keys, "left_semi")
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_key``, ``first`` and ``last`` place of strings that occur more than once."""
    every = written(all_stretches(docs), "stretches")
    one = F.min(F.struct("doc_key", "first", "last", "at")).alias("one")
    kinds = every.groupBy("anchor", "kind").agg(F.count(F.lit(1)).alias("n"), one)
    anchors = kinds.groupBy("anchor").agg(
        F.sum("n").alias("anchor_n"), F.count(F.lit(1)).alias("anchor_kinds")
    )
    shared = written(
        kinds.join(anchors.where("anchor_n > 1"), "anchor").select(
            "anchor", "kind", "n", "one.*", "anchor_kinds"
        ),
        "repeat-kinds",
    )
    whole = _of_kinds(every, shared.where("n > 1").select("anchor", "kind", "n"))
    asked = written(
        shared.where("anchor_kinds > 1")
        .groupBy("doc_key")
        .agg(
            F.collect_list(
                F.struct(
                    "anchor", "doc_key", "first", "last", "at", (F.col("n") == 1).alias("single")
                )
            ).alias("parts")
        ),
        "stretches-wanted",
    )
    cuts = written(_cut_out(docs, asked), "stretch-bytes")
    hot = small_side(
        shared.where(F.col("anchor_kinds") > MOST_KINDS).select("anchor").distinct()
    )
    return (
        whole.select("doc_key", "first", "last")
        .unionByName(_sorted_repeats(cuts.join(hot, "anchor", "left_anti")))
        .unionByName(_banded_repeats(cuts.join(hot, "anchor", "left_semi")))
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """Whole texts as UTF-8 bytes without what repeats.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored, a null text
    counts as empty.  A byte goes if a string of ``LENGTH`` bytes that covers it also
    starts anywhere else, in the same document or another; strings never cross
    documents and are judged on the input.  Rows that repeat a ``doc_id`` or have none
    are documents of their own, so equal long ones remove each other.

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary).
    """
    # A set, made in each task first: rows that share a key bring the same spans.
    lists = (
        repeated_spans(docs)
        .groupBy("doc_key")
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    )
    spans = written(lists.mapInArrow(_merged, lists.schema), "repeat-spans")
    keyed = with_key(docs).join(_small_lists(spans, "spans"), "doc_key", "left")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = _bytes_of(part.column(1))
                out = [_removed(t, s) for t, s in zip(texts, part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([x[0] for x in out], pa.int64()),
                        pa.array([x[1] for x in out], pa.int64()),
                        pa.array([x[2] for x in out], pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return keyed.select("doc_id", "text", "spans").mapInArrow(remove, result)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans whose bytes touch, as one."""
    for batch in batches:
        out = []
        for spans in batch.column(1).to_pylist():
            merged: list[dict] = []
            for span in sorted(spans, key=lambda s: s["first"]):
                if merged and span["first"] <= merged[-1]["last"] + LENGTH:
                    merged[-1]["last"] = max(merged[-1]["last"], span["last"])
                else:
                    merged.append(span)
            out.append(merged)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, batch.schema.field(1).type)], batch.schema.names
        )


def _removed(text: bytes, spans: list[dict] | None) -> tuple[int, int, bytes]:
    if not spans:
        return 0, 0, text
    kept, at, runs, end = [], 0, 0, -1
    for lo, hi in sorted((s["first"], s["last"] + LENGTH) for s in spans):
        if lo > end:
            kept.append(text[at:lo])
            runs += 1
        end = at = max(end, hi)
    left = b"".join([*kept, text[at:]])
    return len(text) - len(left), runs, left

