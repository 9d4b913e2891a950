"""Removal of passages of words that occur more than once, by seeds and extension.

1. Seeds.  Of the runs of ``SEED`` words within any window of ``WINDOW`` words, the one
   with the smallest hash (the first of equal ones) is the window's anchor, so equal
   windows have equal anchors at the same place.  A document's windows with one anchor lie
   a word apart; together they are a piece.
2. Join on anchors.  Pieces with an anchor of their own are done: nothing repeats.  Pieces
   that are equal as a whole repeat in every window and need no look at their words.  Both
   are told by counts with partial aggregation, so copies are not gathered.
3. Extension.  Of the other pieces one of each kind is laid beside those that share its
   anchor, and all of them are extended at once, word by word, to the right and to the
   left: a step parts the places whose words differ.  A window repeats where another place
   is still in its class at both of the window's ends.  This takes as long as the pieces
   are, never as long as their pairs.
4. An anchor with more than ``MOST_KINDS`` kinds, such as a very common phrase, has no task
   to itself: its pieces are cut in parts of 16 windows, and what all windows of a part
   share, a longer seed, becomes the part's anchor.  Parts go through the same counts, and
   are cut in halves while their anchor is still that common; a part of a single window is
   its own anchor and has one kind.
5. Windows that repeat in a row are one repeat; overlapping ones are joined, and the words
   they cover go.

Words, seeds and kinds are 64-bit hashes; two pieces are one kind where both the hash of
the anchor and that of all their words agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import whole_text, written
from ledgerline.llm.repeats import first_smallest
from ledgerline.llm.words import drop_mask, numbers_of, texts_of, words_of

WINDOW = 35
SEED = 8
REACH = WINDOW - SEED  # how far before its anchor a window may start
MOST_KINDS = 64
MOST_ITEMS = 1_500_000  # of lists that are broadcast, some 64 bytes each
EXTEND_ROWS = 8192
# ``first`` to ``last``: places where windows start; ``at``: the anchor's place.
PIECES = "row long, anchor long, kind long, first int, last int, at int"
# ``single``: the only piece of its kind; ``common``: too many kinds have its anchor.
CUTS = f"{PIECES}, single boolean, common boolean, words binary"
PARTS = f"{PIECES}, single boolean, words binary"
SPANS = "row long, first int, last int"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeds_of(words: np.ndarray) -> np.ndarray:
    """A hash of the ``SEED`` words from each place on, by doubling."""
    h, span = words, 1
    while span < SEED:
        h = _mixed(h[:-span] * _ODD + h[span:])
        span *= 2
    return h


def pieces_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, place and hash of each anchor of a document's words."""
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    seeds = seeds_of(words)
    # The place breaks ties, so the first of equal seeds is taken.
    keys = (seeds >> np.uint64(32) << np.uint64(32)) | np.arange(len(seeds), dtype=np.uint64)
    at = (first_smallest(keys, REACH + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    firsts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    lasts = np.r_[firsts[1:], len(at)] - 1
    return firsts, lasts, at[firsts], seeds[at[firsts]]


def kind_of(words: memoryview, first: int, last: int, at: int) -> int:
    """A hash of all words of a piece and of where its anchor is."""
    return _signed(
        xxhash.xxh3_64_intdigest(words[8 * first : 8 * (last + WINDOW)], at - first)
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (one number per row), ``doc_id`` and whole ``text``, written once."""
    return written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            whole_text().alias("text"),
        ),
        "passage-texts",
    )


def all_pieces(texts: DataFrame) -> DataFrame:
    """Every piece of every document."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                made: list[list] = [[], [], [], [], [], []]
                for row, text in zip(part.column(0).to_pylist(), texts_of(part.column(1))):
                    words = numbers_of(words_of(text))
                    firsts, lasts, ats, anchors = pieces_of(words)
                    raw = memoryview(words.tobytes())
                    spots = zip(firsts.tolist(), lasts.tolist(), ats.tolist())
                    kinds = [kind_of(raw, *spot) for spot in spots]
                    values = (np.full(len(kinds), row), anchors.view(np.int64), kinds, firsts, lasts, ats)
                    for column, value in zip(made, values):
                        column.append(np.asarray(value, np.int64))
                yield _batch(PIECES, [np.concatenate(c) for c in made])

    return texts.select("row", "text").mapInArrow(find, PIECES)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    arrays = [
        pa.array(column.astype(np.int32) if kind == "int" and isinstance(column, np.ndarray) else column, _TYPES[kind])
        for column, (_, kind) in zip(columns, fields)
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def counted(pieces: DataFrame, *more: str) -> DataFrame:
    """Kinds of anchors that occur more than once: how often, one piece of each, and how
    many kinds their anchor has."""
    one = F.min(F.struct("row", "first", "last", "at", *more)).alias("one")
    kinds = pieces.groupBy("anchor", "kind").agg(F.count(F.lit(1)).alias("n"), one)
    anchors = kinds.groupBy("anchor").agg(
        F.sum("n").alias("pieces"), F.count(F.lit(1)).alias("kinds")
    )
    return kinds.join(anchors.where("pieces > 1"), "anchor").select(
        "anchor", "kind", "n", "one.*", "kinds"
    )


def small_lists(frame: DataFrame, name: str) -> DataFrame:
    """Marked for broadcast where all lists of a column have ``MOST_ITEMS`` at most."""
    items = frame.agg(F.coalesce(F.sum(F.size(name)), F.lit(0))).head()[0]
    return F.broadcast(frame) if items <= MOST_ITEMS else frame


def cut_out(texts: DataFrame, kinds: DataFrame) -> DataFrame:
    """The words' numbers of one piece of each kind that has to be extended."""
    single, common = (F.col("n") == 1).alias("single"), (F.col("kinds") > MOST_KINDS).alias("common")
    spot = F.struct("anchor", "kind", "first", "last", "at", single, common)
    asked = written(
        kinds.where("kinds > 1").groupBy("row").agg(F.collect_list(spot).alias("spots")),
        "passage-spots",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                columns = part.column(0).to_pylist(), texts_of(part.column(1)), part.column(2).to_pylist()
                for row, text, spots in zip(*columns):
                    raw = memoryview(numbers_of(words_of(text)).tobytes())
                    for s in spots:
                        data = bytes(raw[8 * s["first"] : 8 * (s["last"] + WINDOW)])
                        rows.append((row, *s.values(), data))
                yield _batch(CUTS, list(zip(*rows)) or [()] * 9)

    joined = texts.select("row", "text").join(small_lists(asked, "spots"), "row")
    return joined.select("row", "text", "spots").mapInArrow(cut, CUTS)


def classes(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each column of ``words``: class of each row by its group and all columns so
    far.  Rows in one class agree word by word."""
    made = np.empty(words.shape, np.int64)
    label = group
    for j in range(words.shape[1]):
        word = words[:, j]
        order = np.lexsort((word, label))
        new = np.zeros(len(order), np.int64)
        new[1:] = (label[order][1:] != label[order][:-1]) | (word[order][1:] != word[order][:-1])
        label = np.empty(len(order), np.int64)
        label[order] = np.cumsum(new)
        made[:, j] = label
    return made


def repeats_of(group: np.ndarray, rows: list[dict]) -> np.ndarray:
    """Which windows of pieces occur in another piece of their group.

    Column ``j`` of the result stands for the window ``REACH - j`` words before the anchor.
    """
    wide = REACH + WINDOW
    words = np.zeros((len(rows), wide), np.uint64)
    for n, row in enumerate(rows):
        data = np.frombuffer(row["words"], np.uint64)
        start = REACH + row["first"] - row["at"]
        words[n, start : start + len(data)] = data
    # From the anchor to the right, and from the word before it to the left.
    right = classes(words[:, REACH:], group)
    left = classes(words[:, :REACH][:, ::-1], group)
    firsts = np.array([REACH + r["first"] - r["at"] for r in rows])
    lasts = np.array([REACH + r["last"] - r["at"] for r in rows])
    found = np.zeros((len(rows), REACH + 1), bool)
    for j in range(REACH + 1):
        valid = np.flatnonzero((firsts <= j) & (j <= lasts))
        back = left[valid, REACH - 1 - j] if j < REACH else group[valid]
        ahead = right[valid, j + WINDOW - 1 - REACH]
        order = np.lexsort((ahead, back))
        back, ahead = back[order], ahead[order]
        same = (back[1:] == back[:-1]) & (ahead[1:] == ahead[:-1])
        both = np.r_[same, False] | np.r_[False, same]
        found[valid[order[both[: len(order)]]], j] = True
    return found


def _spans_of(group: list[int], rows: list[dict]) -> pa.RecordBatch:
    out = []
    if rows:
        found = repeats_of(np.array(group, np.int64), rows)
        for row, hits in zip(rows, found):
            if row["single"]:
                edges = np.flatnonzero(np.diff(np.r_[False, hits, False].astype(np.int8)))
                base = row["at"] - REACH
                out += [(row["row"], base + lo, base + hi - 1) for lo, hi in edges.reshape(-1, 2).tolist()]
    return _batch(SPANS, list(zip(*out)) or [()] * 3)


def extended(cuts: DataFrame) -> DataFrame:
    """Windows that repeat, of pieces that are the only ones of their kind."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, groups, anchor, number = [], [], None, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                for row in batch.slice(lo, 4096).to_pylist():
                    if row["anchor"] != anchor:
                        anchor, number = row["anchor"], number + 1
                        if len(held) >= EXTEND_ROWS:
                            yield _spans_of(groups, held)
                            held, groups = [], []
                    held.append(row)
                    groups.append(number)
        yield _spans_of(groups, held)

    return cuts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(extend, SPANS)


def parted(cuts: DataFrame, size: int) -> DataFrame:
    """Pieces cut in parts of ``size`` windows, each under the words that all its windows
    share.

    Parts are laid from ``REACH`` places before the anchor, so equal windows of any two
    pieces of an anchor come to parts with equal anchors.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                rows = []
                for r in batch.slice(lo, 2048).to_pylist():
                    raw, base = memoryview(r["words"]), r["at"] - REACH
                    for part in range((r["first"] - base) // size, (r["last"] - base) // size + 1):
                        low = base + part * size
                        high = low + size - 1
                        first, last = max(low, r["first"]), min(high, r["last"])
                        shared = raw[8 * (high - r["first"]) : 8 * (low + WINDOW - r["first"])]
                        anchor = _signed(xxhash.xxh3_64_intdigest(shared, part * REACH + size))
                        data = raw[8 * (first - r["first"]) : 8 * (last + WINDOW - r["first"])]
                        kind = _signed(xxhash.xxh3_64_intdigest(data, first - low))
                        rows.append((r["row"], anchor, kind, first, last, r["at"], r["single"], bytes(data)))
                yield _batch(PARTS, list(zip(*rows)) or [()] * 8)

    return cuts.mapInArrow(cut, PARTS)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``row``, ``first`` and ``last`` place of windows that occur more than once."""
    every = written(all_pieces(texts), "passage-pieces")
    kinds = written(counted(every), "passage-kinds")
    copies = kinds.where("n > 1").select("anchor", "kind")
    spans = every.join(copies, ["anchor", "kind"], "left_semi").select("row", "first", "last")
    cuts = written(cut_out(texts, kinds), "passage-words")
    size = 16
    while True:
        spans = spans.unionByName(extended(cuts.where("not common")))
        common = cuts.where("common")
        if common.isEmpty():
            return spans
        parts = written(parted(common, size), "passage-parts")
        kinds = written(counted(parts, "single", "words"), "passage-part-kinds")
        copies = kinds.where("n > 1").select("anchor", "kind")
        whole = parts.where("single").join(copies, ["anchor", "kind"], "left_semi")
        spans = spans.unionByName(whole.select("row", "first", "last"))
        cuts = kinds.where("kinds > 1").select(
            *(field.split()[0] for field in PIECES.split(", ")),
            (F.col("single") & (F.col("n") == 1)).alias("single"),
            (F.col("kinds") > MOST_KINDS).alias("common"),
            "words",
        )
        size //= 2


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats whose words touch, as one."""
    for batch in batches:
        out = []
        for spans in batch.column(1).to_pylist():
            merged: list[dict] = []
            for span in sorted(spans, key=lambda s: s["first"]):
                if merged and span["first"] <= merged[-1]["last"] + WINDOW:
                    merged[-1]["last"] = max(merged[-1]["last"], span["last"])
                else:
                    merged.append(span)
            out.append(merged)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, batch.schema.field(1).type)], batch.schema.names
        )


def without_passages(docs: DataFrame) -> DataFrame:
    """Whole texts without passages of ``WINDOW`` words or more that occur elsewhere.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored, a null text is one
    without words.  A word goes if a window of ``WINDOW`` words that covers it also starts
    anywhere else, in the same document or another; windows are judged on the input.  Rows
    that repeat a ``doc_id`` or have none are documents of their own, so equal long ones
    remove each other.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``n_spans`` (removed stretches) and
    ``kept``, the words left joined by one space.
    """
    texts = numbered(docs)
    lists = (
        repeated_spans(texts)
        .groupBy("row")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    spans = written(lists.mapInArrow(_merged, lists.schema), "passage-spans")
    joined = texts.join(small_lists(spans, "spans"), "row", "left")
    result = "doc_id long, n_words long, n_removed long, n_spans long, kept string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = []
                for text, spans in zip(texts_of(part.column(1)), part.column(2).to_pylist()):
                    words = words_of(text)
                    kept = words
                    if spans:
                        ends = [s["last"] + WINDOW for s in spans]
                        gone = drop_mask(len(words), [s["first"] for s in spans], ends)
                        kept = [w for w, g in zip(words, gone.tolist()) if not g]
                    out.append((len(words), len(words) - len(kept), len(spans or ()), b" ".join(kept)))
                n_words, n_removed, n_spans, kept = zip(*out) if out else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(n_spans, pa.int64()),
                        pa.array(kept, pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "n_spans", "kept"],
                )

    return joined.select("doc_id", "text", "spans").mapInArrow(remove, result)
