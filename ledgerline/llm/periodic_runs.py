"""Runs: stretches of words that repeat with a period, and texts without their echoes.

A run with smallest period ``q`` is at least ``MIN_PERIODS`` periods long, so one of the
grid places ``0, q, 2q, ...`` lies in its first period, and the next one in it as well.
For every ``q`` the pairs of neighbouring grid places are looked at, ``n ln n`` pairs for
``n`` words in all; where both words agree, their common extensions to the right and to
the left (``lce``: difference-cover samples and range minima) give the whole stretch.  A
stretch that is met with a multiple of its period, or from a later grid place, is the
same one and counts once, with the smallest period.

Each text is a unit of work; short ones are joined to lots, so that one set of arrays
serves many texts.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import whole_text
from ledgerline.llm.lce import Extensions
from ledgerline.llm.words import drop_mask, texts_of, words_of

MIN_WORDS = 12
MIN_PERIODS = 2
LOT_WORDS = 1 << 16
PAIRS = 1 << 19
RESULT = (
    "doc_id long, n_words long, "
    "runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


class _Ids(dict):
    """Words numbered from 1 as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = made = len(self) + 1
        return made


def joined(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts as numbers, each text closed by a number of its own, and where
    the texts begin."""
    ids = _Ids()
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.zeros(int(sizes.sum()) + len(texts), np.int64)
    for at, words in zip(starts.tolist(), texts):
        data[at : at + len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    data[starts + sizes] = len(ids) + 1 + np.arange(len(texts))
    return data, starts


def _grid(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Neighbouring grid places: the left one and the period, some ``PAIRS`` at a time."""
    halves = sizes // MIN_PERIODS
    doc = np.repeat(np.arange(len(sizes)), halves)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    counts = (sizes[doc] - 1) // period
    upto = np.cumsum(counts)
    lo = 0
    while lo < len(doc):
        done = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        part = counts[lo:hi]
        q = np.repeat(period[lo:hi], part)
        base = np.repeat(starts[doc[lo:hi]], part)
        step = np.arange(len(q)) - np.repeat(np.cumsum(part) - part, part)
        yield base + step * q, q
        lo = hi


def runs_in(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Runs of joined texts as rows of start, end and period, in order.

    Places count within ``data``; ends are the places behind the last words.
    """
    n = len(data)
    sizes = np.diff(np.r_[starts, n]) - 1
    ahead = behind = None
    found = []
    for i, q in _grid(sizes, starts):
        same = data[i] == data[i + q]
        i, q = i[same], q[same]
        if not len(i):
            continue
        if ahead is None:
            ahead, behind = Extensions(data), Extensions(data[::-1])
        right = ahead.of(i, i + q)
        # From the first grid place of a run, less than a period lies to the left.
        far = right >= np.maximum(1, MIN_WORDS + 1 - 2 * q)
        i, q, right = i[far], q[far], right[far]
        left = behind.of(n - i - q, n - i)
        good = (left < q) & (right + left + q >= np.maximum(MIN_WORDS, MIN_PERIODS * q))
        i, q, right, left = i[good], q[good], right[good], left[good]
        found.append(np.column_stack([i - left, i + q + right, q]))
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)][: len(runs)]
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _lots(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    lot, size = [], 0
    for text in texts:
        words = words_of(text)
        if lot and size + len(words) > LOT_WORDS:
            yield lot
            lot, size = [], 0
        lot.append(words)
        size += len(words) + 1
    if lot:
        yield lot


def _told(lot: list[list[bytes]]) -> Iterator[tuple[int, list[dict], bytes]]:
    """Number of words, runs and collapsed text of each text."""
    data, starts = joined(lot)
    runs = runs_in(data, starts)
    edges = np.searchsorted(runs[:, 0], np.r_[starts, len(data)])
    for at, words, lo, hi in zip(starts.tolist(), lot, edges[:-1].tolist(), edges[1:].tolist()):
        kept = words
        if hi > lo:
            firsts = runs[lo:hi, 0] - at
            echoes = drop_mask(len(words), firsts + runs[lo:hi, 2], runs[lo:hi, 1] - at)
            kept = [w for w, echo in zip(words, echoes.tolist()) if not echo]
        rows = [
            {"start": start - at, "length": end - start, "period": period}
            for start, end, period in runs[lo:hi].tolist()
        ]
        yield len(words), rows, b" ".join(kept)


def runs(docs: DataFrame) -> DataFrame:
    """The runs of every whole text, and the text without their repetitions.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored, a null text is
    one without words.  Rows that repeat an id, or have none, are texts of their own.

    Returns one row per text: ``doc_id``, ``n_words``, ``runs`` (``start``, ``length`` and
    ``period`` in words, by start and period) and ``collapsed``, the words joined by one
    space without those that some run holds after its first period.
    """
    kind = pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                out = [x for lot in _lots(texts_of(part.column(1))) for x in _told(lot)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([x[0] for x in out], pa.int64()),
                        pa.array([x[1] for x in out], kind),
                        pa.array([x[2] for x in out], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return plain.mapInArrow(find, RESULT)


def longest(runs_column: str = "runs"):
    """The longest run of a list of runs (ties: smallest start, then period), or null."""
    keyed = F.transform(
        runs_column,
        lambda r: F.struct(
            (-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")
        ),
    )
    return F.array_min(keyed)
