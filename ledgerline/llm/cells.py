"""Comparing all rows of a group, however large, in bounded cells.

A group of up to ``block`` rows is one cell.  A larger one is dealt into ``g`` parts by
a hash of the row's id, and every pair of parts is a cell of its own: no task ever holds
more than two parts, and the work of one hot group spreads over ``g * (g + 1) / 2``
cells.  Cells give counts and spanning links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_side

CELL = ("cell_key", "cell_i", "cell_j")
PAIRS_AT_ONCE = 1 << 15
ROWS_AT_ONCE = 4096


def spread(rows: DataFrame, key: str, id_column: str, parts: DataFrame) -> DataFrame:
    """``rows`` once per cell they belong to, cells together and in order.

    ``parts`` has the ``key`` and the number ``g`` of parts of groups with more than
    one; ``cell_side`` tells the two parts of a cell apart.
    """
    g = F.coalesce(F.col("g"), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), id_column), F.col("g")).cast("int")
    return (
        rows.join(small_side(parts), key, "left")
        .withColumn("g", g)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        .withColumn("cell_key", F.col(key))
        .withColumn("cell_i", F.least("own", "other"))
        .withColumn("cell_j", F.greatest("own", "other"))
        .withColumn("cell_side", (F.col("own") != F.col("cell_i")).cast("int"))
        .drop("g", "own", "other")
        .repartition(*CELL)
        .sortWithinPartitions(*CELL)
    )


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole cells, cut where a cell ends once enough rows are there."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < ROWS_AT_ONCE:
            continue
        table = pa.Table.from_batches(held)
        starts = cell_starts(table)
        last = int(starts[-1])
        if last:
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
            count -= last
    if count:
        yield pa.Table.from_batches(held)


def cell_starts(table: pa.Table) -> np.ndarray:
    """Row numbers at which a cell begins."""
    columns = [table.column(name).to_numpy() for name in CELL]
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for values in columns:
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def first_rows(table: pa.Table, id_column: str) -> np.ndarray:
    """Which rows are the first of their id in their cell; input rows may be repeated."""
    starts = cell_starts(table)
    cell = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, table.num_rows]))
    ids = table.column(id_column).to_numpy()
    order = np.lexsort((np.arange(len(ids)), ids, cell))
    first = np.ones(len(ids), bool)
    again = (ids[order][1:] == ids[order][:-1]) & (cell[order][1:] == cell[order][:-1])
    first[order[1:][again]] = False
    return first


def pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows to compare, in pieces of bounded size.

    Within a cell of one part all pairs, else those between its two parts.
    """
    starts = cell_starts(table)
    ends = np.r_[starts[1:], table.num_rows]
    sizes = ends - starts
    side = table.column("cell_side").to_numpy()
    mixed = table.column("cell_i").to_numpy() != table.column("cell_j").to_numpy()
    small = sizes <= 32
    # Small cells together: rows that stand ``gap`` apart in the same cell.
    cell = np.repeat(np.arange(len(starts)), sizes)
    rows = np.flatnonzero(small[cell])
    for gap in range(1, int(sizes[small].max(initial=1))):
        rows = rows[rows + gap < ends[cell[rows]]]
        for at in range(0, len(rows), PAIRS_AT_ONCE):
            a = rows[at : at + PAIRS_AT_ONCE]
            b = a + gap
            fits = ~mixed[a] | (side[a] != side[b])
            yield a[fits], b[fits]
    for lo, hi in zip(starts[~small], ends[~small]):
        whole = np.arange(lo, hi)
        left = whole[side[lo:hi] == 0] if mixed[lo] else whole
        right = whole[side[lo:hi] == 1] if mixed[lo] else whole
        if not len(left) or not len(right):
            continue
        step = max(1, PAIRS_AT_ONCE // len(right))
        for at in range(0, len(left), step):
            a = np.repeat(left[at : at + step], len(right))
            b = np.tile(right, len(left[at : at + step]))
            if not mixed[lo]:
                a, b = a[a < b], b[a < b]
            yield a, b


class Links:
    """Links found among the rows of a table: counts per row and connected parts."""

    def __init__(self, rows: int):
        self.counts = np.zeros(rows)
        self.labels = np.arange(rows)

    def add(self, a: np.ndarray, b: np.ndarray, weights: np.ndarray | None = None):
        if not len(a):
            return
        if weights is not None:
            n = len(self.counts)
            self.counts += np.bincount(a, weights[b], n) + np.bincount(b, weights[a], n)
        labels = self.labels
        while True:
            la, lb = labels[a], labels[b]
            apart = la != lb
            if not apart.any():
                return
            low = np.minimum(la, lb)[apart]
            np.minimum.at(labels, la[apart], low)
            np.minimum.at(labels, lb[apart], low)
            while True:
                up = labels[labels]
                if (up == labels).all():
                    break
                labels[:] = up

    def found(self, ids: np.ndarray) -> pa.RecordBatch:
        """Rows with a link: id, weight of what it links with, an id of its part."""
        linked = np.flatnonzero((self.counts > 0) | (self.labels != np.arange(len(ids))))
        heads = np.unique(self.labels[linked])
        rows = np.union1d(linked, heads)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[rows], pa.int64()),
                pa.array(self.counts[rows].astype(np.int64), pa.int64()),
                pa.array(ids[self.labels[rows]], pa.int64()),
            ],
            ["id", "n_links", "head"],
        )


FOUND = "id long, n_links long, head long"


def compared(
    cells: DataFrame, judge: Callable[[pa.Table, Links], None], id_column: str
) -> DataFrame:
    """``judge`` applied to whole cells; one row per cell and row with a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            links = Links(table.num_rows)
            judge(table, links)
            yield links.found(table.column(id_column).to_numpy())

    return cells.mapInArrow(run, FOUND)
