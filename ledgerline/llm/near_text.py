"""Documents linked by the Jaccard similarity of their word shingles.

Chosen-path join.  Each distinct shingle set is embedded as ``COORDINATES`` minhash
values; value and position together are a token that two sets share with probability
equal to their similarity.  Per run, every node of a tree of sets draws each position
with probability ``1 / (similarity * COORDINATES)``, and the sets that share the drawn
token go on to the same child.  A node of up to ``SMALL`` sets is compared by brute
force; a larger one is split again, ``DEPTH`` times at most, and what is still large
then is compared by brute force in bounded cells.  Runs are repeated until a pair at
the threshold is met with probability ``recall``.

Pairs met are screened on their minhash values, far below the threshold, and only
join sets into clusters; what the screen may lose counts against ``recall``.  All pairs
of a cluster whose sizes allow a link are then judged on their whole shingle sets, each
pair in one cell, so links within clusters and their counts are exact.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import cells
from ledgerline.llm.common import (
    components,
    kept_in_worker,
    small_side,
    whole_text,
    written,
)

WORDS = 5
COORDINATES = 64
SMALL = 256
DEPTH = 3
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
SEED = 20_240_607
MOST_WORDS = 300_000
SCREEN_ERRORS = 4.0
SETS = "doc_id long, set_id long, n_shingles long, minhash binary"
_ODD = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Words(dict):
    """Hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words.

    Words are separated by ASCII white space.  A text of fewer words is one shingle; a
    text without words has none.
    """
    found = text.encode("utf-8", "surrogatepass").split()
    if not found:
        return np.empty(0, np.uint64)
    known = kept_in_worker("word hashes", _Words)
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    span = min(words, len(hashes))
    rolled = np.full(len(hashes) - span + 1, span, np.uint64)
    for n in range(span):
        rolled = rolled * np.uint64(_ODD) + hashes[n : n + len(rolled)]
    return np.unique(_mixed(rolled))


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64)
    return a | np.uint64(1), b


_A, _B = _coefficients()


def minhash(items: np.ndarray) -> np.ndarray:
    """The smallest 32-bit hash of the set under each coordinate's function."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 4096):
        part = items[at : at + 4096]
        low = np.minimum(low, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, hashes = [], [], []
            for text in batch.column(1):
                items = shingles(text.as_py(), words)
                digest = xxhash.xxh3_64_intdigest(items.tobytes())
                ids.append(digest - (1 << 64) if digest >= 1 << 63 else digest)
                counts.append(len(items))
                hashes.append(minhash(items).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(hashes, pa.binary()),
                ],
                ["doc_id", "set_id", "n_shingles", "minhash"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).mapInArrow(embed, SETS)


def run_success(similarity: float, depth: int) -> float:
    """Chance that a pair stays together down to ``depth`` levels of one run."""
    draw = 1 / (similarity * COORDINATES)
    met = 1.0
    for _ in range(depth):
        met = 1 - (1 - draw * similarity * met) ** COORDINATES
    return met


def screen_loss(similarity: float) -> float:
    """Chance that the screen loses a pair at the threshold."""
    most = math.ceil(_screen(similarity) * COORDINATES) - 1
    return sum(
        math.comb(COORDINATES, n) * similarity**n * (1 - similarity) ** (COORDINATES - n)
        for n in range(most + 1)
    )


def runs_needed(similarity: float, recall: float) -> int:
    """Runs after which paths and screen together meet a pair with ``recall``."""
    # The screen sees the same coordinates as the paths, so the two losses add up.
    recall += screen_loss(similarity)
    if recall >= 1:
        raise ValueError("the screen alone loses more than the recall allows")
    return math.ceil(math.log(1 - recall) / math.log(1 - run_success(similarity, DEPTH)))


def _first_paths(sets: DataFrame, similarity: float, runs: int) -> DataFrame:
    """Children of every run's root."""
    draw = random.Random(SEED)
    chosen = [
        (run, position)
        for run in range(runs)
        for position in range(COORDINATES)
        if draw.random() < 1 / (similarity * COORDINATES)
    ]
    marks = np.array([run * COORDINATES + p + 1 for run, p in chosen], np.uint64)
    positions = np.array([position for _, position in chosen], np.int64)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _values(batch.column("minhash"))[:, positions]
            nodes = _mixed(values + _mixed(marks * np.uint64(_ODD))[None, :])
            yield _path_rows(nodes.ravel(), np.repeat(batch.column("set_id"), len(marks)))

    return sets.select("set_id", "minhash").mapInArrow(step, "node long, set_id long")


def _values(column) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<u4").reshape(-1, COORDINATES).astype(np.uint64)


def _path_rows(nodes: np.ndarray, set_ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes.view(np.int64)), pa.array(np.asarray(set_ids), pa.int64())],
        ["node", "set_id"],
    )


def _next_paths(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Children of large nodes: each node draws its own positions."""
    limit = np.uint64(int((1 << 64) / (similarity * COORDINATES)))
    salts = _mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(_ODD))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes = batch.column("node").to_numpy().view(np.uint64)
            draws = _mixed(nodes[:, None] ^ salts[None, :])
            row, position = np.nonzero(draws < limit)
            values = _values(batch.column("minhash"))[row, position]
            children = _mixed(_mixed(draws[row, position]) + values)
            yield _path_rows(children, batch.column("set_id").to_numpy()[row])

    return members.join(sets.select("set_id", "minhash"), "set_id").select(
        "node", "set_id", "minhash"
    ).mapInArrow(step, "node long, set_id long")


def _met(sets: DataFrame, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """Members of the nodes to compare by brute force, and the sizes of large ones."""
    runs = runs_needed(similarity, recall)
    paths = written(_first_paths(sets, similarity, runs), "paths")
    ready, large = None, None
    for level in range(1, DEPTH + 1):
        sizes = written(
            paths.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
            "path-sizes",
        )
        big = sizes.where(F.col("n") > SMALL)
        last = level == DEPTH or not big.head(1)
        done = sizes if last else sizes.where(F.col("n") <= SMALL)
        members = paths.join(done.select("node"), "node")
        ready = members if ready is None else ready.unionByName(members)
        if last:
            large = big
            break
        split = paths.join(small_side(big.select("node")), "node")
        paths = written(_next_paths(split, sets, similarity), "paths")
    return ready, large


def _screen(similarity: float) -> float:
    """Share of equal minhash values below which a pair can't be at the threshold."""
    error = math.sqrt(similarity * (1 - similarity) / COORDINATES)
    return similarity - SCREEN_ERRORS * error


def _short(column) -> np.ndarray:
    """The low byte of each minhash value."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, COORDINATES)


def _of_like_size(counts: np.ndarray, a, b, similarity: float):
    """Pairs whose sizes allow the similarity: a bound that loses none."""
    low = np.minimum(counts[a], counts[b])
    fits = low >= similarity * np.maximum(counts[a], counts[b])
    return a[fits], b[fits]


def _alike(short: np.ndarray, counts: np.ndarray, a, b, similarity: float):
    """Pairs that sizes and minhash values leave open."""
    a, b = _of_like_size(counts, a, b, similarity)
    equal = (short[a] == short[b]).mean(axis=1)
    open_ = equal >= _screen(similarity)
    return a[open_], b[open_]


def _judge_met(similarity: float):
    def judge(table: pa.Table, links: cells.Links) -> None:
        short = _short(table.column("short"))
        counts = table.column("n_shingles").to_numpy()
        for a, b in cells.pairs(table):
            links.add(*_alike(short, counts, a, b, similarity))

    return judge


def _judge_exact(similarity: float):
    def judge(table: pa.Table, links: cells.Links) -> None:
        counts = table.column("n_shingles").to_numpy()
        weights = table.column("n_docs").to_numpy().astype(np.float64)
        items = table.column("items").to_pylist()
        first = cells.first_rows(table, "set_id")
        for a, b in cells.pairs(table):
            a, b = a[first[a] & first[b]], b[first[a] & first[b]]
            a, b = _of_like_size(counts, a, b, similarity)
            if not len(a):
                continue
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
            heads = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            linked = np.zeros(len(a), bool)
            for lo, hi in zip(heads, np.r_[heads[1:], len(a)]):
                own = np.frombuffer(items[a[lo]], "<u8")
                for at in range(lo, hi, 64):
                    others = b[at : min(at + 64, hi)]
                    joined = np.frombuffer(b"".join(items[o] for o in others), "<u8")
                    place = np.searchsorted(own, joined).clip(max=len(own) - 1)
                    sizes = counts[others]
                    starts = np.cumsum(sizes) - sizes
                    shared = np.add.reduceat((own[place] == joined).astype(np.int64), starts)
                    both = len(own) + sizes - shared
                    linked[at : at + len(others)] = shared >= similarity * both
            links.add(a[linked], b[linked], weights)

    return judge


def near_documents(
    docs: DataFrame,
    similarity: float = 0.8,
    words: int = WORDS,
    recall: float = 0.999,
) -> DataFrame:
    """Classes of documents whose shingle sets have Jaccard ``similarity`` or more.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored.  A text with no
    words (or null) links with nothing; one with fewer than ``words`` words is a single
    shingle.  Documents with equal sets link with each other and are compared once.  A
    row without a ``doc_id`` links with nothing and has a null class; rows that repeat a
    ``doc_id`` are documents of their own that share its class id.

    Returns per row ``doc_id``, ``class_id`` (smallest ``doc_id`` reachable by links,
    itself included), ``n_links`` (other documents linked directly) and ``kept`` (it is
    the first of its class).
    """
    every = written(_sets(docs, words), "shingle-sets")
    usable = every.where("n_shingles > 0 and doc_id is not null")
    sets = written(
        usable.groupBy("set_id").agg(
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("n_docs"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("minhash").alias("minhash"),
        ),
        "distinct-sets",
    )
    # The low byte of each 32-bit value is enough for the screen.
    short = F.unhex(F.regexp_replace(F.hex("minhash"), "(..)......", "$1"))
    brief = sets.select("set_id", "n_shingles", short.alias("short"))

    met, large = _met(sets, similarity, recall)
    parts = large.select("node", F.ceil(F.col("n") / BLOCK).alias("g")).where("g > 1")
    spread = cells.spread(met.join(brief, "set_id"), "node", "set_id", parts)
    pairs = cells.compared(spread, _judge_met(similarity), "set_id")
    clusters = written(
        components(pairs.select(F.col("id").alias("a"), F.col("head").alias("b"))),
        "near-clusters",
    )

    wanted = written(
        clusters.join(sets, F.col("node") == F.col("set_id")).select(
            "root", "set_id", "first_id", "n_docs", "n_shingles"
        ),
        "near-wanted",
    )
    weights = wanted.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).alias("g")
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("first_id"), whole_text().alias("text")
    ).join(small_side(wanted), "first_id")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["root", "set_id", "n_docs", "n_shingles"]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                items = [shingles(t.as_py(), words).tobytes() for t in part.column("text")]
                # Rows that repeat a doc_id may hold another text.
                own = [xxhash.xxh3_64_intdigest(x) for x in items]
                sign = [x - (1 << 64) if x >= 1 << 63 else x for x in own]
                right = pa.array([x == y.as_py() for x, y in zip(sign, part.column("set_id"))], pa.bool_())
                out = pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(items, pa.binary())],
                    [*names, "items"],
                )
                yield out.filter(right)

    whole = texts.select(
        "text", "root", "set_id", "n_docs", "n_shingles"
    ).mapInArrow(
        listed,
        "root long, set_id long, n_docs long, n_shingles long, items binary",
    )
    exact = written(
        cells.compared(
            cells.spread(whole, "root", "set_id", weights.where("g > 1")),
            _judge_exact(similarity),
            "set_id",
        ),
        "near-links",
    )
    counts = exact.groupBy("id").agg(F.sum("n_links").alias("n_other"))
    firsts = sets.select("set_id", "first_id", "n_docs")
    heads = components(exact.select(F.col("id").alias("a"), F.col("head").alias("b")))
    in_class = heads.join(firsts, F.col("node") == F.col("set_id"))
    # Of sets with the same first document, one stands for the class.
    class_ids = in_class.groupBy("root").agg(
        F.min(F.struct("first_id", "set_id")).alias("class_first")
    )
    of_set = (
        firsts.join(counts, firsts["set_id"] == counts["id"], "left")
        .join(
            heads.join(class_ids, "root").select("node", "class_first"),
            F.col("set_id") == F.col("node"),
            "left",
        )
        .select(
            "set_id",
            (F.coalesce("n_other", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
            F.coalesce("class_first.first_id", "first_id").alias("class_id"),
            F.coalesce(F.col("class_first.set_id") == F.col("set_id"), F.lit(True)).alias("stands"),
        )
    )
    linked = usable.select("doc_id", "set_id").join(of_set, "set_id")
    alone = every.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("class_id"),
        F.lit(True).alias("stands"),
    )
    return (
        linked.select("doc_id", "n_links", "class_id", "stands")
        .unionByName(alone)
        .select(
            "doc_id",
            "class_id",
            "n_links",
            F.coalesce(
                (F.col("doc_id") == F.col("class_id")) & F.col("stands"), F.lit(True)
            ).alias("kept"),
        )
    )


def one_of_each_class(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_documents`` keeps.

    Rows without a ``doc_id`` stay.  Where an id is repeated, rows with the same text
    are one document.
    """
    kept = written(
        near_documents(docs, similarity).where("kept and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n_rows")),
        "near-kept",
    )
    named = docs.where("doc_id is not null")
    once = named.join(small_side(kept.where("n_rows = 1").select("doc_id")), "doc_id", "left_semi")
    again = named.join(small_side(kept.where("n_rows > 1").select("doc_id")), "doc_id", "left_semi")
    return (
        once.unionByName(again.dropDuplicates(["doc_id", "text"]))
        .unionByName(docs.where("doc_id is null"))
        .select(docs.columns)
    )
