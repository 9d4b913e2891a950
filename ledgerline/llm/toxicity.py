"""Toxicity from two class-conditional Kneser-Ney models of spelling.

Each class, toxic and ordinary, has an interpolated Kneser-Ney model of the characters
of words, ``ORDER`` characters deep, so that an expression never seen in training is
judged by the parts that it shares with known ones.  Orders above ``SHARED`` count each
class by itself; those up to it count both classes together, so a rare spelling falls
back to the same probabilities in either model and says nothing for one of them.

A text's evidence is the difference of its two log-likelihoods divided by its number of
words.  A logistic curve fitted on labelled rows that the counts haven't seen turns the
evidence into a score.

Counts grow with the corpus and stay distributed.  Every run and context keeps its own
values, looked up by its exact characters: in every worker while they are at most
``MODEL_ROWS`` in all, beyond that by joins that score each distinct word of the corpus
once.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS, kept_in_worker, small_side, whole_text, written

ORDER = 5
SHARED = 3
MODEL_ROWS = BROADCAST_ROWS  # under 2**22, see Lookup
FREQUENT = 2000
THRESHOLD = 0.3
ALPHABET = 1 << 16  # the uniform distribution below the lowest order
MOST_WORDS = 300_000
OPEN, CLOSE = "\x02", "\x03"
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…«»“”„‘’¿¡–—"
BUCKETS_PER_UNIT, WIDEST = 500, 4.0


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4: 0 and 1 count, 3 calibrates, 2 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def normal(word: str) -> str:
    """A word in lower case without punctuation at its ends (kept if that is all)."""
    return word.strip(EDGES) or word


def _counted(labelled: DataFrame) -> DataFrame:
    """How many toxic and ordinary texts each word occurs in.

    A text counts a word once, so one that repeats itself doesn't outweigh the others.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(), Counter()
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                seen[toxic].update(set(text.lower().split()))
            clean = Counter(), Counter()
            for raw, into in zip(seen, clean):
                for word, n in raw.items():
                    into[normal(word)] += n
            words = list(clean[0].keys() | clean[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.string()),
                    pa.array([clean[1][w] for w in words], pa.int64()),
                    pa.array([clean[0][w] for w in words], pa.int64()),
                ],
                ["word", "toxic", "ordinary"],
            )

    return (
        labelled.select("text", "toxic")
        .mapInArrow(count, "word string, toxic long, ordinary long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def _grams(words: DataFrame) -> DataFrame:
    """Counts of all runs of ``ORDER`` characters, with opened and closed words."""
    padded = F.concat(F.lit(OPEN * (ORDER - 1)), "word", F.lit(CLOSE))
    return (
        words.withColumn("padded", padded)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.length("padded") - ORDER + 1)))
        .groupBy(F.substring("padded", F.col("at"), F.lit(ORDER)).alias("gram"))
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def _continued(grams: DataFrame) -> DataFrame:
    """The next lower order: how many different characters come before each run."""
    seen = [
        F.sum((F.col(c) > 0).cast("long")).alias(c) for c in ("toxic", "ordinary")
    ]
    return grams.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*seen)


def _smoothed(grams: DataFrame, order: int) -> DataFrame:
    """Kneser-Ney shares of one order: of each run, and the weight of its context.

    ``t`` and ``o`` are discounted shares in the toxic and the ordinary model, ``lt``
    and ``lo`` what the context leaves to the lower order.
    """
    if order <= SHARED:
        both = F.col("toxic") + F.col("ordinary")
        grams = grams.select("gram", both.alias("toxic"), both.alias("ordinary"))
    # Absolute discounts from how many runs were seen once and twice.
    ones = [F.sum((F.col(c) == n).cast("long")) for c in ("toxic", "ordinary") for n in (1, 2)]
    t1, t2, o1, o2 = grams.agg(*ones).head()
    context = F.substring("gram", 1, order - 1) if order > 1 else F.lit("")
    frame = grams.withColumn("context", context)
    by = Window.partitionBy("context")
    columns = [F.lit(order).alias("order"), "gram", "context"]
    for name, once, twice, share, left in (
        ("toxic", t1, t2, "t", "lt"),
        ("ordinary", o1, o2, "o", "lo"),
    ):
        discount = once / (once + 2 * twice) if once and twice else 0.5
        total = F.sum(name).over(by)
        kinds = F.sum((F.col(name) > 0).cast("long")).over(by)
        kept = F.greatest(F.col(name) - F.lit(discount), F.lit(0.0))
        columns += [
            F.when(total > 0, kept / total).otherwise(0.0).alias(share),
            F.when(total > 0, F.lit(discount) * kinds / total).otherwise(1.0).alias(left),
        ]
    return frame.select(*columns)


def _codes(texts: list[str], width: int) -> np.ndarray:
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, "<u4").astype(np.uint64).reshape(-1, width)


def _packed(codes: np.ndarray) -> np.ndarray:
    """Up to three characters in one number; each has 21 bits."""
    out = np.zeros(len(codes), np.uint64)
    for column in range(codes.shape[1]):
        out = (out << np.uint64(21)) | codes[:, column]
    return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted number in the sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return place, keys[place] == wanted


class Lookup:
    """Values of strings of one width, by their exact characters.

    Strings of four and five characters are told apart by the number of their first
    three and by the others, 22 + 42 bits.
    """

    def __init__(self, strings: list[str], width: int, values: np.ndarray):
        codes = _codes(strings, width) if width else np.zeros((len(strings), 0), np.uint64)
        self.heads = np.unique(_packed(codes[:, :3]))
        keys, _ = self._keys(codes)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def _keys(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        head, known = _found(self.heads, _packed(codes[:, :3]))
        return (head.astype(np.uint64) << np.uint64(42)) | _packed(codes[:, 3:]), known

    def of(self, codes: np.ndarray, absent: float) -> np.ndarray:
        keys, known = self._keys(codes)
        place, there = _found(self.keys, keys)
        out = np.full((len(codes), 2), absent)
        there &= known
        out[there] = self.values[place[there]]
        return out


@dataclass
class Tables:
    """All shares and weights by order, where they are few enough for every worker."""

    shares: list[Lookup]
    lefts: list[Lookup]

    def differences(self, grams: np.ndarray) -> np.ndarray:
        """Log-likelihood difference of the last character of each row of codes."""
        both = np.full((len(grams), 2), 1.0 / ALPHABET)
        for k in range(1, ORDER + 1):
            share = self.shares[k - 1].of(grams[:, ORDER - k :], 0.0)
            both = share + self.lefts[k - 1].of(grams[:, ORDER - k : -1], 1.0) * both
        return np.log(both[:, 0]) - np.log(both[:, 1])

    def evidence(self, words: list[str]) -> np.ndarray:
        """Sum of log-likelihood differences over the characters of each word."""
        padded = [_padded(w) for w in words]
        lengths = np.array([len(p) for p in padded])
        codes = _codes(padded, 1)[:, 0]
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # Words are judged given their first character, whose frequencies tell more of
        # the mix of languages in a class than of what it says.
        ends = np.flatnonzero(place >= ORDER)
        grams = codes[ends[:, None] + np.arange(1 - ORDER, 1)[None, :]]
        first, last = _packed(grams[:, :3]), _packed(grams[:, 3:])
        order = np.lexsort((last, first))
        first, last = first[order], last[order]
        new = np.r_[True, (first[1:] != first[:-1]) | (last[1:] != last[:-1])][: len(order)]
        kinds = self.differences(grams[order[new]])
        difference = np.empty(len(order))
        difference[order] = kinds[np.cumsum(new) - 1]
        return np.bincount(owner[ends], difference, len(words))


@dataclass
class Model:
    """Shares of all runs and weights of all contexts, as written rows.

    ``table`` is the order of a run, and 100 more for the context of that order; ``a``
    and ``b`` are the values in the toxic and the ordinary model.
    """

    rows: DataFrame
    tables: Tables | None
    slope: float = 0.0
    offset: float = 0.0


def _padded(word: str) -> str:
    return OPEN * (ORDER - 1) + normal(word) + CLOSE


def _tables(rows: DataFrame) -> Tables | None:
    """The rows for every worker, or none if they are more than ``MODEL_ROWS``."""
    if rows.count() > MODEL_ROWS:
        return None
    found = rows.toArrow()
    table, strings = found.column("table").to_numpy(), found.column("run").to_pylist()
    values = np.stack([found.column("a").to_numpy(), found.column("b").to_numpy()], axis=1)

    def of(number: int, width: int) -> Lookup:
        own = np.flatnonzero(table == number)
        return Lookup([strings[n] for n in own], width, values[own])

    orders = range(1, ORDER + 1)
    return Tables([of(k, k) for k in orders], [of(k + 100, k - 1) for k in orders])


def trained(labelled: DataFrame) -> Model:
    """Both models from rows of ``text`` and ``toxic`` (0 or 1)."""
    grams = written(_grams(_counted(labelled)), "toxicity-runs")
    orders = []
    for order in range(ORDER, 0, -1):
        orders.append(_smoothed(grams, order))
        if order > 1:
            grams = written(_continued(grams), "toxicity-runs")
    entries = None
    for frame in orders:
        runs = frame.select(
            F.col("order").alias("table"), F.col("gram").alias("run"),
            F.col("t").alias("a"), F.col("o").alias("b"),
        )
        contexts = frame.groupBy("order", "context").agg(
            F.first("lt").alias("a"), F.first("lo").alias("b")
        ).select((F.col("order") + 100).alias("table"), F.col("context").alias("run"), "a", "b")
        both = runs.unionByName(contexts)
        entries = both if entries is None else entries.unionByName(both)
    rows = written(entries, "toxicity-tables")
    return Model(rows, _tables(rows))


def _scored(name: str, tables: Tables, texts: list[str]) -> list[float]:
    """Evidence of each text; that of words is kept in the worker under ``name``."""
    known = kept_in_worker(name, dict)
    out: list[float] = []
    for at in range(0, len(texts), 128):
        split = [text.lower().split() for text in texts[at : at + 128]]
        new = list(set().union(*split).difference(known))
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
            new = list(set().union(*split))
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            known.update(zip(part, tables.evidence(part).tolist()))
        look = known.__getitem__
        out += [sum(map(look, w)) / len(w) if w else 0.0 for w in split]
    return out


def _evidence(docs: DataFrame, model: Model, columns: str) -> DataFrame:
    """``docs`` (its last column is the text) with the evidence in place of the text."""
    if model.tables is None:
        return _evidence_by_join(docs, model)
    shared = docs.sparkSession.sparkContext.broadcast(model.tables)
    name = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            out = _scored(name, shared.value, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())],
                [*batch.schema.names[:-1], "evidence"],
            )

    return docs.mapInArrow(score, f"{columns}, evidence double")


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` left joined with ``table``, which has each ``key`` once.

    Keys of more than a ``FREQUENT``-th of the rows, so fewer than that many, are
    joined by broadcast; what is shuffled has no key of a larger share.
    """
    if table.count() <= MODEL_ROWS:
        return rows.join(F.broadcast(table), key, "left")
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    often = written(often.where(F.col("n") * FREQUENT > rows.count()).select(key), "toxicity-often")
    hot = written(table.join(F.broadcast(often), key), "toxicity-often")
    common = rows.join(F.broadcast(often), key).join(F.broadcast(hot), key, "left")
    seldom = rows.join(F.broadcast(often), key, "left_anti").join(table, key, "left")
    return common.unionByName(seldom)


def _gram_differences(grams: DataFrame, model: Model) -> DataFrame:
    """``gram`` and its ``difference`` by joins with the rows of the model.

    Grams differ, so few of them share a key that is too long for a broadcast table.
    """
    both = [F.lit(1.0 / ALPHABET)] * 2
    for k in range(1, ORDER + 1):
        terms = []
        for number, width, absent in ((k, k, 0.0), (k + 100, k - 1, 1.0)):
            key, names = f"key{number}", [f"a{number}", f"b{number}"]
            table = model.rows.where(F.col("table") == number).select(
                F.col("run").alias(key), F.col("a").alias(names[0]), F.col("b").alias(names[1])
            )
            at = F.substring("gram", ORDER - k + 1, width)
            grams = grams.withColumn(key, at).join(small_side(table), key, "left")
            terms.append([F.coalesce(F.col(n), F.lit(absent)) for n in names])
        both = [share + left * lower for share, left, lower in zip(*terms, both)]
    return written(
        grams.select("gram", (F.log(both[0]) - F.log(both[1])).alias("difference")),
        "toxicity-grams",
    )


def _evidence_by_join(docs: DataFrame, model: Model) -> DataFrame:
    """The same where the model is too large for a worker.

    Every word of the corpus is scored once, from its distinct runs of characters; its
    evidence is joined back to the texts by the word.
    """
    carried, text = docs.columns[:-1], docs.columns[-1]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows, words, counts = [], [], []
                for n, value in enumerate(part.column(1).to_pylist()):
                    # A text without words has one row.
                    for word, count in (Counter(value.lower().split()) or {None: 0}).items():
                        rows.append(n)
                        words.append(word)
                        counts.append(count)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(words, pa.string()), pa.array(counts, pa.int64())],
                    ["row", "word", "n_word"],
                )

    def padded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0)
            out = [_padded(w) for w in words.to_pylist()]
            yield pa.RecordBatch.from_arrays([words, pa.array(out, pa.string())], ["word", "padded"])

    named = written(docs.withColumn("row", F.monotonically_increasing_id()), "toxicity-texts")
    pairs = written(
        named.select("row", text).mapInArrow(split, "row long, word string, n_word long"),
        "toxicity-words",
    )
    # Starts of runs that end behind a word's first character.
    starts = F.sequence(F.lit(2), F.length("padded") - ORDER + 1)
    spots = written(
        pairs.where("word is not null").select("word").distinct()
        .mapInArrow(padded, "word string, padded string")
        .withColumn("at", F.explode(starts))
        .select("word", F.substring("padded", F.col("at"), F.lit(ORDER)).alias("gram")),
        "toxicity-spots",
    )
    kinds = _gram_differences(spots.select("gram").distinct(), model)
    words = written(
        _looked_up(spots, kinds, "gram").groupBy("word").agg(F.sum("difference").alias("e")),
        "toxicity-evidence",
    )
    sums = _looked_up(pairs, words, "word").groupBy("row").agg(
        F.sum(F.col("n_word") * F.coalesce("e", F.lit(0.0))).alias("e"), F.sum("n_word").alias("n")
    )
    mean = F.when(F.col("n") > 0, F.col("e") / F.col("n")).otherwise(0.0)
    return named.drop(text).join(sums.select("row", mean.alias("evidence")), "row").select(
        *carried, "evidence"
    )


def _calibrated(model: Model, scored: DataFrame) -> Model:
    """The logistic curve through labelled evidence, from its histogram."""
    bucket = F.round(
        F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), "evidence")) * BUCKETS_PER_UNIT
    )
    rows = scored.groupBy(bucket.alias("x"), "toxic").count().collect()
    if not rows:
        return model
    x = np.array([r["x"] / BUCKETS_PER_UNIT for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    n = np.array([float(r["count"]) for r in rows])
    design = np.stack([x, np.ones_like(x)], axis=1)
    weights, ridge = np.zeros(2), np.array([1e-4, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(design @ weights).clip(-30, 30)))
        slope = design.T @ (n * (p - y)) + ridge * weights
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        size = np.abs(step).max()
        weights -= step * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-9:
            break
    return replace(model, slope=float(weights[0]), offset=float(weights[1]))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """Counts from folds 0 and 1 of the labelled rows, the curve from fold 3."""
    marked = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("fold", fold())
        .where("fold <> 2")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    labelled = texts.join(small_side(marked), "doc_id")
    model = trained(labelled.where("fold <> 3"))
    return _calibrated(
        model,
        _evidence(labelled.where("fold = 3").select("toxic", "text"), model, "toxic int"),
    )


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row, by its text alone."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    raw = _evidence(texts, model, "doc_id long")
    logit = F.lit(model.slope) * F.col("evidence") + F.lit(model.offset)
    return raw.select(
        "doc_id",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), logit))))).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Score every document with models of its corpus's labelled part.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``toxic``; further
    columns are ignored.  Only labels whose fold isn't 2 are used, and only texts are
    ever inputs of a score.  Null and empty texts and texts without words have no
    evidence and get the score of none.  Without any label every score is a half; a
    null ``doc_id`` is scored as any other and is never held out or trained on.  A
    ``doc_id`` with several labels is toxic if one says so.
    """
    model = fitted(docs, labels)
    return score(docs, model, threshold).select(
        "doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts score below the threshold."""
    model = fitted(docs, labels)
    slope, offset = model.slope, model.offset
    if model.tables is None:
        named = written(docs.withColumn("__row", F.monotonically_increasing_id()), "toxicity-rows")
        scored = _evidence(named.select("__row", whole_text().alias("text")), model, "__row long")
        logit = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.lit(slope) * F.col("evidence") + F.lit(offset)))
        high = scored.where(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)) >= threshold).select("__row")
        high = written(high, "toxicity-rejected")
        return named.join(small_side(high), "__row", "left_anti").select(
            *[F.col(f"`{c}`") for c in docs.columns]
        )
    shared = docs.sparkSession.sparkContext.broadcast(model.tables)
    name = uuid.uuid4().hex

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            evidence = np.array(_scored(name, shared.value, texts))
            logit = slope * evidence + offset
            low = 1 / (1 + np.exp(-logit.clip(-700, 700))) < threshold
            yield batch.filter(pa.array(low, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
