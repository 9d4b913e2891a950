"""Quality rules and a hashed n-gram likelihood ratio, in built-in functions only.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets.  Two
multinomials over the buckets, with additive smoothing, are counted over whole corpora:
the trusted target (documents labelled good) and the raw corpus (all documents).  A
document's score is the mean over its n-grams of the logarithm of target over raw
probability, so its length plays no part; it is kept at ``KEEP_FROM`` or more.

Counting sends one row per bucket and task at most.  The ratios, one number per bucket,
go into the scoring plan as a constant, and a document is scored within its own row:
no text and no n-gram is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_side, whole_text, written

BUCKETS = 1 << 14
SMOOTHING = 1.0
KEEP_FROM = -0.08
FEWEST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def words_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_RUN)
    )


def windows_of(hashes: Column) -> Column:
    """A hash of every window of five words."""
    last = F.size(hashes) - WINDOW_WORDS
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(hashes, i + n) for n in range(WINDOW_WORDS)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _ranked(windows: Column) -> Column:
    """Windows with their places, equal ones side by side; none where all differ."""
    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), F.array_sort(pairs)
    )


def _covered(ranked: str) -> Column:
    """Words covered by windows that stand beside an equal one in column ``ranked``.

    A column's name, not an expression: the lambdas would evaluate that per element.
    """
    side = lambda n: F.get(F.col(ranked), n)["h"]
    same = lambda n, x: F.coalesce(side(n) == x["h"], F.lit(False))
    again = F.filter(ranked, lambda x, n: same(n - 1, x) | same(n + 1, x))
    places = F.array_sort(F.transform(again, lambda x: x["i"]))
    width = F.lit(WINDOW_WORDS)
    start = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("n"))
    step = lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(width, i - a["last"])).alias("n")
    )
    return F.coalesce(F.aggregate(places, start, step)["n"], F.lit(0))


def _with_words(docs: DataFrame) -> DataFrame:
    """``docs`` with their words' hashes; a null text has none."""
    return (
        docs.withColumn("text", whole_text())
        .withColumn("words", words_of(F.col("text")))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    )


def _buckets(hashes: Column) -> Column:
    """Buckets of all words and of all pairs of neighbouring words."""
    n = F.lit(BUCKETS)
    single = F.transform(hashes, lambda h: F.pmod(h, n).cast("int"))
    pair = F.zip_with(
        hashes,
        F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))),
        lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(a, b), n).cast("int")),
    )
    return F.concat(single, F.filter(pair, lambda b: b.isNotNull()))


def log_ratios(docs: DataFrame, trusted_ids: DataFrame) -> list[float]:
    """Per bucket, the logarithm of target over raw probability."""
    trusted = small_side(trusted_ids.distinct().withColumn("is_trusted", F.lit(1)))
    grams = (
        _with_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        .join(trusted, "doc_id", "left")
        .select(
            F.coalesce("is_trusted", F.lit(0)).alias("is_trusted"),
            F.explode(_buckets(F.col("hashes"))).alias("bucket"),
        )
    )
    counts = written(
        grams.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("raw"), F.sum("is_trusted").alias("target")
        ),
        "bucket-counts",
    )
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket")
    filled = every.join(counts, "bucket", "left").na.fill(0, ["raw", "target"])
    totals = filled.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).head()
    share = lambda n, of: (F.col(n) + SMOOTHING) / F.lit(float(of + SMOOTHING * BUCKETS))
    ratio = F.log(share("target", totals["target"])) - F.log(share("raw", totals["raw"]))
    # One number per bucket: BUCKETS rows, whatever the corpus.
    rows = filled.select("bucket", ratio.alias("ratio")).collect()
    ratios = [0.0] * BUCKETS
    for row in rows:
        ratios[row["bucket"]] = row["ratio"]
    return ratios


def quality(
    docs: DataFrame, trusted_ids: DataFrame, keep_from: float = KEEP_FROM
) -> DataFrame:
    """Base rules and verdict for every document.

    ``docs`` needs ``doc_id`` and ``text``, ``trusted_ids`` is one column ``doc_id``;
    further columns are ignored.  A null text has no words; a text without n-grams
    scores 0, which only matters after the base rules.  Rows that repeat a ``doc_id``
    or have none are judged by their own texts.  Without trusted documents every bucket
    has the smoothed share of none, and scores compare with that.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``score`` and ``kept``.
    """
    ratios = log_ratios(docs, trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null"))
    # A constant of the plan, folded once.
    table = F.expr(f"array({', '.join(f'{x!r}D' for x in ratios)})")
    plain = lambda drop: F.length(F.translate("text", drop, ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    measured = (
        _with_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
        .withColumn("lines", lines)
        .withColumn("windows", windows_of(F.col("hashes")))
        .select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            plain(SPACES).cast("long").alias("word_chars"),
            (F.length("text") - plain(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            "windows",
            _buckets(F.col("hashes")).alias("buckets"),
        )
        .withColumn("ranked", _ranked(F.col("windows")))
        .withColumn("n_repeat_words", _covered("ranked").cast("long"))
        .withColumn(
            "score",
            F.aggregate("buckets", F.lit(0.0), lambda a, b: a + F.get(table, b))
            / F.greatest(F.size("buckets"), F.lit(1)),
        )
    )
    return measured.withColumn(
        "base_failed",
        (F.col("n_words") < FEWEST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    ).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("score") >= keep_from)).alias("kept"),
        "score",
    )
