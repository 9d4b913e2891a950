"""The operators as queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    centroids,
    mixing,
    near_text,
    near_vectors,
    packing,
    periodic_runs,
    quality,
    repeats,
    revisits,
    seed_extend,
    surrogates,
    token_files,
    toxicity,
)
from ledgerline.llm.common import documents, ship
from ledgerline.llm.tokens import default_vocabulary
from ledgerline.session import scratch_path

# A deployment passes its own secret here.
SURROGATE_KEY = "surrogates of the test tables"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a function under its name; executors get the package first."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the token-id files and back."""
    path = scratch_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, default_vocabulary())
    return token_files.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and likelihood ratio of all documents; good labels are the target."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality(
        documents(spark, sf_dir), labels.where("quality = 1").select("doc_id")
    )


@query
def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without byte strings of 400 that occur more than once."""
    return repeats.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def captures(pages: DataFrame) -> DataFrame:
    """WARC records from raw pages: each page's response and a later revisit of its URL.

    Pages were captured a minute apart in the order of their ids.  A response carries
    the page's md5 as entity tag; every page was asked for again 90 minutes later with
    the tag it had then, so where another page of the same canonical URL was captured
    in between, its tag no longer agrees.
    """
    page = pages.select(
        "page_id",
        "url",
        F.octet_length("html").cast("string").alias("size"),
        F.md5(F.col("html").cast("binary")).alias("md5"),
    )
    seconds = F.col("page_id") * 60
    date = lambda s: F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    first = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"),
        F.lit("Content-Length"), F.col("size"),
        F.lit("ETag"), F.concat(F.lit('"'), F.col("md5"), F.lit('"')),
        F.lit("Date"), date(seconds),
        F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    later = F.create_map(
        F.lit("etag"), F.concat(F.lit('W/"'), F.col("md5"), F.lit('"')),
        F.lit("date"), date(seconds + 5400),
        F.lit("cache-control"), F.lit("max-age=600"),
        F.lit("content-length"), F.lit("0"),
    )
    responses = page.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        seconds.alias("captured_at"),
        F.lit(200).alias("status"),
        first.alias("headers"),
    )
    asked = page.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        (seconds + 5400).alias("captured_at"),
        F.lit(304).alias("status"),
        later.alias("headers"),
    )
    return responses.unionByName(asked)


@query
def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the revisits of all pages stand for, with their merged headers."""
    resolved = revisits.resolve(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    fields = F.array_sort(
        F.transform(
            F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
        )
    )
    return resolved.select(
        "record_id",
        "canonical",
        "outcome",
        "response_id",
        F.array_join(fields, "\n").alias("headers"),
    )


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents from the labels outside fold 2."""
    return toxicity.toxicity(
        documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    )


@query
def op6_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents at five-word Jaccard similarity 0.8 or more."""
    return near_text.near_documents(documents(spark, sf_dir))


@query
def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    return surrogates.replace(
        documents(spark, sf_dir).select("doc_id", "text"), SURROGATE_KEY
    )


@query
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95 or more."""
    return near_vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    packed = packing.pack(documents(spark, sf_dir), default_vocabulary())
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mix of all sources."""
    return mixing.mixed(documents(spark, sf_dir).select("doc_id", "source"))

CHECKS["op4_revisits"] = """
WITH parts AS (
    SELECT page_id, md5(html) AS tag, strlen(html) AS size,
           regexp_replace(url, '#.*$', '') AS bare
    FROM pages
), split AS (
    SELECT page_id, tag, size,
           lower(regexp_extract(bare, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
           regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest
    FROM parts
), named AS (
    SELECT page_id, tag, size, CASE scheme WHEN 'https' THEN 'http' ELSE scheme END
        || '://'
        || regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)),
                                         '(:80|:443)$', ''), '^www[.]', '')
        || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
        list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*[?](.*)$', 1), '&'),
            lambda x: x <> '' AND NOT starts_with(x, 'utm_') AND NOT starts_with(x, 'ref='))) AS query
    FROM split
), urls AS (
    SELECT page_id, tag, size, page_id * 60 AS taken, place
        || CASE WHEN len(query) = 0 THEN '' ELSE '?' || array_to_string(query, '&') END AS canonical
    FROM named
), found AS (
    SELECT v.page_id, v.canonical, v.tag, v.taken + 5400 AS taken,
           arg_max({'page': r.page_id, 'tag': r.tag, 'size': r.size}, r.page_id) AS r
    FROM urls v JOIN urls r
      ON r.canonical = v.canonical AND r.taken <= v.taken + 5400
    GROUP BY ALL
)
SELECT page_id * 2 + 1 AS record_id, canonical,
       CASE WHEN r.tag = tag THEN 'resolved' ELSE 'validator-mismatch' END AS outcome,
       r.page * 2 AS response_id,
       'cache-control: max-age=600' || chr(10)
       || CASE WHEN r.tag = tag
          THEN 'content-length: ' || r.size || chr(10) || 'content-type: text/html' || chr(10)
          ELSE 'content-length: 0' || chr(10) END
       || 'date: ' || strftime(make_timestamp(taken * 1000000), '%Y-%m-%dT%H:%M:%SZ') || chr(10)
       || CASE WHEN r.tag = tag THEN 'etag: "' || r.tag || '"' ELSE 'etag: W/"' || tag || '"' END AS headers
FROM found
"""

CHECKS["op10_mixing"] = """
WITH RECURSIVE counted AS (
    SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1
), shares AS (
    SELECT s, n, CAST(floor(sqrt(n)) AS BIGINT) AS share FROM counted
), sums AS (
    SELECT s, n, share, sum(share) OVER (ORDER BY s) AS upto, sum(share) OVER () AS total,
           greatest(240, 2 * count(*) OVER ()) - count(*) OVER () AS spare
    FROM shares
), weighted AS (
    SELECT s, CAST((n + 7) // 8 AS BIGINT) AS blocks,
           CAST(1 + (spare * upto) // total - (spare * (upto - share)) // total AS BIGINT) AS w
    FROM sums
), slots AS (
    -- One slot after another: t counts within the phase, done within it, had before it.
    SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS t, '' AS s, CAST(-1 AS BIGINT) AS block,
           (SELECT list({'s': s, 'w': w, 'blocks': blocks, 'had': CAST(0 AS BIGINT), 'done': CAST(0 AS BIGINT)} ORDER BY s)
            FROM weighted) AS state
    UNION ALL
    SELECT slot + 1,
           CASE WHEN pick.had + pick.done + 1 = pick.blocks THEN 0 ELSE t + 1 END,
           pick.s, pick.had + pick.done,
           CASE WHEN pick.had + pick.done + 1 = pick.blocks
                THEN list_transform(list_filter(state, lambda x: x.s <> pick.s),
                     lambda x: {'s': x.s, 'w': x.w, 'blocks': x.blocks, 'had': x.had + x.done, 'done': CAST(0 AS BIGINT)})
                ELSE list_transform(state, lambda x: {'s': x.s, 'w': x.w, 'blocks': x.blocks, 'had': x.had,
                     'done': x.done + CASE WHEN x.s = pick.s THEN 1 ELSE 0 END}) END
    FROM (
        SELECT slot, t, state,
               list_sort(list_transform(
                   list_filter(state, lambda x: (x.done * total) // x.w <= t),
                   lambda x: {'due': ((x.done + 1) * total + x.w - 1) // x.w, 's': x.s,
                              'blocks': x.blocks, 'had': x.had, 'done': x.done}))[1] AS pick
        FROM (SELECT *, CAST(list_sum(list_transform(state, lambda x: x.w)) AS BIGINT) AS total FROM slots)
        WHERE len(state) > 0
    )
), numbered AS (
    SELECT doc_id, source, coalesce(source, '') AS s,
           row_number() OVER (PARTITION BY coalesce(source, '')
                              ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS n
    FROM documents
)
SELECT doc_id, source, n // 8 AS mix_block, slot AS mix_slot, CAST(n % 8 AS INTEGER) AS mix_place
FROM numbered JOIN slots ON slots.s = numbered.s AND slots.block = n // 8
"""


def echoed(docs: DataFrame) -> DataFrame:
    """Documents of which a tenth repeats a stretch of its words up to the end.

    With ``h = crc32(doc_id)`` and ``g = h // 10``: where ``h % 10`` is 0, words from
    ``a = g % n`` on repeat the ``p = 1 + (n - a) // (3 + g % 8)`` words at ``a``.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    g, n = F.floor(h / 10), F.size("words")
    parts = docs.select("doc_id", "text", F.when(chosen, words).alias("words"), g.alias("g"))
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    block = F.slice("words", a + 1, p)
    again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    whole = F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), n - a))
    changed = F.when(F.col("words").isNotNull(), F.array_join(whole, " "))
    return parts.select("doc_id", F.coalesce(changed, "text").alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of them with an echo."""
    found = periodic_runs.runs(echoed(documents(spark, sf_dir)))
    line = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", periodic_runs.longest())
    length, period = -F.col("best.shorter"), F.col("best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 8 clusters after 10 rounds."""
    return centroids.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _centroid_check(rounds: int = 10) -> str:
    """Plain Lloyd rounds in SQL: every distance of every vector to every centroid."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS MATERIALIZED (
    SELECT v.r, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d
    FROM v JOIN c{n} c USING (i) GROUP BY ALL
), a{n} AS MATERIALIZED (
    SELECT r, CAST(min(k) AS INTEGER) AS k, CAST(min(d) AS BIGINT) AS d
    FROM (SELECT r, k, d, min(d) OVER (PARTITION BY r) AS least FROM d{n}) WHERE d = least
    GROUP BY r
)""")
        if n < rounds:
            steps.append(f"""
s{n} AS (
    SELECT a.k, v.i, sum(v.x) AS s, count(*) AS n FROM v JOIN a{n} a USING (r) GROUP BY ALL
), c{n + 1} AS MATERIALIZED (
    SELECT c.k, c.i, CASE WHEN s.n IS NULL THEN c.x
        ELSE CAST((s.s - (s.s % s.n + s.n) % s.n) // s.n AS BIGINT) END AS x
    FROM c{n} c LEFT JOIN s{n} s ON s.k = c.k AND s.i = c.i
)""")
    return f"""
WITH good AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding,
          lambda x: x IS NOT NULL AND isfinite(x)))
), v AS MATERIALIZED (
    SELECT r, unnest(range(64)) AS i,
           unnest(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS x
    FROM good
), c0 AS MATERIALIZED (
    SELECT f.k, v.i, v.x
    FROM (SELECT r, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS k
          FROM good) f JOIN v USING (r)
    WHERE f.k < 8
),{",".join(steps)}, names AS (
    SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS name FROM c{rounds} GROUP BY k
), sums AS (
    SELECT k, CAST(sum(d) AS BIGINT) AS s FROM a{rounds} GROUP BY k
)
SELECT vec_id, a.k AS cluster, a.d AS distance, sums.s AS cluster_inertia,
       (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia, name AS centroid_sha256
FROM a{rounds} a JOIN good USING (r) JOIN names USING (k) JOIN sums USING (k)
"""


CHECKS["op12_centroids"] = _centroid_check()


@query
def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages of 35 words that occur more than once."""
    return seed_extend.without_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


CHECKS["op13_passages"] = r"""
WITH rows_ AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), words_ AS MATERIALIZED (
    SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM rows_
), windows AS MATERIALIZED (
    SELECT r, i, word, n, CASE WHEN i + 35 <= n THEN md5(string_agg(word, ' ') OVER (
        PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS w
    FROM words_
), again AS MATERIALIZED (
    SELECT w FROM windows WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1
), judged AS (
    SELECT r, i, word, max(CASE WHEN again.w IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
    FROM windows LEFT JOIN again USING (w)
), kept AS (
    SELECT r, sum(gone) AS removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS text
    FROM judged GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM rows_ LEFT JOIN kept USING (r)
"""
