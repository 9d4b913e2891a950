"""Not-modified revisits of WARC records, resolved to the responses they stand for.

A revisit record of the profile "server not modified" holds only the headers of a 304.
It stands for the latest earlier full response (status 200) of the same canonical URL,
if their validators agree, and its own headers update the stored ones.

The as-of join works in chunks of the records' order by URL and time: within a chunk a
window carries the last response on, and over the few chunks of a URL another window
carries the last response of earlier ones.  The chunks are the partitions of one range
shuffle, written so that every step sees the same ones; a URL with a third of all records
lies in a third of the chunks, whatever its times are, and any other in one or two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

CHUNK_ROWS = 500_000
LEAST_CHUNKS = 32
# Header fields of a stored response that a 304 never replaces.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-md5",
    "content-range", "content-type", "etag", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)
RESOLVED, CHANGED, ORPHAN = "resolved", "validator-mismatch", "no-response"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, fragment or ``www.``, http for
    https, a path without a final slash, query parameters in order without campaign
    marks; an empty query is none."""
    bare = F.regexp_replace(url, "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(host, "(:80|:443)$", "")
    host = F.regexp_replace(host, "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "^[^?]*[?](.*)$", 1)
    kept = F.filter(
        F.split(query, "&"),
        lambda x: (x != "") & ~x.startswith("utm_") & ~x.startswith("ref="),
    )
    query = F.array_join(F.array_sort(kept), "&")
    scheme = F.when(scheme == "https", "http").otherwise(scheme)
    return F.concat(
        scheme, F.lit("://"), host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    )


def _opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def validators_agree(stored: Column, fresh: Column) -> Column:
    """Weak comparison of entity tags where the 304 names one, else of dates.

    A 304 without any validator, or one for which the response has none, tells nothing
    against the response only in the first case.
    """
    tag, date = fresh["etag"], fresh["last-modified"]
    return F.coalesce(
        F.when(tag.isNotNull(), _opaque(tag) == _opaque(stored["etag"]))
        .when(date.isNotNull(), F.trim(date) == F.trim(stored["last-modified"]))
        .otherwise(True),
        F.lit(False),
    )


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The stored fields, updated by those that a 304 may change."""
    fixed = F.array(*[F.lit(x) for x in KEPT_FIELDS])
    update = F.map_filter(fresh, lambda k, v: ~F.array_contains(fixed, k) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(update), k))
    return F.map_concat(kept, update)


def _lower_keys(headers: Column) -> Column:
    """Field names in lower case; of fields that differ in case only, the first counts."""
    entries = F.map_entries(headers)
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(
        F.zip_with(entries, F.sequence(F.lit(1), F.size(entries)),
                   lambda e, n: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), n.alias("n"))),
        lambda e: F.array_position(names, e["key"]) == e["n"],
    )
    plain = F.transform(first, lambda e: F.struct(e["key"], e["value"]))
    return F.when(headers.isNull() | (F.size(headers) == 0), F.create_map().cast("map<string,string>")).otherwise(
        F.map_from_entries(plain)
    )


def resolve(records: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """What every revisit stands for.

    ``records`` needs ``record_id``, ``url``, ``captured_at``, ``status`` and
    ``headers`` (a map); further columns are ignored.  Earlier means a smaller
    ``captured_at``, at equal times a smaller ``record_id``.  Records without a URL or
    time have no canonical history: such a revisit is an orphan, such a response is
    never found.  Null headers are empty ones.  Only status 200 is a full response and
    only 304 a revisit; other records are left out of the result.

    Returns per revisit ``record_id``, ``canonical``, ``outcome``, ``response_id`` (the
    response found, also where its validators differ) and ``headers`` (merged where
    resolved, else its own).
    """
    base = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("canonical"),
        F.col("captured_at").alias("at"),
        "status",
        _lower_keys(F.col("headers")).alias("headers"),
    ).where("status in (200, 304)")
    response = F.when(F.col("status") == 200, F.struct("record_id", "headers"))
    usable = base.where("canonical is not null and at is not null")
    chunks = max(-(-records.count() // chunk_rows), LEAST_CHUNKS)
    usable = written(
        usable.repartitionByRange(chunks, "canonical", "at", "record_id").withColumn(
            "chunk", F.spark_partition_id()
        ),
        "revisit-chunks",
    )
    within = (
        Window.partitionBy("canonical", "chunk")
        .orderBy("at", "record_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    near = usable.withColumn("near", F.last(response, ignorenulls=True).over(within))
    lasts = (
        usable.where("status = 200")
        .groupBy("canonical", "chunk")
        .agg(F.max_by(F.struct("record_id", "headers"), F.struct("at", "record_id")).alias("last"))
    )
    # Every chunk of a URL with what the chunks before it leave.
    asked = usable.where("status = 304").select("canonical", "chunk").distinct()
    order = Window.partitionBy("canonical").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        lasts.join(asked, ["canonical", "chunk"], "full")
        .withColumn("far", F.last("last", ignorenulls=True).over(order))
        .select("canonical", "chunk", "far")
        .where("far is not null")
    )
    found = (
        near.where("status = 304")
        .join(carried, ["canonical", "chunk"], "left")
        .select("record_id", "canonical", "headers", F.coalesce("near", "far").alias("response"))
    )
    lost = base.where("status = 304 and (canonical is null or at is null)").select(
        "record_id", "canonical", "headers", F.lit(None).cast(found.schema["response"].dataType).alias("response")
    )
    stored = F.col("response")["headers"]
    every = found.unionByName(lost).withColumn(
        "outcome",
        F.when(F.col("response").isNull(), ORPHAN)
        .when(validators_agree(stored, F.col("headers")), RESOLVED)
        .otherwise(CHANGED),
    )
    return every.select(
        "record_id",
        "canonical",
        "outcome",
        F.col("response")["record_id"].alias("response_id"),
        F.when(F.col("outcome") == RESOLVED, merged_headers(stored, F.col("headers")))
        .otherwise(F.col("headers"))
        .alias("headers"),
    )


def resolved_payloads(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Resolved revisits with the payload of their response (``record_id``, ``payload``)."""
    stored = payloads.select(F.col("record_id").alias("response_id"), "payload")
    return resolved.where(F.col("outcome") == RESOLVED).join(stored, "response_id")
