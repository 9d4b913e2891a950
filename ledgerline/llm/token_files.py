"""Token-id files: canonical length-limited Huffman codes of globally counted ids.

A folder holds three Parquet tables, so that Spark's committed writers and any of its
stores can be used:

* ``code``: the bit length of every used id, which alone gives the canonical code;
* ``blocks``: one row per block (see ``huffman``): ``shard``, ``block``, ``n_tokens``
  and ``data``.  Documents are in ascending ``doc_id`` order over shards and blocks,
  nulls first, repeated ids in the order of their token ids;
* ``shards``: the tokens before each shard.

A document is never split over blocks, and a block is closed at ``BLOCK_TOKENS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm import huffman
from ledgerline.llm.common import small_side, whole_text, written
from ledgerline.llm.tokens import encoder

BLOCK_TOKENS = 1 << 16
ROWS_OUT = 512
IDS_SCHEMA = "doc_id long, ids binary, counts binary"
BLOCK_SCHEMA = "shard long, block long, n_tokens long, data binary"
READ_SCHEMA = "shard long, start_in_shard long, doc_id long, n_tokens long, ids binary"


def _as_ids(packed: bytes, width: int) -> np.ndarray:
    return np.frombuffer(packed, f"<u{width}").astype(np.uint32)


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """``doc_id`` and its packed ids with the end id; a null text has only that.

    Each task adds one row without ids: how often it has met each id, counted on the way.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary)
        end = end_id.to_bytes(tool.width, "little")
        total = np.zeros(0, np.int64)

        def told(doc_ids: pa.Array, ids: list, counts: list) -> pa.RecordBatch:
            columns = [doc_ids, pa.array(ids, pa.binary()), pa.array(counts, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "counts"])

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [tool.encode(text) + end for text in part.column(1).to_pylist()]
                seen = np.bincount(np.frombuffer(b"".join(ids), f"<u{tool.width}"))
                if len(seen) < len(total):
                    seen, total = total, seen
                seen[: len(total)] += total
                total = seen
                yield told(part.column(0), ids, [None] * len(ids))
        if total.any():
            used = np.flatnonzero(total)
            counts = np.column_stack([used, total[used]]).astype("<i8").tobytes()
            yield told(pa.array([None], pa.int64()), [None], [counts])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")
    ).mapInArrow(encode, IDS_SCHEMA)


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs, from what the encoding tasks have counted."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                pairs = np.frombuffer(packed, "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "n"]
                )

    return (
        tokens.where(F.col("counts").isNotNull())
        .select("counts")
        .mapInArrow(unpack, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
    )


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Encode whole texts and write them in ascending ``doc_id`` order.

    ``docs`` needs ``doc_id`` and ``text``; further columns are ignored.  An empty
    table gives a folder without blocks.
    """
    spark = docs.sparkSession
    width = encoder(vocabulary).width
    tokens = written(tokenized(docs, vocabulary, end_id), "token-ids")
    # One row per id of the vocabulary at most: a bound known before the run.
    counts = id_counts(tokens).toPandas()
    tokens = tokens.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    table = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 0, np.int64)
    table[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    lengths = huffman.code_lengths(table)
    codes = huffman.canonical_codes(lengths)
    shared = spark.sparkContext.broadcast((codes, lengths))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, lengths = shared.value
        shard, block, doc_ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def packed() -> pa.RecordBatch:
            data = huffman.pack_block(doc_ids, held, codes, lengths)
            return pa.RecordBatch.from_pydict(
                {"shard": [shard], "block": [block], "n_tokens": [size], "data": [data]}
            )

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1))
            for doc_id, ids in rows:
                doc_ids.append(doc_id)
                held.append(_as_ids(ids.as_py(), width))
                size += len(held[-1])
                if size >= BLOCK_TOKENS:
                    yield packed()
                    block, doc_ids, held, size = block + 1, [], [], 0
        if doc_ids:
            yield packed()

    (
        tokens.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(encode, BLOCK_SCHEMA)
        .write.option("compression", "none")
        .parquet(f"{path}/blocks")
    )
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        [(int(i), int(lengths[i])) for i in used], "id long, bits int"
    ).coalesce(1).write.parquet(f"{path}/code")
    # One row per shard, which is one write task.
    shards = (
        spark.read.schema(BLOCK_SCHEMA)
        .parquet(f"{path}/blocks")
        .groupBy("shard")
        .agg(F.sum("n_tokens").alias("n_tokens"))
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select(
        "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before")
    ).coalesce(1).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a folder: ``doc_id``, ``start``, ``n_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers; ``start`` counts the ids of
    all documents before.
    """
    code = spark.read.schema("id long, bits int").parquet(f"{path}/code").toPandas()
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 0, np.uint8)
    lengths[code["id"].to_numpy(np.int64)] = code["bits"].to_numpy(np.uint8)
    shared = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(shared.value)
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            bases = batch.column("start_in_shard").to_pylist()
            blocks = batch.column("data").to_pylist()
            for at in range(0, len(blocks), 16):
                decoded = huffman.unpack_blocks(blocks[at : at + 16], table)
                for shard, base, (doc_ids, ids) in zip(shards[at:], bases[at:], decoded):
                    sizes = np.array([len(x) for x in ids], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * len(ids), pa.int64()),
                            pa.array(base + np.cumsum(sizes) - sizes, pa.int64()),
                            pa.array(doc_ids, pa.int64()),
                            pa.array(sizes, pa.int64()),
                            pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                        ],
                        ["shard", "start_in_shard", "doc_id", "n_tokens", "ids"],
                    )

    stored = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    sizes = stored.select("shard", "block", "n_tokens")
    earlier = (
        Window.partitionBy("shard")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    index = sizes.select(
        "shard",
        "block",
        F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("start_in_shard"),
    )
    shards = spark.read.schema("shard long, before long").parquet(f"{path}/shards")
    return (
        stored.select("shard", "block", "data")
        .join(small_side(index), ["shard", "block"])
        .select("shard", "start_in_shard", "data")
        .mapInArrow(decode, READ_SCHEMA)
        .join(small_side(shards), "shard")
        .select(
            "doc_id",
            (F.col("before") + F.col("start_in_shard")).alias("start"),
            "n_tokens",
            "ids",
        )
    )


def checksum(ids):
    """Unsigned crc32 of packed 32-bit ids."""
    return F.crc32(ids)


__all__ = ["checksum", "id_counts", "read", "tokenized", "write"]
