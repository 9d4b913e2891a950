"""Helpers that the operators share: inputs, written steps, sizes, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerline
from ledgerline.session import ensure_checkpoint_dir, scratch_path

# A frame of narrow rows may be broadcast up to this many rows (at 16 bytes a row,
# 32 MB); beyond it the same join is left to a shuffle.
BROADCAST_ROWS = 2_000_000


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(ledgerline.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ledgerline-")) / "ledgerline_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


_shipped: set[str] = set()

T = TypeVar("T")


_kept: dict[object, object] = {}


def kept_in_worker(owner: object, make: Callable[[], T]) -> T:
    """What a worker process keeps between tasks, for one owner at a time.

    Workers outlive the operators of a pipeline; the next one's tables take the place
    of the last one's.
    """
    if owner not in _kept:
        _kept.clear()
        _kept[owner] = make()
    return _kept[owner]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def written(frame: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``frame`` written to the shared folder and read again.

    Cuts the lineage: a lost executor costs no second run of what made the rows.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.option("compression", codec).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast where it has been counted and is small, else as it is."""
    return F.broadcast(frame) if frame.count() <= limit else frame


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links between ids.

    ``edges`` has long columns ``a`` and ``b``; null ends and loops are left out.
    Returns ``node`` and ``root``, the smallest id of its component, for every node
    that is on a link.  Alternating large-star and small-star steps; only minima are
    grouped, so a hub of a third of all rows is combined before it is shuffled, and
    each step is checkpointed.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)

    def settled(frame: DataFrame) -> tuple[DataFrame, tuple]:
        frame = frame.checkpoint()
        mark = frame.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).head()
        return frame, tuple(mark)

    links = edges.select("a", "b").where("a <> b")
    links = links.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    links, mark = settled(links)
    while True:
        # Large star: every larger neighbour of a node points to the node's minimum.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (
            both.where("b > a")
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(
                least.where("m < a").select("a", F.col("m").alias("b"))
            )
            .distinct()
        )
        # Small star: a node and its smaller neighbours point to the smallest one.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        links, now = settled(small)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


__all__ = [
    "BROADCAST_ROWS",
    "components",
    "documents",
    "kept_in_worker",
    "ship",
    "small_side",
    "whole_text",
    "written",
]
