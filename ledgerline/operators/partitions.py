"""Day-partitioned Parquet tables: write, replace, list.

A table is a folder with one subfolder per value of its time column.  Replacing
days uses Spark's dynamic partition overwrite, so days that a job does not write
stay as they are and a repeated job gives the same table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators import files
from ledgerline.operators.curve import range_bounds, sorted_within


# Files that a task has open at once: with four tasks and full row groups some 8 GB at most.
MOST_OPEN = 16


@dataclass(frozen=True)
class Written:
    """What a write counted on its way, without reading the table again."""

    rows: int
    null_keys: int


def write_days(
    frame: DataFrame,
    path: str,
    partition_columns: list[str],
    cluster_columns: tuple[str, ...] = (),
    rebalance: bool = True,
    key_column: str | None = None,
) -> Written:
    """Replace the partitions that ``frame`` has rows for.

    ``rebalance`` brings the rows of a partition together so that it gets few,
    full files; a partition that is too big for one task is split by AQE.  Leave
    it off where the input is already laid out by the same days.
    ``cluster_columns`` sort rows within files, so that Parquet statistics can
    skip row groups: one column by its values, several along a curve that keeps rows
    close in all of them.
    """
    laid_out = frame
    if rebalance:
        laid_out = laid_out.hint("rebalance", *map(F.col, partition_columns))
    if cluster_columns:
        bounds = range_bounds(frame, cluster_columns)
        laid_out = sorted_within(laid_out, partition_columns, cluster_columns, bounds)
    counted, observation = count_on_write(laid_out, key_column)
    with _open_files(frame.sparkSession, 0 if cluster_columns else MOST_OPEN):
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partition_columns)
            .parquet(path)
        )
    return written(observation, path)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Let a task write so many partitions side by side, rather than sort its rows by
    partition first, which spills where they don't fit.  It sorts what goes beyond."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def count_on_write(
    frame: DataFrame, key_column: str | None
) -> tuple[DataFrame, Observation]:
    observation = Observation()
    is_null = F.lit(False) if key_column is None else F.col(key_column).isNull()
    counted = frame.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(is_null, 1)).alias("null_keys"),
    )
    return counted, observation


def written(observation: Observation, path: str) -> Written:
    counts = observation.get
    if counts.get("rows") is None:
        raise ValueError(f"The write to {path} reported no row count")
    return Written(counts["rows"], counts["null_keys"])


def read_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table with its declared types; the folder value is typed by the schema."""
    return spark.read.schema(schema).parquet(path)


def read_range(
    spark: SparkSession,
    path: str,
    schema: StructType,
    column: str,
    start: date,
    end: date,
) -> DataFrame:
    """The days ``start`` to ``end`` of a table: no other folder is listed."""
    folders = range_folders(spark, path, column, start, end)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def range_folders(
    spark: SparkSession, path: str, column: str, start: date, end: date
) -> list[str]:
    days = list_days(spark, path, column)
    return [_day_folder(path, column, day) for day in days if start <= day <= end]


def list_days(spark: SparkSession, path: str, column: str) -> list[date]:
    """Days a table has folders for: one listing, no scan."""
    prefix = f"{column}="
    return sorted(
        date.fromisoformat(name[len(prefix) :])
        for name in files.names(spark, path)
        if name.startswith(prefix) and name[len(prefix) :][:1].isdigit()
    )


def _day_folder(path: str, column: str, day: date) -> str:
    return f"{path}/{column}={day.isoformat()}"

