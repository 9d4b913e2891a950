"""Where tables live, and how each is read back."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calc import in_range
from ledgerline.operators import files, snapshots
from ledgerline.operators.partitions import (
    list_days,
    read_days,
    read_range,
)
from ledgerline.operators.sizing import HASH_JOIN_LIMIT, fits
from ledgerline.schemas import LANDINGS, RAW, RUN_LOG, STAGING
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.records import unreadable_or

SNAPSHOT_DATE = "partition_date"


@dataclass(frozen=True)
class Warehouse:
    """Folders ``lake``, ``raw``, ``staging`` and ``marts`` under one root."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def lake_path(self, source: str) -> str:
        return f"{self.root}/lake/{source}"

    def read(self, name: str) -> DataFrame:
        layer, table = name.split(".")
        if layer == "raw":
            return self._read_raw(table)
        # Staging tables have declared columns, marts those they were published with.
        return snapshots.read(self.spark, self.path(name), STAGING.get(table))

    def read_range(self, name: str, column: str, start: date, end: date) -> DataFrame:
        """Day folders ``start`` to ``end`` of a table kept by ``column``."""
        layer, table = name.split(".")
        if layer != "raw":
            return snapshots.read(self.spark, self.path(name), STAGING.get(table), start, end)
        schema = RAW[table]
        return read_range(
            self.spark, self.path(name), schema, column, start, end
        ).select(*schema.fieldNames())

    def read_whole(self, name: str, start: date, end: date) -> DataFrame:
        """A table that isn't kept by the days of a run: sheets, programs.

        Of the inventory only snapshots of those days are wanted, each from the last
        landing that holds it, whenever that was; no other landing is read.
        """
        if name != "raw.google_sheets_inventory":
            return self.read(name)
        taken = F.col("snapshot_date").try_cast("date")
        return self._last_landings("google_sheets_inventory", in_range(taken, start, end))

    def _last_landings(self, table: str, wanted: Column) -> DataFrame:
        """Rows of each wanted snapshot date from the last landing that holds it.

        The list of what each landing holds has a row per landing and snapshot date; the
        wanted part of it, one row per snapshot date, is measured before it is broadcast.
        """
        spark, schema, path = self.spark, RAW[table], self.path(f"raw.{table}")
        held = snapshots.read(spark, self.landings_path(table), LANDINGS)
        ensure_checkpoint_dir(spark)
        last = (
            held.where(unreadable_or(wanted))
            .groupBy("snapshot_date")
            .agg(F.max(SNAPSHOT_DATE).alias(SNAPSHOT_DATE))
            .checkpoint()
        )
        # As many days as there are landings, at most.
        days = [row[0] for row in last.select(SNAPSHOT_DATE).distinct().collect()]
        folders = [f"{path}/{SNAPSHOT_DATE}={day}" for day in sorted(days)]
        if not folders:
            return spark.createDataFrame([], schema)
        if fits(last, ["snapshot_date"], HASH_JOIN_LIMIT):
            last = F.broadcast(last)
        rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
        same = F.col("r.snapshot_date").eqNullSafe(F.col("l.snapshot_date")) & (
            F.col(f"r.{SNAPSHOT_DATE}") == F.col(f"l.{SNAPSHOT_DATE}")
        )
        return rows.alias("r").join(last.alias("l"), same, "left_semi").select(*schema.fieldNames())

    def _read_raw(self, table: str) -> DataFrame:
        path, schema = self.path(f"raw.{table}"), RAW[table]
        if table == "google_sheets_inventory":
            return self._last_landings(table, F.lit(True))
        if table.startswith("google_sheets_"):
            # A sheet is landed whole every day: only its last landing counts.
            days = list_days(self.spark, path, SNAPSHOT_DATE)
            last = days[-1] if days else date.min
            return read_range(self.spark, path, schema, SNAPSHOT_DATE, last, last)
        return read_days(self.spark, path, schema)

    def log_path(self, source: str) -> str:
        return f"{self.root}/run_log/{source}"

    def run_log(self, *sources: str) -> DataFrame:
        """The log of some sources, or of all; one row per source, run and day."""
        home = f"{self.root}/run_log"
        logs = [
            snapshots.read(self.spark, f"{home}/{source}", RUN_LOG)
            for source in sources or sorted(files.names(self.spark, home))
        ]
        return reduce(DataFrame.unionByName, logs or [self.spark.createDataFrame([], RUN_LOG)])

    def landings_path(self, table: str) -> str:
        return f"{self.root}/raw_landings/{table}"

