"""Ingest: landed documents to the lake, then to day partitions of a raw table.

One job loads any number of days.  Documents are read once, in parallel, and parsed by
column expressions; records, refused records and what pages say of their place among the
others are written to the lake as one attempt of the run.  Whether pages are whole, which
days have refused records and how many rows a day has is asked of those files, and only
then the attempt is committed and its days replace those of the table.  Nothing passes
through the driver but counts per day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.functions.calc import month_start, whole_months
from ledgerline.operators import attempts, files, snapshots
from ledgerline.operators.partitions import list_days, write_days
from ledgerline.operators.run_days import calendar_days
from ledgerline.plans.warehouse import SNAPSHOT_DATE, Warehouse
from ledgerline.schemas import RAW, RUN_LOG, StringType
from ledgerline.sources import (
    facebook_ads,
    google_ads,
    google_analytics,
    google_sheets,
    paypal,
    stripe,
)
from ledgerline.sources.landed import IS_RECORD, LANDED_DATE, PAGE, landed_between, within
from ledgerline.sources.records import PARSE_ERROR, RECORD

FAIL_RUN, FAIL_DAY = "fail run", "fail day"


class IncompletePages(ValueError):
    """A page of a landed set is missing."""


@dataclass(frozen=True)
class Source:
    """How the documents of one source become records of one raw table."""

    table: str
    landed_schema: StructType
    # Takes documents and the first and last day asked for, as columns.
    parse: Callable[[DataFrame, Column, Column], DataFrame]
    partition_column: str
    # What a page says of its place, and the report made of it.
    page_link: Callable[[], Column] | None = None
    page_report: Callable[[DataFrame], DataFrame] | None = None
    sheet_name: str | None = None
    cluster_columns: tuple[str, ...] = ()
    # Column and value that tell apart what is loaded on its own within a day.
    scope: tuple[str, str] | None = None

    @property
    def kept_by(self) -> list[str]:
        """Columns whose values are replaced together."""
        return [self.partition_column, *([self.scope[0]] if self.scope else [])]


STRIPE = Source(
    "stripe_charges",
    schemas.STRIPE_PAGE,
    lambda docs, start, end: stripe.parse(
        within(stripe.unpack(docs), stripe.in_window(start, end))
    ),
    "charge_date",
    stripe.page_link,
    stripe.link_report,
)
PAYPAL = Source(
    "paypal_transactions",
    schemas.PAYPAL_PAGE,
    lambda docs, start, end: paypal.parse(
        within(paypal.unpack(docs), paypal.in_window(start, end))
    ),
    "transaction_date",
    paypal.page_link,
    paypal.link_report,
)
FACEBOOK_ADS = Source(
    "facebook_ads",
    schemas.FACEBOOK_INSIGHT,
    lambda docs, start, end: facebook_ads.parse(
        facebook_ads.unpack(docs).where(facebook_ads.in_window(start, end))
    ),
    "date",
)
GOOGLE_ANALYTICS = Source(
    "google_analytics",
    schemas.ANALYTICS_REPORT,
    lambda docs, start, end: google_analytics.report(
        docs, google_analytics.DAILY_SESSIONS, start, end
    ),
    "date",
)


def google_ads_account(customer_id: str) -> Source:
    """The ads report of one account; its id is not in the rows.

    Accounts are loaded one by one: each replaces its own rows of a day only.
    """
    return Source(
        "google_ads",
        schemas.GOOGLE_ADS_ROW,
        lambda docs, start, end: google_ads.parse(
            google_ads.unpack(docs, F.lit(customer_id)).where(
                google_ads.in_window(start, end)
            )
        ),
        "date",
        scope=("customer_id", customer_id),
    )


def sheet(name: str) -> Source:
    """One whole sheet per landed day."""
    return Source(
        f"google_sheets_{name}",
        schemas.SHEET_VALUES,
        lambda docs, start, end: google_sheets.parse(
            google_sheets.unpack(docs.where(F.col("sheet") == name)),
            google_sheets.SHEETS[name],
        ),
        SNAPSHOT_DATE,
        sheet_name=name,
    )


def add_loaded_at(frame: DataFrame, run_time: datetime) -> DataFrame:
    """Append one UTC instant, the same for all rows; kept on empty frames."""
    moment = run_time.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    micros = (moment.days * 86_400 + moment.seconds) * 1_000_000 + moment.microseconds
    return frame.withColumn("loaded_at", F.timestamp_micros(F.lit(micros)))


def append_to_lake(
    records: DataFrame, warehouse: Warehouse, source: str, run_id: str
) -> int:
    """Keep this run's records; other runs and attempts of the same days stay.

    ``records`` has a ``partition_date``.  A run id that is used again makes a further
    attempt, which readers take for the days it has, so a retried job does not double
    its rows.
    """
    lake, spark, name = warehouse.lake_path(source), warehouse.spark, attempts.new_name()
    kinded = records.withColumn("kind", F.lit(attempts.RECORD))
    rows = _write_attempt(kinded, lake, run_id, name)
    days = list_days(spark, lake, "partition_date")
    found = attempts.folders(spark, lake, run_id, name, days)
    attempts.commit(spark, lake, run_id, name, "", found, found)
    return rows


def _write_attempt(rows: DataFrame, lake: str, run_id: str, name: str) -> int:
    # The run and its attempt are the same for all rows: they are added behind the shuffle.
    laid_out = rows.hint("rebalance", F.col("partition_date"), F.col("kind"))
    return write_days(
        laid_out.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(name)}),
        lake,
        ["partition_date", "run_id", "attempt", "kind"],
        rebalance=False,
    ).rows


def _lake_schema(source: str) -> StructType:
    schema = StructType([f for f in RAW[source].fields if f.name != SNAPSHOT_DATE])
    return schema.add("partition_date", RUN_LOG["partition_date"].dataType).add(
        "run_id", StringType()
    )


def read_lake_run(
    warehouse: Warehouse,
    source: str,
    run_id: str,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """One run's records, of the days ``start`` to ``end`` where they are given.

    The lake holds every run, so a run must be named; of its attempts the last finished
    one of each day counts.  Only the folders of those are listed.
    """
    folders = attempts.standing(
        warehouse.spark, warehouse.lake_path(source), run_id, start, end
    )
    return _read_folders(warehouse, source, [f"{f}/kind={attempts.RECORD}" for f in folders])


def _read_folders(
    warehouse: Warehouse, source: str, folders: list[str], *more: str
) -> DataFrame:
    """Records, or other rows with the columns ``more``, of some folders of the lake."""
    schema = _lake_schema(source)
    for column in more:
        schema = schema.add(column, StringType())
    spark = warehouse.spark
    folders = [folder for folder in folders if files.exists(spark, folder)]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", warehouse.lake_path(source))
    return reader.parquet(*folders).select(*schema.fieldNames())


def read_rejects(warehouse: Warehouse, source: str, run_id: str, attempt: str) -> DataFrame:
    """Refused records of an attempt, finished or not: the day, why, and the record."""
    lake = warehouse.lake_path(source)
    days = list_days(warehouse.spark, lake, "partition_date")
    found = attempts.folders(warehouse.spark, lake, run_id, attempt, days)
    folders = [f"{folder}/kind={attempts.REJECT}" for folder in found.values()]
    rows = _read_folders(warehouse, source, folders, PARSE_ERROR, RECORD)
    return rows.select("partition_date", PARSE_ERROR, RECORD)


def load_partitions(
    records: DataFrame,
    warehouse: Warehouse,
    table: str,
    partition_column: str | list[str] = "date",
    cluster_columns: tuple[str, ...] = (),
    rebalance: bool = True,
) -> int:
    """Replace the days of ``raw.<table>`` that ``records`` has; rows loaded.

    With several partition columns, such as day and account, each pair of values that
    ``records`` has is replaced, and other accounts of the day stay.
    """
    by = [partition_column] if isinstance(partition_column, str) else partition_column
    rows = write_days(
        records,
        warehouse.path(f"raw.{table}"),
        by,
        cluster_columns,
        rebalance,
    ).rows
    if table == "google_sheets_inventory" and rows:
        _keep_landings(records, warehouse, table)
    return rows


def _keep_landings(records: DataFrame, warehouse: Warehouse, table: str) -> None:
    """Keep which snapshot dates the loaded landings hold, in place of what they held."""
    spark, path = warehouse.spark, warehouse.landings_path(table)
    before = snapshots.current(spark, path)
    build, made = snapshots.new_build(path)
    held = records.select("snapshot_date", F.col(SNAPSHOT_DATE).cast("date")).distinct()
    write_days(held, made, [SNAPSHOT_DATE])
    days = list_days(spark, made, SNAPSHOT_DATE)
    builds = before.builds | {str(day): build for day in days}
    snapshots.publish(spark, path, before, builds, held.schema, SNAPSHOT_DATE)
    snapshots.sweep(spark, path)


def ingest(
    source: Source,
    documents: DataFrame,
    warehouse: Warehouse,
    start: date,
    end: date,
    run_id: str,
    run_time: datetime,
    on_bad_record: str = FAIL_RUN,
) -> DataFrame:
    """Load the days ``start`` to ``end`` of one source; this run's log rows.

    Every document is read as the run of its own landed day would read it, so a range
    gives what its days give one by one.  A day that was landed without rows is logged
    as skipped, one that was never landed as missing; their partitions stay as they
    are.  A bad record fails the whole run before anything is replaced, or, with
    ``FAIL_DAY``, only the day it was landed for.  So does a record whose partition is
    another day than it was landed for: replacing that day by a part of its rows would
    lose the others.

    A run id that is used again makes a further attempt in the lake.  The earlier one
    counts until this one is committed: after all rows are written and judged, before the
    table's days are replaced.
    """
    spark, lake = warehouse.spark, warehouse.lake_path(source.table)
    name, seen = attempts.new_name(), DaysSeen(start, end)
    landed = seen.watch(landed_between(documents, start, end))
    _write_attempt(add_loaded_at(_judged(source, landed), run_time), lake, run_id, name)
    there = seen.days()
    folders = attempts.folders(spark, lake, run_id, name, there)
    if source.page_link is not None:
        links = _links(source, warehouse, list(folders.values()))
        _require_whole(source.page_report(links), source.table)
    failed = [
        day for day, folder in folders.items()
        if files.exists(spark, f"{folder}/kind={attempts.REJECT}")
    ]
    if failed and on_bad_record != FAIL_DAY:
        refused = read_rejects(warehouse, source.table, run_id, name)
        worst = refused.orderBy("partition_date", PARSE_ERROR, RECORD).head()
        raise BadRecord(
            f"Failed to parse {source.table}: {worst[PARSE_ERROR]} in {worst[RECORD]}"
        )
    good = [f"{f}/kind={attempts.RECORD}" for day, f in folders.items() if day not in failed]
    run = _read_folders(warehouse, source.table, good)
    # At most one row per day of the range.
    per_day = run.groupBy("partition_date").agg(F.count(F.lit(1)).alias("rows"))
    rows = {r["partition_date"]: r["rows"] for r in per_day.collect()}
    asked = (start + timedelta(n) for n in range((end - start).days + 1))
    attempts.commit(
        spark, lake, run_id, name,
        "=".join(source.scope or ()),
        [day for day in asked if day not in failed],
        rows,
    )
    if rows:
        records = run.withColumn(source.partition_column, F.col("partition_date"))
        loaded = load_partitions(
            records.select(*RAW[source.table].fieldNames()),
            warehouse,
            source.table,
            source.kept_by,
            source.cluster_columns,
            rebalance=False,
        )
        if loaded != sum(rows.values()):
            raise ValueError(
                f"{source.table}: {sum(rows.values())} rows kept, {loaded} loaded"
            )
    return log_run(source, warehouse, start, end, run_id, name, run_time, rows, failed, there)


class BadRecord(ValueError):
    """A landed record has been refused."""


class DaysSeen:
    """Which days of a range have documents, told by the job that reads them.

    Days are bits of one number for each ``WIDTH`` of them, combined by ``or``, so a task
    that runs twice changes nothing.
    """

    WIDTH = 60

    def __init__(self, start: date, end: date):
        self.start, self.count = start, (end - start).days + 1
        self.seen = Observation()

    def watch(self, documents: DataFrame) -> DataFrame:
        place = F.datediff(F.col(LANDED_DATE), F.lit(self.start))
        bits = [
            F.bit_or(
                F.when(
                    place.between(low, low + self.WIDTH - 1),
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), place - low),
                )
            ).alias(f"days_{low}")
            for low in range(0, max(self.count, 1), self.WIDTH)
        ]
        return documents.observe(self.seen, *bits)

    def days(self) -> list[date]:
        told = self.seen.get
        return [
            self.start + timedelta(n)
            for n in range(self.count)
            if (told.get(f"days_{n - n % self.WIDTH}") or 0) >> n % self.WIDTH & 1
        ]


def _judged(source: Source, landed: DataFrame) -> DataFrame:
    """Every row of an attempt: records and refused ones in the windows of their own landed
    days, and what pages say of their place.

    A record of another day than it was landed for is refused.
    """
    if source.page_link is not None:
        landed = landed.withColumn(PAGE, source.page_link())
    parsed = source.parse(landed, F.col(LANDED_DATE), F.col(LANDED_DATE))
    day = _day_column(source)
    error = F.col(PARSE_ERROR)
    if day != LANDED_DATE:
        strays = F.when(F.col(day) != F.col(LANDED_DATE), F.lit(f"{day} of another run day"))
        error = F.coalesce(PARSE_ERROR, strays)
    kind = F.when(error.isNull(), attempts.RECORD).otherwise(attempts.REJECT)
    if source.page_link is not None:
        kind = F.when(F.col(IS_RECORD), kind).otherwise(attempts.PAGE_ONLY)
    refused = kind == attempts.REJECT
    return parsed.withColumns(
        {
            "kind": kind,
            PARSE_ERROR: F.when(refused, error),
            RECORD: F.when(refused, F.col(RECORD)),
            "partition_date": F.col(LANDED_DATE),
        }
    ).drop(LANDED_DATE, IS_RECORD)


def _links(source: Source, warehouse: Warehouse, folders: list[str]) -> DataFrame:
    """What the pages of an attempt say, one row per page; no other column is read."""
    spark = warehouse.spark
    empty = spark.createDataFrame([], source.landed_schema)
    link = empty.select(source.page_link().alias(PAGE)).schema[PAGE]
    schema = StructType([link, RUN_LOG["partition_date"]])
    if not folders:
        rows = spark.createDataFrame([], schema)
    else:
        reader = spark.read.schema(schema).option("basePath", warehouse.lake_path(source.table))
        rows = reader.parquet(*folders).where(F.col(PAGE).isNotNull())
    return rows.select(PAGE, F.col("partition_date").alias(LANDED_DATE))


def _day_column(source: Source) -> str:
    by_landing = source.partition_column == SNAPSHOT_DATE
    return LANDED_DATE if by_landing else source.partition_column


def log_run(
    source: Source,
    warehouse: Warehouse,
    start: date,
    end: date,
    run_id: str,
    attempt: str,
    run_time: datetime,
    rows: dict[date, int],
    failed: list[date],
    landed: list[date],
) -> DataFrame:
    """Append one row per day of the run, and return them."""
    spark, lake = warehouse.spark, warehouse.lake_path(source.table)
    counts = spark.createDataFrame(list(rows.items()), "partition_date date, rows bigint")
    days = calendar_days(spark, start, end).join(F.broadcast(counts), "partition_date", "left")
    rows_loaded = F.coalesce("rows", F.lit(0).cast("bigint"))
    is_failed = F.col("partition_date").isin(failed) if failed else F.lit(False)
    is_landed = F.col("partition_date").isin(landed) if landed else F.lit(False)
    log = add_loaded_at(
        days.select(
            F.lit(source.table).alias("source"),
            "partition_date",
            F.lit(run_id).alias("run_id"),
            F.when(is_failed, "failed")
            .when(rows_loaded > 0, "loaded")
            .when(is_landed, "skipped")
            .otherwise("missing")
            .alias("status"),
            rows_loaded.alias("rows_loaded"),
            F.when(
                rows_loaded > 0,
                F.concat(
                    F.lit(f"{lake}/partition_date="),
                    F.col("partition_date").cast("string"),
                    F.lit(f"/run_id={run_id}/attempt={attempt}"),
                ),
            ).alias("uri"),
            F.lit(source.sheet_name).cast("string").alias("sheet_name"),
        ),
        run_time,
    ).withColumnRenamed("loaded_at", "logged_at")
    _replace_log_rows(warehouse, source.table, log, start, end)
    return warehouse.run_log(source.table).where(F.col("run_id") == run_id)


def _replace_log_rows(
    warehouse: Warehouse, table: str, log: DataFrame, start: date, end: date
) -> None:
    """Put a run's rows into the log in place of any it has for the same days.

    The log of a source is kept by month, each in one file; the months of the run are
    written anew and published in one step, so rows are neither lost nor doubled, and the
    log has as many files as months.
    """
    spark, path = warehouse.spark, warehouse.log_path(table)
    first, last = whole_months(start, end)
    while True:
        before = snapshots.current(spark, path)
        old = snapshots.read(spark, path, RUN_LOG, first, last)
        kept = old.join(F.broadcast(log), ["run_id", "partition_date"], "left_anti")
        rows = kept.unionByName(log).withColumn("month", month_start(F.col("partition_date")))
        build, made = snapshots.new_build(path)
        rows.repartition("month").write.partitionBy("month").parquet(made)
        months = list_days(spark, made, "month")
        builds = snapshots.with_range(before, build, months, first, last)
        try:
            snapshots.publish(spark, path, before, builds, rows.schema, "month")
        except snapshots.Overtaken:
            # Another run of this source has been logged meanwhile: begin from there.
            files.delete(spark, made)
            continue
        snapshots.sweep(spark, path)
        return


def _require_whole(report: DataFrame, table: str) -> None:
    # At most one row per day of the run.
    holes = report.where(~F.col("is_complete")).select(LANDED_DATE).distinct().collect()
    if holes:
        days = ", ".join(sorted(str(row[LANDED_DATE]) for row in holes))
        raise IncompletePages(f"{table}: pages are missing for {days}")


__all__ = [
    "FACEBOOK_ADS",
    "FAIL_DAY",
    "FAIL_RUN",
    "GOOGLE_ANALYTICS",
    "PAYPAL",
    "STRIPE",
    "BadRecord",
    "IncompletePages",
    "Source",
    "add_loaded_at",
    "append_to_lake",
    "google_ads_account",
    "ingest",
    "load_partitions",
    "log_run",
    "read_lake_run",
    "read_rejects",
    "sheet",
]
