"""Run days: the calendar of daily partitions and the days still missing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: history starts here.
FIRST_DAY = date(2024, 1, 1)


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both inclusive."""
    count = max((end - start).days + 1, 0)
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, count, 1, 1).select(day.alias("partition_date"))


def missing_days(calendar: DataFrame, run_log: DataFrame, source: str) -> DataFrame:
    """Days of the calendar without a finished load of ``source``.

    A day that was landed without rows is finished too; one that was never landed isn't.
    """
    finished = (
        run_log.where(
            (F.col("source") == source) & F.col("status").isin("loaded", "skipped")
        )
        .select("partition_date")
        .distinct()
    )
    return calendar.join(finished, "partition_date", "left_anti")
