"""Audits: null keys fail a run, repeated grain keys are reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class AuditError(ValueError):
    """A model holds rows with a null key."""


def null_rows(frame: DataFrame, column: str) -> DataFrame:
    """The rows an ``assert no nulls`` audit objects to."""
    return frame.where(F.col(column).isNull())


def assert_no_nulls(frame: DataFrame, column: str, name: str) -> None:
    """Raise if there is such a row; stops at the first one found."""
    offender = null_rows(frame, column).limit(1).collect()
    if offender:
        raise AuditError(f"{name}: null {column} in {offender[0].asDict()}")


def null_count(frame: DataFrame, column: str, name: str) -> DataFrame:
    """One row: how many rows the audit of this model objects to."""
    return frame.agg(
        F.count(F.when(F.col(column).isNull(), 1)).alias("null_rows"),
    ).select(
        F.lit(name).alias("model"), F.lit(column).alias("audited_column"), "null_rows"
    )


def repeated_keys(frame: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    """Grain keys that more than one row has, with the number of rows."""
    return (
        frame.groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def grain_summary(frame: DataFrame, grain: tuple[str, ...], name: str) -> DataFrame:
    """One row per model: keys, repeated keys, most rows for one key."""
    per_key = frame.groupBy(*grain).agg(F.count(F.lit(1)).alias("row_count"))
    return per_key.agg(
        F.count(F.lit(1)).alias("grain_keys"),
        F.count(F.when(F.col("row_count") > 1, 1)).alias("repeated_keys"),
        F.coalesce(F.max("row_count"), F.lit(0)).alias("most_rows_per_key"),
    ).select(
        F.lit(name).alias("model"),
        F.lit(", ".join(grain)).alias("grain"),
        "grain_keys",
        "repeated_keys",
        "most_rows_per_key",
    )
