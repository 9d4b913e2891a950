"""Analytics reports: rows of dimension and metric values, named by config."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import in_range
from ledgerline.functions.casts import compact_date
from ledgerline.sources.landed import empty_if_null, kept_columns
from ledgerline.sources.records import Field, parse_fields, unreadable_or


@dataclass(frozen=True)
class ReportConfig:
    """Names of the values in each report row, in order."""

    dimension_names: tuple[str, ...]
    metric_names: tuple[str, ...]


DAILY_SESSIONS = ReportConfig(
    dimension_names=("date", "sessionSource", "sessionMedium", "country"),
    metric_names=("sessions", "screenPageViews", "bounceRate", "conversions"),
)


def unpack(reports: DataFrame, config: ReportConfig) -> DataFrame:
    """One row per report row: ``date`` text, dimension and metric value lists."""
    rows = reports.select(
        *kept_columns(reports), F.inline(empty_if_null(F.col("rows")))
    )
    dimensions = F.transform("dimension_values", lambda v: v["value"])
    metrics = F.transform("metric_values", lambda v: v["value"])
    if "date" in config.dimension_names:
        position = config.dimension_names.index("date") + 1
        day = F.try_element_at(dimensions, F.lit(position))
    else:
        day = F.lit("")
    return rows.select(
        *kept_columns(reports),
        day.alias("date"),
        dimensions.alias("dimensions"),
        metrics.alias("metrics"),
    )


def in_window(start: date | Column, end: date | Column) -> Column:
    return unreadable_or(in_range(compact_date(F.col("date")), start, end))


def parse(rows: DataFrame, config: ReportConfig) -> DataFrame:
    """Values as text columns under their configured names; ``date`` typed.

    Names are fixed by the config, so each value is an array position rather
    than a map lookup.  Lists of another length than the names are refused.
    """
    day = compact_date(F.col("date"))
    columns: dict[str, Column] = {}
    for names, values in (
        (config.dimension_names, "dimensions"),
        (config.metric_names, "metrics"),
    ):
        for position, name in enumerate(names, start=1):
            columns[name] = F.try_element_at(F.col(values), F.lit(position))
    columns.pop("date", None)
    uneven = (F.size("dimensions") != len(config.dimension_names)) | (
        F.size("metrics") != len(config.metric_names)
    )
    fields = [Field("date", day, day.isNull())]
    fields += [Field(name, value) for name, value in columns.items()]
    parsed = parse_fields(
        rows.withColumn("uneven", F.coalesce(uneven, F.lit(True))),
        [*fields, Field("row_length", F.col("uneven"), F.col("uneven"))],
        kept_columns(rows),
    )
    return parsed.drop("row_length")


def report(
    reports: DataFrame,
    config: ReportConfig,
    start: date | Column,
    end: date | Column,
) -> DataFrame:
    """Rows of the asked days with the asked dimensions and metrics."""
    return parse(unpack(reports, config).where(in_window(start, end)), config)
