"""Facebook campaign insights: one row per campaign and day, with actions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import in_range
from ledgerline.functions.casts import (
    iso_date,
    money,
    real_number,
    refused,
    truncated_number,
    whole_number,
)
from ledgerline.sources.landed import empty_if_null, kept_columns
from ledgerline.sources.records import Field, parse_fields, unreadable_or

# The vendor's names of the three counted actions.
ACTION_COLUMNS = {
    "link_clicks": "link_click",
    "leads": "lead",
    "conversions": "offsite_conversion.fb_pixel_purchase",
}


def unpack(insights: DataFrame) -> DataFrame:
    """Insight rows; a missing action list is an empty one."""
    return insights.withColumn("actions", empty_if_null(F.col("actions")))


def in_window(start: date | Column, end: date | Column) -> Column:
    return unreadable_or(in_range(iso_date(F.col("date_start")), start, end))


def parse(rows: DataFrame) -> DataFrame:
    col = F.col

    def read(name: str, source: str, reader) -> Field:
        value = reader(col(source))
        return Field(name, value, refused(col(source), value))

    def text(name: str) -> Field:
        return Field(name, col(name), col(name).isNull())

    def action(name: str, action_type: str) -> Field:
        value = truncated_number(last_action(col("actions"), action_type))
        return Field(name, value, value.isNull())

    nameless = F.exists(
        "actions", lambda a: a["action_type"].isNull() | a["value"].isNull()
    )
    fields = [
        read("date", "date_start", iso_date),
        text("campaign_id"),
        text("campaign_name"),
        read("impressions", "impressions", whole_number),
        read("clicks", "clicks", whole_number),
        read("spend_usd", "spend", money),
        read("reach", "reach", whole_number),
        read("frequency", "frequency", real_number),
        *[action(name, kind) for name, kind in ACTION_COLUMNS.items()],
    ]
    parsed = parse_fields(
        rows, [*fields, Field("actions", nameless, nameless)], kept_columns(rows)
    )
    return parsed.drop("actions")


def last_action(actions: Column, action_type: str) -> Column:
    """Value of the last action of a type, ``"0"`` where there is none."""
    matching = F.filter(actions, lambda a: a["action_type"] == action_type)
    values = F.transform(matching, lambda a: a["value"])
    return F.coalesce(F.try_element_at(values, F.lit(-1)), F.lit("0"))
