"""Google Ads rows: ``{segments: {date}, metrics: {clicks, ...}}``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from ledgerline.functions.calc import in_range
from ledgerline.functions.casts import iso_date, real_number, refused, whole_number
from ledgerline.sources.landed import kept_columns
from ledgerline.sources.records import Field, parse_fields, unreadable_or


def flatten_struct(rows: DataFrame) -> DataFrame:
    """One level of nesting to ``outer.inner`` columns; scalars stay.

    Deeper nesting is refused from the schema, before any job runs.
    """
    flat: list[Column] = []
    for field in rows.schema.fields:
        if not isinstance(field.dataType, StructType):
            flat.append(F.col(f"`{field.name}`"))
            continue
        for inner in field.dataType.fields:
            path = f"{field.name}.{inner.name}"
            if isinstance(inner.dataType, (StructType, MapType)):
                raise ValueError(f"Expected scalar value for {path}, got a nested one")
            flat.append(F.col(f"`{field.name}`")[inner.name].alias(path))
    return rows.select(*flat)


def unpack(documents: DataFrame, customer_id: Column) -> DataFrame:
    """Flattened rows with the account they were asked for."""
    return flatten_struct(documents).withColumn("customer_id", customer_id)


def on_day(day: date) -> Column:
    return F.col("`segments.date`") == F.lit(day.isoformat())


def in_window(start: date | Column, end: date | Column) -> Column:
    return unreadable_or(in_range(iso_date(F.col("`segments.date`")), start, end))


def parse(rows: DataFrame) -> DataFrame:
    day_text = F.col("`segments.date`")
    day = iso_date(day_text)

    def metric(name: str, source: str, read) -> Field:
        text = F.col(f"`metrics.{source}`")
        return Field(name, read(text), refused(text, read(text)))

    fields = [
        Field("date", day, refused(day_text, day)),
        metric("clicks", "clicks", whole_number),
        metric("impressions", "impressions", whole_number),
        metric("cost_micros", "costMicros", whole_number),
        metric("conversions", "conversions", real_number),
        Field("customer_id", F.col("customer_id"), F.col("customer_id").isNull()),
    ]
    return parse_fields(rows, fields, kept_columns(rows))

