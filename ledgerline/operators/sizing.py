"""When a join side may be broadcast.

A side is broadcast only after it has been measured, or where its size follows
from the query's own parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A frame with one narrow row per day stays under about 2 MB up to this length.
MAX_BROADCAST_DAYS = 20_000


@dataclass(frozen=True)
class SizeLimit:
    rows: int
    text_bytes: int


# What may be a constant of a plan.
IN_PLAN_LIMIT = SizeLimit(rows=2_000, text_bytes=1 << 20)
HASH_JOIN_LIMIT = SizeLimit(rows=200_000, text_bytes=16 << 20)


def fits(frame: DataFrame, text_columns: list[str], limit: SizeLimit) -> bool:
    """Measure rows and text bytes of ``frame`` with one small aggregate."""
    text_bytes = F.lit(0)
    for name in text_columns:
        text_bytes = text_bytes + F.coalesce(F.octet_length(name), F.lit(0))
    measured = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text_bytes), F.lit(0)).alias("text_bytes"),
    ).head()
    return (
        measured["rows"] <= limit.rows and measured["text_bytes"] <= limit.text_bytes
    )


def one_row_per_day(frame: DataFrame, start: date, end: date) -> DataFrame:
    """Broadcast a frame grouped by day: the day range bounds its rows."""
    days = (end - start).days + 1
    return F.broadcast(frame) if days <= MAX_BROADCAST_DAYS else frame
