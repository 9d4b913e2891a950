"""Typed records with a list of refused fields, and what to do about them.

A parser yields its fields plus ``parse_error`` (null for a good record, else
the names of the refused fields) and ``record`` (the landed row as JSON).
``accept`` stops the job on the first bad record; ``rejects`` shows them.  Both
are ordinary projections and filters, so nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.landed import IS_RECORD, PAGE

PARSE_ERROR = "parse_error"
RECORD = "record"


@dataclass(frozen=True)
class Field:
    """One output column; ``bad`` is true where the record must be refused."""

    name: str
    value: Column
    bad: Column | None = None


def parse_fields(rows: DataFrame, fields: list[Field], keep: list[str]) -> DataFrame:
    complaints = [
        F.when(field.bad, F.lit(field.name)) for field in fields if field.bad is not None
    ]
    return rows.select(
        *[field.value.alias(field.name) for field in fields],
        *[column for column in keep if column not in {f.name for f in fields}],
        F.nullif(F.concat_ws(", ", *complaints), F.lit("")).alias(PARSE_ERROR),
        F.to_json(
            F.struct(
                *[
                    F.col(f"`{name}`")
                    for name in rows.columns
                    if name not in (PAGE, IS_RECORD)
                ]
            )
        ).alias(RECORD),
    )


def unreadable_or(in_window: Column) -> Column:
    """Keep rows whose date cannot be read, so that the parser refuses them."""
    return F.coalesce(in_window, F.lit(True))


def accept(parsed: DataFrame, label: str) -> DataFrame:
    """Typed columns only; any refused record fails the job with its text."""
    message = F.concat(
        F.lit(f"Failed to parse {label}: "), PARSE_ERROR, F.lit(" in "), RECORD
    )
    is_good = F.when(F.col(PARSE_ERROR).isNull(), F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return parsed.where(is_good).drop(PARSE_ERROR, RECORD)


def accepted(parsed: DataFrame) -> DataFrame:
    """The good records, leaving the bad ones to ``rejects``."""
    return parsed.where(F.col(PARSE_ERROR).isNull()).drop(PARSE_ERROR, RECORD)


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(PARSE_ERROR).isNotNull())
