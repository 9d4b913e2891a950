"""Sheets: ``values`` is a list of rows, the first of which names the columns.

A document is one whole sheet as the vendor returns it, so the vendor's cell
limit bounds it; documents of different days and sheets are read in parallel.
The header is looked up once per document, and rows are then exploded with the
column positions at hand: no join with the header row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.landed import kept_columns
from ledgerline.sources.records import Field, parse_fields

STUDENTS = (
    "student_id",
    "first_name",
    "last_name",
    "email",
    "phone",
    "program_id",
    "enrollment_status",
    "enrolled_at",
    "expected_grad_date",
    "actual_grad_date",
)
PROGRAMS = (
    "program_id",
    "program_name",
    "program_code",
    "duration_weeks",
    "max_enrollment",
    "is_active",
)
INVENTORY = (
    "sku_id",
    "sku_name",
    "program_id",
    "quantity_on_hand",
    "reorder_threshold",
    "reorder_quantity",
    "unit_cost_usd",
    "units_per_student",
    "snapshot_date",
)
SHEETS = {"students": STUDENTS, "programs": PROGRAMS, "inventory": INVENTORY}


def unpack(documents: DataFrame) -> DataFrame:
    """One row per sheet row, with the sheet's header beside it."""
    empty = F.coalesce(F.size("values") < 1, F.lit(True))
    header = F.when(
        empty,
        F.raise_error(
            F.concat(
                F.lit("Sheet '"),
                F.coalesce("sheet", F.lit("")),
                F.lit("' is empty or has no header row"),
            )
        ).cast("array<string>"),
    ).otherwise(F.try_element_at("values", F.lit(1)))
    body = F.slice("values", F.lit(2), F.greatest(F.size("values") - 1, F.lit(0)))
    kept = kept_columns(documents)
    # The emptiness check rides on a filter, so pruning cannot remove it.
    return (
        documents.where(F.size(header) >= 0)
        .select(*kept, "sheet", F.element_at("values", 1).alias("header"), body.alias("body"))
        .select(*kept, "sheet", "header", F.explode("body").alias("row"))
    )


def parse(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Text columns by header name; a repeated header's last column wins.

    Columns that aren't asked for are kept as one JSON object, ``other_columns``; null
    where there are none.
    """
    fields = [*[_cell(name) for name in columns], Field("other_columns", _others(columns))]
    uneven = F.size("header") != F.size("row")
    parsed = parse_fields(
        rows,
        [*fields, Field("row_length", uneven, F.coalesce(uneven, F.lit(True)))],
        kept_columns(rows),
    )
    return parsed.drop("row_length")


def _cell(name: str) -> Field:
    from_end = F.array_position(F.reverse(F.col("header")), name)
    position = (F.size("header") - from_end + 1).cast("int")
    value: Column = F.when(from_end > 0, F.try_element_at(F.col("row"), position))
    return Field(name, value, from_end == 0)


def _others(columns: tuple[str, ...]) -> Column:
    known = F.array(*[F.lit(name) for name in columns])
    backwards = F.reverse(F.col("header"))

    def is_other(cell: Column) -> Column:
        from_end = F.size("header") - cell["place"]
        last = F.array_position(backwards, cell["key"]) == from_end
        return last & ~F.array_contains(known, cell["key"])

    cells = F.transform(
        "header",
        lambda name, n: F.struct(
            name.alias("key"), F.get("row", n).alias("value"), n.alias("place")
        ),
    )
    kept = F.transform(F.filter(cells, is_other), lambda c: F.struct(c["key"], c["value"]))
    return F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept)))
