"""PayPal pages: ``{page, total_pages, transaction_details: [...]}``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import epoch_bounds
from ledgerline.functions.casts import first_filled, iso_date, money, refused
from ledgerline.sources.landed import (
    LANDED_DATE,
    PAGE,
    empty_if_null,
    kept_columns,
    unpacked,
)
from ledgerline.sources.records import Field, parse_fields, unreadable_or

INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"


def unpack(pages: DataFrame) -> DataFrame:
    """One row per transaction; a page without a list is an empty page."""
    details = empty_if_null(F.col("transaction_details"))
    return unpacked(pages, details)


def in_window(start: date | Column, end: date | Column) -> Column:
    """Initiated from ``start`` 00:00:00 to ``end`` 23:59:59, at offset -0000."""
    initiated = F.col("transaction_info.transaction_initiation_date")
    instant = F.coalesce(
        F.try_to_timestamp(initiated, F.lit(INSTANT_FORMAT)),
        initiated.try_cast("timestamp"),
    )
    first, last = epoch_bounds(start, end)
    return unreadable_or(F.unix_seconds(instant).between(first, last))


def parse(transactions: DataFrame) -> DataFrame:
    info, payer = "transaction_info", "payer_info"
    col = F.col
    reference = col(f"{info}.paypal_reference_id")
    own_id = col(f"{info}.transaction_id")
    initiated = col(f"{info}.transaction_initiation_date")
    # The record's day is the written day; the offset is not applied.
    day = iso_date(F.substring(initiated, 1, 10))

    def required_text(name: str, source: str) -> Field:
        return Field(name, col(source), col(source).isNull())

    def amount(name: str, text: Column) -> Field:
        value = money(text)
        return Field(name, value, refused(text, value))

    def amount_or_zero(name: str, source: str) -> Field:
        return amount(name, F.coalesce(col(source), F.lit("0")))

    fields = [
        Field(
            "transaction_id",
            F.coalesce(F.nullif(reference, F.lit("")), own_id),
            F.coalesce(F.nullif(reference, F.lit("")), own_id).isNull(),
        ),
        Field("transaction_date", day, refused(initiated, day)),
        amount("gross_amount_usd", col(f"{info}.transaction_amount.value")),
        required_text("currency_code", f"{info}.transaction_amount.currency_code"),
        required_text("transaction_status", f"{info}.transaction_status"),
        Field("transaction_subject", first_filled(col(f"{info}.transaction_subject"))),
        Field("payer_email", first_filled(col(f"{payer}.email_address"))),
        Field("payer_name", full_name(col(f"{payer}.payer_name"))),
        amount_or_zero("fee_amount_usd", f"{info}.fee_amount.value"),
        amount_or_zero("net_amount_usd", f"{info}.transaction_net_amount.value"),
    ]
    return parse_fields(transactions, fields, kept_columns(transactions))


def full_name(name: Column) -> Column:
    """Given name and surname joined by a space, leaving out empty parts."""
    return F.concat_ws(
        " ",
        F.nullif(name["given_name"], F.lit("")),
        F.nullif(name["surname"], F.lit("")),
    )


def page_link() -> Column:
    """What a page says of its place: its number and how many there are."""
    return F.struct(
        F.coalesce("page", F.lit(1)).alias("page"),
        F.coalesce("total_pages", F.lit(1)).alias("total"),
    )


def page_report(
    pages: DataFrame, run_columns: tuple[str, ...] = (LANDED_DATE,)
) -> DataFrame:
    return link_report(pages.select(*run_columns, page_link().alias(PAGE)), run_columns)


def link_report(
    links: DataFrame, run_columns: tuple[str, ...] = (LANDED_DATE,)
) -> DataFrame:
    """Per fetch (a run day, unless told otherwise): are its pages whole?

    Each number from 1 to ``total_pages`` must be there once; a page landed
    twice would double its transactions.  A page without a total is the only
    one.
    """
    numbered = links.select(*run_columns, f"{PAGE}.*")
    by_number = numbered.groupBy(*run_columns, "page").agg(
        F.count(F.lit(1)).alias("landed"), F.max("total").alias("total")
    )
    report = by_number.groupBy(*run_columns).agg(
        F.sum("landed").alias("pages_landed"),
        F.count(F.lit(1)).alias("pages_found"),
        F.greatest(F.max("total"), F.lit(1)).alias("pages_expected"),
        F.max("page").alias("last_page"),
    )
    expected = F.col("pages_expected")
    whole = (
        (F.col("pages_landed") == expected)
        & (F.col("pages_found") == expected)
        & (F.col("last_page") == expected)
    )
    return report.withColumn("is_complete", whole)
