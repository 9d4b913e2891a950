"""Staging models: one cast-and-rename projection per raw table.

No business logic: every column is an explicit cast, and a day range filters
the typed time column, so Spark prunes folders and columns at the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import in_range, micros_to_dollars, safe_divide
from ledgerline.schemas import MONEY


def text(name: str) -> Column:
    return F.col(name).cast("string")


def whole(name: str) -> Column:
    return F.col(name).cast("bigint")


def real(name: str) -> Column:
    return F.col(name).cast("double")


def numeric(name: str) -> Column:
    return F.col(name).cast(MONEY)


def instant(name: str) -> Column:
    return F.col(name).cast("timestamp")


def day(name: str) -> Column:
    """A date, or its ISO text.  On a date the cast is none, so filters on the
    column still prune folders."""
    return F.col(name).cast("date")


def flag(name: str) -> Column:
    """``true`` or ``false`` in any case; any other text fails the job."""
    lowered = F.lower(F.col(name).cast("string"))
    return (
        F.when(lowered == "true", True)
        .when(lowered == "false", False)
        .when(
            lowered.isNotNull(),
            F.raise_error(F.concat(F.lit("Bad bool value: "), lowered)).cast("boolean"),
        )
    )


def _select(raw: DataFrame, casts: dict[str, Column]) -> DataFrame:
    return raw.select(*[value.alias(name) for name, value in casts.items()])


def _same(cast, *names: str) -> dict[str, Column]:
    return {name: cast(name) for name in names}


def stripe_charges(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(text, "charge_id"),
            **_same(day, "charge_date"),
            **_same(
                numeric,
                "gross_amount_usd",
                "amount_captured_usd",
                "fee_usd",
                "net_usd",
            ),
            **_same(
                text,
                "currency",
                "status",
                "description",
                "customer_email",
                "customer_name",
                "payment_intent_id",
            ),
            **_same(instant, "loaded_at"),
        },
    ).where(in_range(F.col("charge_date"), start, end))


def paypal_transactions(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(text, "transaction_id"),
            **_same(day, "transaction_date"),
            **_same(numeric, "gross_amount_usd"),
            **_same(
                text,
                "currency_code",
                "transaction_status",
                "transaction_subject",
                "payer_email",
                "payer_name",
            ),
            **_same(numeric, "fee_amount_usd", "net_amount_usd"),
            **_same(instant, "loaded_at"),
        },
    ).where(in_range(F.col("transaction_date"), start, end))


def google_ads_performance(raw: DataFrame, start: date, end: date) -> DataFrame:
    """Cost in dollars, rounded to cents in decimal, and cost per conversion."""
    cost = micros_to_dollars(F.col("cost_micros"))
    return _select(
        raw,
        {
            **_same(day, "date"),
            **_same(text, "customer_id"),
            **_same(whole, "clicks", "impressions"),
            "cost_usd": cost,
            **_same(real, "conversions"),
            "cost_per_conversion_usd": safe_divide(
                cost.cast("double"), real("conversions")
            ),
        },
    ).where(in_range(F.col("date"), start, end))


def facebook_ads_performance(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(day, "date"),
            **_same(text, "campaign_id", "campaign_name"),
            **_same(whole, "impressions", "clicks"),
            **_same(numeric, "spend_usd"),
            **_same(whole, "reach"),
            **_same(real, "frequency"),
            **_same(whole, "link_clicks", "leads", "conversions"),
            **_same(instant, "loaded_at"),
        },
    ).where(in_range(F.col("date"), start, end))


def analytics_sessions(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(day, "date"),
            "session_source": text("sessionSource"),
            "session_medium": text("sessionMedium"),
            "country": text("country"),
            "sessions": whole("sessions"),
            "page_views": whole("screenPageViews"),
            "bounce_rate": real("bounceRate"),
            "conversions": real("conversions"),
        },
    ).where(in_range(F.col("date"), start, end))


def sheet_inventory(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(text, "sku_id", "sku_name", "program_id"),
            **_same(
                whole, "quantity_on_hand", "reorder_threshold", "reorder_quantity"
            ),
            **_same(numeric, "unit_cost_usd", "units_per_student"),
            **_same(day, "snapshot_date"),
            **_same(instant, "loaded_at"),
        },
    ).where(in_range(F.col("snapshot_date"), start, end))


def sheet_programs(raw: DataFrame) -> DataFrame:
    """Built whole on every run: a small dimension without a time column."""
    return _select(
        raw,
        {
            **_same(text, "program_id", "program_name", "program_code"),
            **_same(whole, "duration_weeks", "max_enrollment"),
            **_same(flag, "is_active"),
            **_same(instant, "loaded_at"),
        },
    )


def sheet_students(raw: DataFrame, start: date, end: date) -> DataFrame:
    return _select(
        raw,
        {
            **_same(
                text,
                "student_id",
                "first_name",
                "last_name",
                "email",
                "phone",
                "program_id",
                "enrollment_status",
            ),
            **_same(day, "enrolled_at", "expected_grad_date", "actual_grad_date"),
            **_same(instant, "loaded_at"),
        },
    ).where(in_range(F.col("enrolled_at"), start, end))

