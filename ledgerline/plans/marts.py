"""The three marts.  Each step is a function, so it can be run on its own.

Every step aggregates before it joins: what reaches a join is one row per day,
per (month, subject) or per program, combined map-side first.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import (
    in_range,
    month_start,
    safe_divide,
    times_count,
)
from ledgerline.operators.program_match import match_programs
from ledgerline.operators.sizing import HASH_JOIN_LIMIT, fits, one_row_per_day
from ledgerline.schemas import COUNT, WIDE_MONEY
from ledgerline.session import ensure_checkpoint_dir

# What counts as paid traffic, as settled, as studying.
PAID_SOURCES = ("google", "cpc", "paid")
STRIPE_SETTLED = "succeeded"
PAYPAL_SETTLED = "S"
ACTIVE = "active"
REORDER_SOON_DAYS = 14


# -- revenue by program ------------------------------------------------------


def stripe_revenue(charges: DataFrame, start: date, end: date) -> DataFrame:
    settled = charges.where(
        (F.col("status") == STRIPE_SETTLED) & in_range(F.col("charge_date"), start, end)
    )
    return settled.groupBy(
        month_start(F.col("charge_date")).alias("month"),
        F.col("description").alias("transaction_subject"),
    ).agg(
        F.sum("gross_amount_usd").alias("gross_revenue"),
        F.sum("fee_usd").alias("total_fees"),
        F.sum("net_usd").alias("net_revenue"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.lit("stripe").alias("payment_source"),
    )


def paypal_revenue(transactions: DataFrame, start: date, end: date) -> DataFrame:
    """Fees come as negative amounts and are published as positive totals."""
    settled = transactions.where(
        (F.col("transaction_status") == PAYPAL_SETTLED)
        & in_range(F.col("transaction_date"), start, end)
    )
    return settled.groupBy(
        month_start(F.col("transaction_date")).alias("month"), "transaction_subject"
    ).agg(
        F.sum("gross_amount_usd").alias("gross_revenue"),
        (-F.sum("fee_amount_usd")).alias("total_fees"),
        F.sum("net_amount_usd").alias("net_revenue"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.lit("paypal").alias("payment_source"),
    )


def combined_revenue(stripe: DataFrame, paypal: DataFrame) -> DataFrame:
    return stripe.unionByName(paypal)


def revenue_by_program(
    charges: DataFrame,
    transactions: DataFrame,
    programs: DataFrame,
    start: date,
    end: date,
) -> DataFrame:
    """Monthly revenue by program and payment source.

    The range filters days and, again, the derived month: only months whose
    first day lies in it are published.  Give whole months.  A subject that
    names several programs counts in full for each, so sums over programs may
    exceed the revenue.
    """
    combined = combined_revenue(
        stripe_revenue(charges, start, end), paypal_revenue(transactions, start, end)
    )
    matched = match_programs(combined, programs)
    return (
        matched.where(in_range(F.col("month"), start, end))
        .groupBy(
            "month",
            "program_id",
            "program_name",
            "payment_source",
            "transaction_subject",
        )
        .agg(
            F.sum("gross_revenue").cast(WIDE_MONEY).alias("gross_revenue"),
            F.sum("total_fees").cast(WIDE_MONEY).alias("total_fees"),
            F.sum("net_revenue").cast(WIDE_MONEY).alias("net_revenue"),
            F.sum("transaction_count").alias("transaction_count"),
        )
        .withColumn(
            "avg_net_per_transaction",
            safe_divide(
                F.col("net_revenue"), F.col("transaction_count").cast("decimal(20,0)")
            ).cast(WIDE_MONEY),
        )
    )


# -- enrollment against ad spend ---------------------------------------------


def daily_enrollments(students: DataFrame, start: date, end: date) -> DataFrame:
    enrolled = students.where(in_range(F.col("enrolled_at"), start, end))
    return enrolled.groupBy(F.col("enrolled_at").alias("date"), "program_id").agg(
        F.count(F.lit(1)).alias("new_enrollments")
    )


def daily_ads(ads: DataFrame, start: date, end: date) -> DataFrame:
    return (
        ads.where(in_range(F.col("date"), start, end))
        .groupBy("date")
        .agg(
            F.sum("cost_usd").alias("total_spend_usd"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("impressions").alias("total_impressions"),
            F.sum("conversions").alias("total_ad_conversions"),
        )
    )


def daily_paid_sessions(sessions: DataFrame, start: date, end: date) -> DataFrame:
    paid = sessions.where(
        F.col("session_source").isin(*PAID_SOURCES)
        & in_range(F.col("date"), start, end)
    )
    return paid.groupBy("date").agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("page_views").alias("total_page_views"),
    )


def ad_attribution(
    students: DataFrame, ads: DataFrame, sessions: DataFrame, start: date, end: date
) -> DataFrame:
    """Daily enrollments by program beside the day's ad spend and paid traffic.

    One row per (date, program): the day's spend is repeated for each program,
    so it must not be summed over programs.
    """

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    enrollments = daily_enrollments(students, start, end)
    ad_days = one_row_per_day(daily_ads(ads, start, end), start, end)
    session_days = one_row_per_day(
        daily_paid_sessions(sessions, start, end), start, end
    )
    spend = or_zero("total_spend_usd").cast("decimal(38,2)")
    conversions = F.coalesce("total_ad_conversions", F.lit(0.0))
    return (
        enrollments.join(ad_days, "date", "left")
        .join(session_days, "date", "left")
        .select(
            "date",
            "program_id",
            "new_enrollments",
            spend.alias("total_spend_usd"),
            or_zero("total_clicks").alias("total_clicks"),
            or_zero("total_impressions").alias("total_impressions"),
            conversions.alias("total_ad_conversions"),
            or_zero("total_sessions").alias("total_paid_sessions"),
            or_zero("total_page_views").alias("total_paid_page_views"),
            safe_divide(
                spend.cast("double"), F.col("new_enrollments").cast("double")
            ).alias("cost_per_enrollment_usd"),
            safe_divide(spend.cast("double"), conversions).alias(
                "cost_per_ad_conversion_usd"
            ),
        )
    )


# -- stock levels ------------------------------------------------------------


def active_students(students: DataFrame) -> DataFrame:
    """Students active now, by program; no date range."""
    return (
        students.where(F.col("enrollment_status") == ACTIVE)
        .groupBy("program_id")
        .agg(F.count(F.lit(1)).alias("active_student_count"))
    )


def stock_levels(
    inventory: DataFrame, students: DataFrame, start: date, end: date
) -> DataFrame:
    """Stock status and reorder cost per SKU and snapshot.

    The counts are small (one row per program) beside the inventory.  They are
    checkpointed, so that students are aggregated once, measured, and broadcast
    if they fit: then the inventory is not shuffled at all.  Otherwise it is a
    plain join, where AQE splits the partitions of hot or null programs.
    """
    ensure_checkpoint_dir(inventory.sparkSession)
    counts = active_students(students).checkpoint()
    if fits(counts, ["program_id"], HASH_JOIN_LIMIT):
        counts = F.broadcast(counts)
    snapshots = inventory.where(in_range(F.col("snapshot_date"), start, end))
    return stock_status(snapshots.join(counts, "program_id", "left"))


def stock_status(joined: DataFrame) -> DataFrame:
    on_hand = F.col("quantity_on_hand")
    active = F.coalesce("active_student_count", F.lit(0))
    usage = times_count(F.col("units_per_student"), active)
    # Nine decimals, as a numeric quotient has; null where nothing is used.
    days = safe_divide(on_hand.cast(COUNT), usage).cast(WIDE_MONEY)
    status = (
        F.when(on_hand <= 0, "stockout")
        .when(on_hand <= F.col("reorder_threshold"), "reorder_now")
        .when(days <= F.lit(Decimal(REORDER_SOON_DAYS)), "reorder_soon")
        .otherwise("ok")
    )
    reorder_cost = times_count(F.col("unit_cost_usd"), F.col("reorder_quantity"))
    return joined.select(
        "sku_id",
        "sku_name",
        "program_id",
        "snapshot_date",
        "quantity_on_hand",
        "reorder_threshold",
        "reorder_quantity",
        "unit_cost_usd",
        "units_per_student",
        active.alias("active_student_count"),
        F.round(usage, 2).cast("decimal(38,2)").alias("projected_daily_usage"),
        F.round(days, 1).cast("decimal(38,1)").alias("days_of_stock_remaining"),
        status.alias("stock_status"),
        F.round(reorder_cost, 2).cast("decimal(38,2)").alias("reorder_cost_usd"),
    )
