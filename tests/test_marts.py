"""Hand-made edge rows for every mart rule."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ledgerline.operators.sizing import SizeLimit
from ledgerline.plans import marts, staging
from ledgerline.schemas import RAW, STAGING

JAN, FEB, MAR = date(2024, 1, 1), date(2024, 2, 29), date(2024, 3, 31)


def frame(spark, table, rows, **defaults):
    schema = STAGING[table]
    filled = [tuple({**defaults, **row}.get(n) for n in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(filled, schema)


def money(text):
    return Decimal(text)


def stripe_rows(spark, *rows):
    return frame(
        spark,
        "stripe_charges",
        [
            {"charge_date": d, "description": s, "gross_amount_usd": money(g), **more}
            for d, s, g, more in rows
        ],
        fee_usd=money("1"),
        net_usd=money("9"),
        status="succeeded",
    )


def paypal_rows(spark, *rows):
    return frame(
        spark,
        "paypal_transactions",
        [
            {"transaction_date": d, "transaction_subject": s, "gross_amount_usd": money(g)}
            | more
            for d, s, g, more in rows
        ],
        fee_amount_usd=money("-2"),
        net_amount_usd=money("8"),
        transaction_status="S",
    )


def program_rows(spark, *rows):
    return frame(
        spark, "sheet_programs", [{"program_id": i, "program_name": n} for i, n in rows]
    )


def revenue(spark, stripe, paypal, programs, start=JAN, end=MAR):
    found = marts.revenue_by_program(stripe, paypal, programs, start, end)
    return {
        (r.month, r.payment_source, r.transaction_subject, r.program_id): r
        for r in found.collect()
    }


def test_revenue_rules(spark):
    d = date(2024, 1, 10)
    stripe = stripe_rows(
        spark,
        (d, "COSMETOLOGY fee", "10", {}),
        (d, "COSMETOLOGY fee", "20", {}),
        (d, "COSMETOLOGY fee", "99", {"status": "failed"}),
        (d, "Books", "5", {}),
        (d, None, "7", {}),
        (date(2024, 2, 3), "COSMETOLOGY fee", "1", {}),
    )
    paypal = paypal_rows(
        spark,
        (d, "COSMETOLOGY fee", "30", {}),
        (d, "axb", "4", {}),
        (d, "COSMETOLOGY fee", "99", {"transaction_status": "P"}),
    )
    programs = program_rows(spark, ("p1", "Cosmetology"), ("p2", "cosmet"), ("p3", "A_B"))
    found = revenue(spark, stripe, paypal, programs)
    subject = "COSMETOLOGY fee"
    assert set(found) == {
        (JAN, "stripe", subject, "p1"),
        (JAN, "stripe", subject, "p2"),
        (JAN, "stripe", "Books", "unknown"),
        (JAN, "stripe", None, "unknown"),
        (date(2024, 2, 1), "stripe", subject, "p1"),
        (date(2024, 2, 1), "stripe", subject, "p2"),
        (JAN, "paypal", subject, "p1"),
        (JAN, "paypal", subject, "p2"),
        (JAN, "paypal", "axb", "p3"),
    }
    row = found[JAN, "stripe", subject, "p1"]
    assert (row.gross_revenue, row.total_fees, row.net_revenue) == (30, 2, 18)
    assert (row.transaction_count, row.avg_net_per_transaction) == (2, 9)
    assert found[JAN, "paypal", subject, "p1"].total_fees == 2
    assert found[JAN, "stripe", "Books", "unknown"].program_name == "unknown"


def test_revenue_range_starting_mid_month_drops_that_month(spark):
    stripe = stripe_rows(
        spark, (date(2024, 1, 20), "x", "1", {}), (date(2024, 2, 1), "x", "1", {})
    )
    found = revenue(spark, stripe, paypal_rows(spark), program_rows(spark), date(2024, 1, 15))
    assert {key[0] for key in found} == {date(2024, 2, 1)}


def test_revenue_repeated_program_row_doubles(spark):
    stripe = stripe_rows(spark, (JAN, "abc", "1", {}))
    programs = program_rows(spark, ("p", "abc"), ("p", "abc"))
    (row,) = revenue(spark, stripe, paypal_rows(spark), programs).values()
    assert (row.gross_revenue, row.transaction_count) == (2, 2)


def test_revenue_ratio_has_nine_decimals(spark):
    rows = [(JAN, "x", "1", {"net_usd": money("1")})] * 2
    rows.append((JAN, "x", "1", {"net_usd": money("0")}))
    (row,) = revenue(
        spark, stripe_rows(spark, *rows), paypal_rows(spark), program_rows(spark)
    ).values()
    assert row.avg_net_per_transaction == Decimal("0.666666667")


def attribution(spark, students, ads, sessions):
    found = marts.ad_attribution(
        frame(spark, "sheet_students", students),
        frame(spark, "google_ads_performance", ads),
        frame(spark, "analytics_sessions", sessions),
        JAN,
        FEB,
    )
    return {(r.date, r.program_id): r for r in found.collect()}


def test_attribution_rules(spark):
    busy, quiet, free = date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)
    students = [
        {"student_id": "1", "program_id": "a", "enrolled_at": busy},
        {"student_id": "2", "program_id": "a", "enrolled_at": busy},
        {"student_id": "3", "program_id": "b", "enrolled_at": busy},
        {"student_id": "4", "program_id": None, "enrolled_at": quiet},
        {"student_id": "5", "program_id": "a", "enrolled_at": free},
        {"student_id": "6", "program_id": "a", "enrolled_at": date(2024, 3, 1)},
    ]
    ad = {"clicks": 3, "impressions": 10, "cost_usd": money("6.50"), "conversions": 2.0}
    ads = [
        {"date": busy, **ad},
        {"date": busy, **ad},
        {"date": free, **ad, "conversions": 0.0},
    ]
    visit = {"sessions": 4, "page_views": 9}
    sessions = [
        {"date": busy, "session_source": "google", **visit},
        {"date": busy, "session_source": "cpc", **visit},
        {"date": busy, "session_source": "newsletter", **visit},
    ]
    found = attribution(spark, students, ads, sessions)
    assert set(found) == {(busy, "a"), (busy, "b"), (quiet, None), (free, "a")}
    a, b = found[busy, "a"], found[busy, "b"]
    assert (a.new_enrollments, b.new_enrollments) == (2, 1)
    # The day's spend is repeated for each program.
    assert a.total_spend_usd == b.total_spend_usd == Decimal("13.00")
    assert (a.total_clicks, a.total_impressions, a.total_ad_conversions) == (6, 20, 4.0)
    assert (a.total_paid_sessions, a.total_paid_page_views) == (8, 18)
    assert (a.cost_per_enrollment_usd, a.cost_per_ad_conversion_usd) == (6.5, 3.25)
    nothing = found[quiet, None]
    assert nothing.total_spend_usd == nothing.total_clicks == 0
    assert nothing.total_paid_sessions == nothing.cost_per_enrollment_usd == 0
    assert nothing.cost_per_ad_conversion_usd is None
    assert found[free, "a"].cost_per_ad_conversion_usd is None


def stock(spark, items, active, limit=None, monkeypatch=None):
    if limit is not None:
        monkeypatch.setattr(marts, "HASH_JOIN_LIMIT", limit)
    students = [
        {"student_id": str(n), "program_id": p, "enrollment_status": s}
        for n, (p, s) in enumerate(active)
    ]
    base = {
        "snapshot_date": date(2024, 1, 5),
        "reorder_threshold": 10,
        "reorder_quantity": 3,
        "unit_cost_usd": money("1.005"),
        "units_per_student": money("1"),
        "program_id": "a",
    }
    found = marts.stock_levels(
        frame(spark, "sheet_inventory", items, **base),
        frame(spark, "sheet_students", students),
        JAN,
        FEB,
    )
    return {r.sku_id: r for r in found.collect()}


ITEMS = [
    {"sku_id": "none", "quantity_on_hand": 0},
    {"sku_id": "threshold", "quantity_on_hand": 10},
    {"sku_id": "fourteen", "quantity_on_hand": 14},
    {"sku_id": "just_over", "quantity_on_hand": 1404, "units_per_student": money("100")},
    {"sku_id": "unused", "quantity_on_hand": 50, "program_id": "b"},
    {"sku_id": "no_program", "quantity_on_hand": 50, "program_id": None},
    {"sku_id": "other_day", "quantity_on_hand": 5, "snapshot_date": date(2024, 5, 1)},
]
ACTIVE = [("a", "active"), ("a", "graduated"), ("b", "withdrawn"), (None, "active")]


@pytest.mark.parametrize("limit", [None, SizeLimit(0, 0)])
def test_stock_rules(spark, limit, monkeypatch):
    found = stock(spark, ITEMS, ACTIVE, limit, monkeypatch)
    assert "other_day" not in found
    assert {k: r.stock_status for k, r in found.items()} == {
        "none": "stockout",
        "threshold": "reorder_now",
        "fourteen": "reorder_soon",
        "just_over": "ok",
        "unused": "ok",
        "no_program": "ok",
    }
    assert found["fourteen"].days_of_stock_remaining == 14
    # Rounds to 14.0, but the status looks at the unrounded 14.04.
    assert found["just_over"].days_of_stock_remaining == Decimal("14.0")
    assert found["unused"].days_of_stock_remaining is None
    assert found["no_program"].active_student_count == 0
    assert found["none"].reorder_cost_usd == Decimal("3.02")


def test_stock_keeps_nine_decimals_of_usage(spark):
    item = {
        "sku_id": "x",
        "quantity_on_hand": 50,
        "units_per_student": money("0.123456789"),
    }
    active = [("a", "active")] * 10
    row = stock(spark, [item], active)["x"]
    assert row.projected_daily_usage == Decimal("1.23")
    assert row.days_of_stock_remaining == Decimal("40.5")


def test_stock_holds_any_64_bit_count(spark):
    item = {
        "sku_id": "x",
        "quantity_on_hand": 9_223_372_036_854_775_807,
        "reorder_quantity": 20_000_000_000,
        "unit_cost_usd": money("1.005000001"),
        "units_per_student": money("0.5"),
    }
    row = stock(spark, [item], [("a", "active")] * 3)["x"]
    assert row.days_of_stock_remaining == Decimal("6148914691236517204.7")
    assert row.reorder_cost_usd == Decimal("20100000020.00") and row.stock_status == "ok"


def test_ads_staging_rounds_cost_and_guards_division(spark):
    raw = spark.createDataFrame(
        [
            (date(2024, 1, 15), 10, 100, 1_500_000, 2.0, "1", None),
            (date(2024, 1, 15), 10, 100, 5_000, 0.0, "1", None),
            (date(2024, 3, 15), 10, 100, 5_000, 0.0, "1", None),
        ],
        RAW["google_ads"],
    )
    rows = staging.google_ads_performance(raw, JAN, FEB).collect()
    assert [(r.cost_usd, r.cost_per_conversion_usd) for r in rows] == [
        (Decimal("1.50"), 0.75),
        (Decimal("0.01"), None),
    ]


def test_program_staging_reads_flags_strictly(spark):
    def staged(flag):
        row = ("p", "n", "c", "4", "9", flag, None, None, JAN)
        frame = spark.createDataFrame([row], RAW["google_sheets_programs"])
        return staging.sheet_programs(frame)

    assert staged("TRUE").head().is_active is True
    assert staged("false").head().is_active is False
    assert staged(None).head().is_active is None
    with pytest.raises(Exception, match="Bad bool value: yes"):
        staged("yes").collect()
