"""Fixed schemas: landed JSON, raw tables, staging tables.

Landed leaves are all strings, so that a number, a text or an object in the
same field reaches the parser, which then decides strictly.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Money: every 64-bit count of cents fits, and a sum still has nine decimals.
MONEY = DecimalType(27, 9)
# Published ratios and sums of sums.
WIDE_MONEY = DecimalType(38, 9)
# Any 64-bit count.
COUNT = DecimalType(19, 0)

S, I, F, N, B, D, TS = (
    StringType(),
    LongType(),
    DoubleType(),
    MONEY,
    BooleanType(),
    DateType(),
    TimestampType(),
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def texts(*names: str) -> StructType:
    return struct(**{name: S for name in names})


# -- landed documents --------------------------------------------------------

STRIPE_CHARGE = struct(
    id=S,
    created=S,
    amount=S,
    amount_captured=S,
    balance_transaction=S,
    currency=S,
    status=S,
    description=S,
    billing_details=texts("email", "name"),
    receipt_email=S,
    payment_intent=S,
)
STRIPE_PAGE = struct(
    starting_after=S, data=ArrayType(STRIPE_CHARGE), has_more=BooleanType()
)

# What the completeness checks read of a page.
STRIPE_PAGE_LINKS = struct(
    starting_after=S, data=ArrayType(texts("id")), has_more=BooleanType()
)
PAYPAL_PAGE_NUMBERS = struct(page=LongType(), total_pages=LongType())

AMOUNT = texts("value", "currency_code")
PAYPAL_TRANSACTION = struct(
    transaction_info=struct(
        transaction_id=S,
        paypal_reference_id=S,
        transaction_initiation_date=S,
        transaction_amount=AMOUNT,
        transaction_status=S,
        transaction_subject=S,
        fee_amount=AMOUNT,
        transaction_net_amount=AMOUNT,
    ),
    payer_info=struct(
        email_address=S, payer_name=texts("given_name", "surname")
    ),
)
PAYPAL_PAGE = struct(
    page=LongType(),
    total_pages=LongType(),
    transaction_details=ArrayType(PAYPAL_TRANSACTION),
)

GOOGLE_ADS_ROW = struct(
    segments=texts("date"),
    metrics=texts("clicks", "impressions", "costMicros", "conversions"),
)

ANALYTICS_VALUE = ArrayType(texts("value"))
ANALYTICS_REPORT = struct(
    rows=ArrayType(
        struct(dimension_values=ANALYTICS_VALUE, metric_values=ANALYTICS_VALUE)
    )
)

SHEET_VALUES = struct(sheet=S, values=ArrayType(ArrayType(S)))

FACEBOOK_INSIGHT = struct(
    date_start=S,
    campaign_id=S,
    campaign_name=S,
    impressions=S,
    clicks=S,
    spend=S,
    reach=S,
    frequency=S,
    actions=ArrayType(texts("action_type", "value")),
)

# -- raw tables --------------------------------------------------------------

RAW = {
    "stripe_charges": struct(
        charge_id=S,
        charge_date=D,
        gross_amount_usd=N,
        amount_captured_usd=N,
        fee_usd=N,
        net_usd=N,
        currency=S,
        status=S,
        description=S,
        customer_email=S,
        customer_name=S,
        payment_intent_id=S,
        loaded_at=TS,
    ),
    "paypal_transactions": struct(
        transaction_id=S,
        transaction_date=D,
        gross_amount_usd=N,
        currency_code=S,
        transaction_status=S,
        transaction_subject=S,
        payer_email=S,
        payer_name=S,
        fee_amount_usd=N,
        net_amount_usd=N,
        loaded_at=TS,
    ),
    "google_ads": struct(
        date=D,
        clicks=I,
        impressions=I,
        cost_micros=I,
        conversions=F,
        customer_id=S,
        loaded_at=TS,
    ),
    "facebook_ads": struct(
        date=D,
        campaign_id=S,
        campaign_name=S,
        impressions=I,
        clicks=I,
        spend_usd=N,
        reach=I,
        frequency=F,
        link_clicks=I,
        leads=I,
        conversions=I,
        loaded_at=TS,
    ),
    "google_analytics": struct(
        date=D,
        sessionSource=S,
        sessionMedium=S,
        country=S,
        sessions=S,
        screenPageViews=S,
        bounceRate=S,
        conversions=S,
        loaded_at=TS,
    ),
    "google_sheets_inventory": struct(
        sku_id=S,
        sku_name=S,
        program_id=S,
        quantity_on_hand=S,
        reorder_threshold=S,
        reorder_quantity=S,
        unit_cost_usd=S,
        units_per_student=S,
        snapshot_date=S,
        other_columns=S,
        loaded_at=TS,
        partition_date=D,
    ),
    "google_sheets_programs": struct(
        program_id=S,
        program_name=S,
        program_code=S,
        duration_weeks=S,
        max_enrollment=S,
        is_active=S,
        other_columns=S,
        loaded_at=TS,
        partition_date=D,
    ),
    "google_sheets_students": struct(
        student_id=S,
        first_name=S,
        last_name=S,
        email=S,
        phone=S,
        program_id=S,
        enrollment_status=S,
        enrolled_at=S,
        expected_grad_date=S,
        actual_grad_date=S,
        other_columns=S,
        loaded_at=TS,
        partition_date=D,
    ),
}

RUN_LOG = struct(
    source=S,
    partition_date=D,
    run_id=S,
    status=S,
    rows_loaded=I,
    uri=S,
    sheet_name=S,
    logged_at=TS,
)

# Which snapshot dates each landing of the inventory sheet holds.
LANDINGS = struct(snapshot_date=S, partition_date=D)

# -- staging tables ----------------------------------------------------------

STAGING = {
    "stripe_charges": RAW["stripe_charges"],
    "paypal_transactions": RAW["paypal_transactions"],
    "google_ads_performance": struct(
        date=D,
        customer_id=S,
        clicks=I,
        impressions=I,
        cost_usd=DecimalType(20, 2),
        conversions=F,
        cost_per_conversion_usd=F,
    ),
    "facebook_ads_performance": RAW["facebook_ads"],
    "analytics_sessions": struct(
        date=D,
        session_source=S,
        session_medium=S,
        country=S,
        sessions=I,
        page_views=I,
        bounce_rate=F,
        conversions=F,
    ),
    "sheet_inventory": struct(
        sku_id=S,
        sku_name=S,
        program_id=S,
        quantity_on_hand=I,
        reorder_threshold=I,
        reorder_quantity=I,
        unit_cost_usd=N,
        units_per_student=N,
        snapshot_date=D,
        loaded_at=TS,
    ),
    "sheet_programs": struct(
        program_id=S,
        program_name=S,
        program_code=S,
        duration_weeks=I,
        max_enrollment=I,
        is_active=B,
        loaded_at=TS,
    ),
    "sheet_students": struct(
        student_id=S,
        first_name=S,
        last_name=S,
        email=S,
        phone=S,
        program_id=S,
        enrollment_status=S,
        enrolled_at=D,
        expected_grad_date=D,
        actual_grad_date=D,
        loaded_at=TS,
    ),
}
