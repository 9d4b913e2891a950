"""Every operator as a query over the driver's tables, each with its SQL check."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import calc, casts
from ledgerline.operators import quality
from ledgerline.operators.program_match import match_programs
from ledgerline.operators.run_days import calendar_days, missing_days
from ledgerline.operators.sizing import SizeLimit
from ledgerline.plans import ingest as loads
from ledgerline.plans import marts, staging
from ledgerline.plans.changes import rebuild_changed
from ledgerline.plans.models import MODELS, model
from ledgerline.plans.runner import grain_report as grain_of_warehouse
from ledgerline.plans.runner import run_model
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import scratch_path
from ledgerline.sources import (
    facebook_ads,
    google_ads,
    google_analytics,
    google_sheets,
    paypal,
    stripe,
)
from ledgerline.sources.records import accept, rejects
from ledgerline.workload import inputs
from ledgerline.workload.bases import (
    EVENT_RANGE,
    PAYMENT_RANGE,
    RUN_ID,
    RUN_TIME,
    base,
    table,
)
from ledgerline.workload.oracle import (
    EVENT_FROM,
    EVENT_TO,
    LOADED_AT,
    PAY_FROM,
    PAY_TO,
    check,
    dollar_text,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            CHECKS[key] = check(sql)
        return function

    return register



# -- staging frames and marts, as inputs of the queries below ----------------


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stripe_charges(inputs.raw_charges(spark, sf_dir), *PAYMENT_RANGE)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.paypal_transactions(
        inputs.raw_transactions(spark, sf_dir), *PAYMENT_RANGE
    )


def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.sheet_programs(inputs.raw_programs(spark, sf_dir))


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.google_ads_performance(
        inputs.raw_google_ads(spark, sf_dir), *EVENT_RANGE
    )


def facebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.facebook_ads_performance(
        inputs.raw_facebook_ads(spark, sf_dir), *EVENT_RANGE
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.analytics_sessions(inputs.raw_analytics(spark, sf_dir), *EVENT_RANGE)


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.sheet_students(inputs.raw_students(spark, sf_dir), *EVENT_RANGE)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.sheet_inventory(inputs.raw_inventory(spark, sf_dir), *EVENT_RANGE)


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.combined_revenue(
        marts.stripe_revenue(charges(spark, sf_dir), *PAYMENT_RANGE),
        marts.paypal_revenue(transactions(spark, sf_dir), *PAYMENT_RANGE),
    )


def model_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models, each built from the ones before it."""
    frames = {
        "raw.stripe_charges": inputs.raw_charges(spark, sf_dir),
        "raw.paypal_transactions": inputs.raw_transactions(spark, sf_dir),
        "raw.google_ads": inputs.raw_google_ads(spark, sf_dir),
        "raw.facebook_ads": inputs.raw_facebook_ads(spark, sf_dir),
        "raw.google_analytics": inputs.raw_analytics(spark, sf_dir),
        "raw.google_sheets_inventory": inputs.raw_inventory(spark, sf_dir),
        "raw.google_sheets_programs": inputs.raw_programs(spark, sf_dir),
        "raw.google_sheets_students": inputs.raw_students(spark, sf_dir),
    }
    for m in MODELS:
        frames[m.name] = m.build(frames, *model_range(m.name))
    return {m.name: frames[m.name] for m in MODELS}


def model_range(name: str) -> tuple[date, date]:
    payments = ("stripe_charges", "paypal_transactions", "revenue_by_program")
    return PAYMENT_RANGE if name.endswith(payments) else EVENT_RANGE


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- landed documents to rows ------------------------------------------------


@query(
    f"""
SELECT paid_on AS landed_date, 'ch_' || k AS id, CAST(created AS VARCHAR) AS created,
  CAST(cents AS VARCHAR) AS amount, status,
  '{{"fee":' || fee_cents || ',"net":' || (cents - fee_cents) || '}}' AS balance_transaction
FROM order_base WHERE NOT (priority = '1-URGENT' AND flag = 'O')
UNION ALL
SELECT paid_on, 'ch_' || k || '_b', CAST(created AS VARCHAR),
  CAST(cents // 2 AS VARCHAR), 'succeeded', 'txn_' || k
FROM order_base WHERE flag = 'F'"""
)
def src_stripe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripe.unpack(inputs.stripe_pages(spark, sf_dir)).select(
        "landed_date", "id", "created", "amount", "status", "balance_transaction"
    )


@query(
    f"""
SELECT paid_on AS landed_date, 'tx_' || k AS transaction_id,
  CASE WHEN flag = 'R' THEN 'ref_' || k ELSE '' END AS reference_id,
  CAST(paid_on AS VARCHAR) || 'T' || lpad(CAST(quantity % 24 AS VARCHAR), 2, '0')
    || ':30:00+0000' AS initiated,
  {dollar_text('cents')} AS amount, status,
  CASE WHEN line_number <> 5 THEN 's' || supp || '@example.com' END AS payer_email
FROM line_base WHERE NOT (line_number = 4 AND flag = 'A')"""
)
def src_paypal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = "transaction_info"
    return paypal.unpack(inputs.paypal_pages(spark, sf_dir)).select(
        "landed_date",
        f"{info}.transaction_id",
        F.col(f"{info}.paypal_reference_id").alias("reference_id"),
        F.col(f"{info}.transaction_initiation_date").alias("initiated"),
        F.col(f"{info}.transaction_amount.value").alias("amount"),
        F.col(f"{info}.transaction_status").alias("status"),
        F.col("payer_info.email_address").alias("payer_email"),
    )


ADS_TEXTS = """
SELECT CAST(date AS VARCHAR) AS segments_date, CAST(clicks AS VARCHAR) AS clicks,
  CAST(impressions AS VARCHAR) AS impressions,
  CAST(cost_micros AS VARCHAR) AS cost_micros, '1234567890' AS customer_id
FROM ads"""


@query(ADS_TEXTS)
def src_google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.google_ads_documents(spark, sf_dir)
    return google_ads.unpack(documents, F.lit("1234567890")).select(
        F.col("`segments.date`").alias("segments_date"),
        F.col("`metrics.clicks`").alias("clicks"),
        F.col("`metrics.impressions`").alias("impressions"),
        F.col("`metrics.costMicros`").alias("cost_micros"),
        "customer_id",
    )


@query(
    f"""
SELECT strftime(day, '%Y%m%d') AS date,
  strftime(day, '%Y%m%d') || '|' || CASE user_id % 4 WHEN 0 THEN 'google'
    WHEN 1 THEN 'cpc' WHEN 2 THEN 'paid' ELSE 'direct' END || '|' || event_type || '|'
    || CASE n % 3 WHEN 0 THEN 'Japan' WHEN 1 THEN 'Peru' ELSE 'Kenya' END AS dimensions,
  (1 + n % 9) || '|' || (5 + user_id) || '|' || {dollar_text('n')} || '|'
    || CASE event_type WHEN 'purchase' THEN '1.5' WHEN 'signup' THEN '1.0'
       ELSE '0.0' END AS metrics
FROM report_rows"""
)
def src_ga_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return google_analytics.unpack(
        inputs.analytics_reports(spark, sf_dir), google_analytics.DAILY_SESSIONS
    ).select(
        "date",
        F.array_join("dimensions", "|").alias("dimensions"),
        F.array_join("metrics", "|").alias("metrics"),
    )


@query(
    f"""
SELECT snapshot_date AS landed_date,
  CASE WHEN size % 2 = 0 THEN 'sku_id' ELSE 'snapshot_date' END AS first_header,
  CAST(9 AS INT) AS header_length,
  CASE WHEN size % 2 = 0 THEN 'sku_' || k ELSE CAST(snapshot_date AS VARCHAR) END
    AS first_cell,
  CASE WHEN size % 2 = 0 THEN CAST(snapshot_date AS VARCHAR) ELSE 'sku_' || k END
    AS last_cell
FROM part_base"""
)
def src_sheet_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = google_sheets.unpack(inputs.inventory_sheets(spark, sf_dir))
    return rows.select(
        "landed_date",
        F.element_at("header", 1).alias("first_header"),
        F.size("header").alias("header_length"),
        F.element_at("row", 1).alias("first_cell"),
        F.element_at("row", -1).alias("last_cell"),
    )


@query(
    f"""
SELECT CAST(day AS VARCHAR) AS date_start, 'cmp_' || n % 10 AS campaign_id,
  CAST(n AS VARCHAR) AS clicks, {dollar_text('cents')} AS spend,
  CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 2
    ELSE 0 END AS INT) AS action_count
FROM event_base"""
)
def src_facebook_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facebook_ads.unpack(inputs.facebook_documents(spark, sf_dir))
    return rows.select(
        "date_start",
        "campaign_id",
        "clicks",
        "spend",
        F.size("actions").alias("action_count"),
    )


@query(
    """
SELECT landed_date, order_key, pages_landed, pages_found, pages_expected, last_page,
  pages_landed = pages_expected AND pages_found = pages_expected AS is_complete
FROM (SELECT DATE '2024-01-01' + CAST(order_key % 182 AS INT) AS landed_date, order_key,
        COUNT(*) AS pages_landed,
        COUNT(DISTINCT (line_number - 1) % (1 + order_key % 3)) AS pages_found,
        1 + order_key % 3 AS pages_expected,
        MAX(1 + (line_number - 1) % (1 + order_key % 3)) AS last_page
      FROM line_base GROUP BY order_key) AS found_pages"""
)
def chk_paypal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.paypal_page_sets(spark, sf_dir)
    return paypal.page_report(pages, ("landed_date", "order_key"))


CHAINS = """
  (SELECT DATE '2024-01-01' + CAST(k // 16 % 182 AS INT) AS landed_date,
     k // 16 AS chain, 'ch_' || k AS id,
     CASE k // 16 % 7 WHEN 1 THEN k % 16 = 11 WHEN 3 THEN false ELSE k % 16 = 15 END
       AS is_last,
     CASE WHEN flag = 'P' AND priority = '5-LOW' THEN 'ch_lost_' || k
       WHEN k // 16 % 7 = 1 AND k % 16 = 12 THEN 'ch_' || (k + 3)
       WHEN k // 16 % 7 = 2 AND k % 16 = 9 THEN 'ch_' || (k - 2)
       WHEN k % 16 > 0 THEN 'ch_' || (k - 1) END AS cursor_id
   FROM order_base)"""


@query(
    f"""
SELECT landed_date, chain, pages, first_pages, last_pages, broken_links, repeated_pages,
  forked_links, open_ends,
  CASE WHEN straight THEN pages - walked ELSE 0 END AS looped_pages,
  straight AND pages = walked AS is_complete
FROM (
  SELECT *, first_pages = 1 AND last_pages = 1 AND broken_links = 0 AND forked_links = 0
    AND open_ends = 0 AND repeated_pages = 0 AS straight
  FROM (
    SELECT p.landed_date, p.chain, COUNT(*) AS pages,
      COUNT(*) FILTER (WHERE p.cursor_id IS NULL) AS first_pages,
      COUNT(*) FILTER (WHERE p.is_last) AS last_pages,
      COUNT(*) FILTER (WHERE p.cursor_id IS NOT NULL AND e.id IS NULL) AS broken_links,
      COUNT(*) - COUNT(DISTINCT p.id) AS repeated_pages,
      COUNT(p.cursor_id) - COUNT(DISTINCT p.cursor_id) AS forked_links,
      COUNT(*) FILTER (WHERE NOT p.is_last AND f.cursor_id IS NULL) AS open_ends
    FROM {CHAINS} AS p
    LEFT JOIN {CHAINS} AS e ON p.cursor_id = e.id AND p.chain = e.chain
    LEFT JOIN (SELECT DISTINCT chain, cursor_id FROM {CHAINS} AS g) AS f
      ON f.cursor_id = p.id AND f.chain = p.chain
    GROUP BY p.landed_date, p.chain) AS counted
) AS judged
JOIN (
  -- Walk from every first page to whatever continues from where the walk stands.
  SELECT chain, COUNT(DISTINCT id) AS walked
  FROM (WITH RECURSIVE walk AS (
          SELECT chain, id FROM {CHAINS} AS s WHERE cursor_id IS NULL
          UNION
          SELECT n.chain, n.id FROM walk JOIN {CHAINS} AS n
            ON n.chain = walk.chain AND n.cursor_id = walk.id)
        SELECT * FROM walk
        UNION ALL SELECT DISTINCT chain, NULL FROM {CHAINS} AS every_chain) AS steps
  GROUP BY chain
) AS walks USING (chain)"""
)
def chk_stripe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    chains = inputs.stripe_chains(spark, sf_dir)
    return stripe.page_report(chains, ("landed_date", "chain"))


# -- parsers -----------------------------------------------------------------

CHARGE_COLUMNS = """charge_id, charge_date, gross_amount_usd, amount_captured_usd,
  fee_usd, net_usd, currency, status, description, customer_email, customer_name,
  payment_intent_id"""
TRANSACTION_COLUMNS = """transaction_id, transaction_date, gross_amount_usd,
  currency_code, transaction_status, transaction_subject, payer_email, payer_name,
  fee_amount_usd, net_amount_usd"""
FACEBOOK_COLUMNS = """date, campaign_id, campaign_name, impressions, clicks, spend_usd,
  reach, frequency, link_clicks, leads, conversions"""


@query(f"SELECT {CHARGE_COLUMNS} FROM paged_charges")
def parse_stripe(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = stripe.parse(stripe.unpack(inputs.stripe_pages(spark, sf_dir)))
    return accept(parsed, "stripe_charges").drop("landed_date")


@query(f"SELECT {TRANSACTION_COLUMNS} FROM paged_transactions")
def parse_paypal(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = paypal.parse(paypal.unpack(inputs.paypal_pages(spark, sf_dir)))
    return accept(parsed, "paypal_transactions").drop("landed_date")


@query(
    """
SELECT CAST(date AS VARCHAR) AS segments_date, CAST(clicks AS VARCHAR) AS clicks,
  CAST(impressions AS VARCHAR) AS impressions,
  CAST(cost_micros AS VARCHAR) AS cost_micros, CAST(5 AS INT) AS flat_columns
FROM ads"""
)
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.google_ads_documents(spark, sf_dir).drop("landed_date")
    flat = google_ads.flatten_struct(documents)
    return flat.select(
        F.col("`segments.date`").alias("segments_date"),
        F.col("`metrics.clicks`").alias("clicks"),
        F.col("`metrics.impressions`").alias("impressions"),
        F.col("`metrics.costMicros`").alias("cost_micros"),
        F.lit(len(flat.columns)).alias("flat_columns"),
    )


@query(
    """
SELECT date, clicks, impressions, cost_micros, conversions, '1234567890' AS customer_id
FROM ads"""
)
def parse_google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.google_ads_documents(spark, sf_dir)
    parsed = google_ads.parse(google_ads.unpack(documents, F.lit("1234567890")))
    return accept(parsed, "google_ads").drop("landed_date")


GA_TEXTS = f"""
SELECT day AS date,
  CASE user_id % 4 WHEN 0 THEN 'google' WHEN 1 THEN 'cpc' WHEN 2 THEN 'paid'
    ELSE 'direct' END AS "sessionSource",
  event_type AS "sessionMedium",
  CASE n % 3 WHEN 0 THEN 'Japan' WHEN 1 THEN 'Peru' ELSE 'Kenya' END AS country,
  CAST(1 + n % 9 AS VARCHAR) AS sessions,
  CAST(5 + user_id AS VARCHAR) AS "screenPageViews",
  {dollar_text('n')} AS "bounceRate",
  CASE event_type WHEN 'purchase' THEN '1.5' WHEN 'signup' THEN '1.0' ELSE '0.0' END
    AS conversions
FROM report_rows"""


@query(GA_TEXTS)
def parse_ga(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = google_analytics.DAILY_SESSIONS
    rows = google_analytics.unpack(inputs.analytics_reports(spark, sf_dir), config)
    parsed = google_analytics.parse(rows, config)
    return accept(parsed, "google_analytics").drop("landed_date")


SHEET_TEXTS = f"""
SELECT 'sku_' || k AS sku_id, name AS sku_name, 'prog_' || k % 25 AS program_id,
  CAST(size - 5 AS VARCHAR) AS quantity_on_hand, '10' AS reorder_threshold,
  CAST(2 * size AS VARCHAR) AS reorder_quantity,
  {dollar_text('cents')} AS unit_cost_usd, {dollar_text('size')} AS units_per_student,
  CAST(snapshot_date AS VARCHAR) AS snapshot_date
FROM part_base"""


def parsed_inventory(sheets: DataFrame) -> DataFrame:
    parsed = google_sheets.parse(google_sheets.unpack(sheets), google_sheets.INVENTORY)
    return accept(parsed, "google_sheets_inventory").drop("landed_date")


@query(f"SELECT *, '{{\"shelf\":\"at ' || sku_id || '\"}}' AS other_columns FROM ({SHEET_TEXTS}) AS t")
def parse_sheet_extra_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed sheet with a column that nobody declared."""
    cell = "IF(n = 0, 'shelf', 'at ' || array_max(filter(row, x -> x LIKE 'sku%')))"
    widened = F.expr(f"transform(values, (row, n) -> array_append(row, {cell}))")
    return parsed_inventory(inputs.inventory_sheets(spark, sf_dir).withColumn("values", widened))


@query(f"SELECT *, CAST(NULL AS VARCHAR) AS other_columns FROM ({SHEET_TEXTS}) AS t")
def parse_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_inventory(inputs.inventory_sheets(spark, sf_dir))


@query(f"SELECT {FACEBOOK_COLUMNS} FROM facebook")
def parse_facebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facebook_ads.unpack(inputs.facebook_documents(spark, sf_dir))
    return accept(facebook_ads.parse(rows), "facebook_ads").drop("landed_date")


@query(
    """
SELECT CASE event_type WHEN 'error' THEN 'clicks' ELSE 'conversions' END AS parse_error,
  ad_day AS landed_date, COUNT(*) AS refused_records
FROM event_base WHERE event_type IN ('error', 'view') GROUP BY 1, 2"""
)
def parse_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.faulty_google_ads_documents(spark, sf_dir)
    parsed = google_ads.parse(google_ads.unpack(documents, F.lit("1234567890")))
    return (
        rejects(parsed)
        .groupBy("parse_error", "landed_date")
        .agg(F.count(F.lit(1)).alias("refused_records"))
    )


# -- filters -----------------------------------------------------------------

TWO_MONTHS = (date(2024, 2, 1), date(2024, 3, 31))
TWO_WEEKS = (date(2024, 1, 8), date(2024, 1, 21))
ONE_DAY = date(2024, 1, 15)


@query(
    """
SELECT charge_id, created FROM paged_charges
WHERE charge_date BETWEEN DATE '2024-02-01' AND DATE '2024-03-31'"""
)
def flt_stripe_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stripe.unpack(inputs.stripe_pages(spark, sf_dir))
    return rows.where(stripe.in_window(*TWO_MONTHS)).select(
        F.col("id").alias("charge_id"), F.col("created").cast("bigint").alias("created")
    )


@query(
    """
SELECT 'tx_' || k AS transaction_id, status FROM line_base
WHERE NOT (line_number = 4 AND flag = 'A')
  AND paid_on BETWEEN DATE '2024-02-01' AND DATE '2024-03-31'"""
)
def flt_paypal_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = paypal.unpack(inputs.paypal_pages(spark, sf_dir))
    return rows.where(paypal.in_window(*TWO_MONTHS)).select(
        "transaction_info.transaction_id",
        F.col("transaction_info.transaction_status").alias("status"),
    )


@query(ADS_TEXTS.replace("FROM ads", "FROM ads WHERE date = DATE '2024-01-15'"))
def flt_ads_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.google_ads_documents(spark, sf_dir)
    rows = google_ads.unpack(documents, F.lit("1234567890"))
    return rows.where(google_ads.on_day(ONE_DAY)).select(
        F.col("`segments.date`").alias("segments_date"),
        F.col("`metrics.clicks`").alias("clicks"),
        F.col("`metrics.impressions`").alias("impressions"),
        F.col("`metrics.costMicros`").alias("cost_micros"),
        "customer_id",
    )


@query(
    """
SELECT CAST(date AS VARCHAR) AS date_start, campaign_id, CAST(clicks AS VARCHAR) AS clicks
FROM facebook WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""
)
def flt_fb_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facebook_ads.unpack(inputs.facebook_documents(spark, sf_dir))
    return rows.where(facebook_ads.in_window(*TWO_WEEKS)).select(
        "date_start", "campaign_id", "clicks"
    )


@query(
    f"""
SELECT date, country, sessions FROM ({GA_TEXTS}) AS t
WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""
)
def ga_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = inputs.analytics_reports(spark, sf_dir)
    rows = google_analytics.report(reports, google_analytics.DAILY_SESSIONS, *TWO_WEEKS)
    return accept(rows, "google_analytics").select("date", "country", "sessions")


@query(
    """
SELECT 'stripe' AS source, charge_id AS id FROM charges WHERE status = 'succeeded'
UNION ALL
SELECT 'paypal', transaction_id FROM transactions WHERE transaction_status = 'S'
UNION ALL
SELECT 'students', student_id FROM students WHERE enrollment_status = 'active'"""
)
def flt_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    def chosen(frame: DataFrame, source: str, column: str, value: str, key: str):
        return frame.where(F.col(column) == value).select(
            F.lit(source).alias("source"), F.col(key).alias("id")
        )

    return stacked(
        [
            chosen(
                charges(spark, sf_dir),
                "stripe",
                "status",
                marts.STRIPE_SETTLED,
                "charge_id",
            ),
            chosen(
                transactions(spark, sf_dir),
                "paypal",
                "transaction_status",
                marts.PAYPAL_SETTLED,
                "transaction_id",
            ),
            chosen(
                students(spark, sf_dir),
                "students",
                "enrollment_status",
                marts.ACTIVE,
                "student_id",
            ),
        ]
    )


@query(
    """
SELECT date, session_source, sessions, page_views FROM sessions
WHERE session_source IN ('google', 'cpc', 'paid')"""
)
def flt_paid_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        sessions(spark, sf_dir)
        .where(F.col("session_source").isin(*marts.PAID_SOURCES))
        .select("date", "session_source", "sessions", "page_views")
    )


# -- staging -----------------------------------------------------------------

query(f"SELECT {CHARGE_COLUMNS}, loaded_at FROM charges", "stg_stripe")(charges)
query(f"SELECT {TRANSACTION_COLUMNS}, loaded_at FROM transactions", "stg_paypal")(
    transactions
)
query(
    """
SELECT date, customer_id, clicks, impressions, cost_usd, conversions,
  CAST(cost_usd AS DOUBLE) / NULLIF(conversions, 0) AS cost_per_conversion_usd
FROM ads""",
    "stg_google_ads",
)(ads)
query(f"SELECT {FACEBOOK_COLUMNS}, loaded_at FROM facebook", "stg_facebook")(facebook)
query("SELECT * FROM sessions", "stg_ga")(sessions)
query(
    """
SELECT sku_id, sku_name, program_id, quantity_on_hand, reorder_threshold,
  reorder_quantity, unit_cost_usd, units_per_student, snapshot_date, loaded_at
FROM inventory""",
    "stg_inventory",
)(inventory)
query("SELECT * FROM programs", "stg_programs")(programs)
query("SELECT * FROM students", "stg_students")(students)


# -- join, aggregates, union, marts ------------------------------------------

MATCHED = """
SELECT month, payment_source, transaction_subject, transaction_count,
  program_id, program_name FROM matched"""
MATCHED_COLUMNS = (
    "month",
    "payment_source",
    "transaction_subject",
    "transaction_count",
    "program_id",
    "program_name",
)


@query(MATCHED)
def join_program_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = match_programs(combined(spark, sf_dir), programs(spark, sf_dir))
    return matched.select(*MATCHED_COLUMNS)


@query(MATCHED)
def join_program_match_by_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when there are too many programs to broadcast."""
    matched = match_programs(
        combined(spark, sf_dir), programs(spark, sf_dir), SizeLimit(0, 0)
    )
    return matched.select(*MATCHED_COLUMNS)


@query("SELECT * FROM enrollments")
def agg_daily_enrollments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_enrollments(students(spark, sf_dir), *EVENT_RANGE)


@query("SELECT * FROM ad_days")
def agg_daily_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_ads(ads(spark, sf_dir), *EVENT_RANGE)


@query("SELECT * FROM session_days")
def agg_daily_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_paid_sessions(sessions(spark, sf_dir), *EVENT_RANGE)


@query("SELECT * FROM stripe_month")
def agg_stripe_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stripe_revenue(charges(spark, sf_dir), *PAYMENT_RANGE)


@query("SELECT * FROM paypal_month")
def agg_paypal_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.paypal_revenue(transactions(spark, sf_dir), *PAYMENT_RANGE)


@query("SELECT * FROM active")
def agg_active_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.active_students(students(spark, sf_dir))


query("SELECT * FROM combined", "union_payments")(combined)


@query("SELECT * FROM revenue")
def mart_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_program(
        charges(spark, sf_dir),
        transactions(spark, sf_dir),
        programs(spark, sf_dir),
        *PAYMENT_RANGE,
    )


@query("SELECT * FROM attribution")
def mart_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ad_attribution(
        students(spark, sf_dir),
        ads(spark, sf_dir),
        sessions(spark, sf_dir),
        *EVENT_RANGE,
    )


@query("SELECT * FROM stock")
def mart_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stock_levels(
        inventory(spark, sf_dir), students(spark, sf_dir), *EVENT_RANGE
    )


# -- scalar functions --------------------------------------------------------


@query(
    """
SELECT k AS event_id,
  CAST(CAST(cents AS DECIMAL(20,0)) * 0.01 AS DECIMAL(27,9)) AS dollars,
  CAST(CAST((cents * 10000 + k % 10000 + 5000) // 10000 AS DECIMAL(20,0)) * 0.01
    AS DECIMAL(20,2)) AS rounded,
  CAST(cents AS DOUBLE) / NULLIF(n, 0) AS ratio,
  COALESCE(NULLIF(n, 0), -1) AS filled,
  -n AS flipped,
  CASE WHEN n < 33 THEN 'low' WHEN n < 66 THEN 'mid' ELSE 'high' END AS band
FROM event_base"""
)
def scalar_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents, n = F.col("cents"), F.col("n")
    return base(spark, sf_dir, "event_base").select(
        F.col("k").alias("event_id"),
        calc.cents_to_dollars(cents).alias("dollars"),
        calc.micros_to_dollars(cents * 10000 + F.col("k") % 10000).alias("rounded"),
        calc.safe_divide(cents.cast("double"), n.cast("double")).alias("ratio"),
        F.coalesce(F.nullif(n, F.lit(0)), F.lit(-1)).alias("filled"),
        (n * -1).alias("flipped"),
        F.when(n < 33, "low").when(n < 66, "mid").otherwise("high").alias("band"),
    )


@query(
    """
SELECT k AS order_key, paid_on AS day,
  CAST(date_trunc('month', paid_on) AS DATE) AS month,
  paid_on AS from_text, paid_on AS from_compact_text,
  paid_on BETWEEN DATE '2024-02-01' AND DATE '2024-03-31' AS in_two_months
FROM order_base"""
)
def scalar_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("paid_on")
    return base(spark, sf_dir, "order_base").select(
        F.col("k").alias("order_key"),
        calc.epoch_to_date(F.col("created")).alias("day"),
        calc.month_start(day).alias("month"),
        casts.iso_date(day.cast("string")).alias("from_text"),
        casts.compact_date(F.date_format(day, "yyyyMMdd")).alias("from_compact_text"),
        calc.in_range(day, *TWO_MONTHS).alias("in_two_months"),
    )


@query(
    """
SELECT p_partkey, lower(p_type) AS lowered, p_name || '/' || p_brand AS joined,
  substr(p_name, 1, 10) AS first_ten,
  lower(p_name) LIKE '%' || lower(substr(p_type, 1, 1)) || '%' AS matches,
  CASE WHEN p_size = 50 THEN p_type ELSE p_brand END AS filled
FROM part"""
)
def scalar_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    initial = F.lower(F.substring("p_type", 1, 1))
    brand = F.when(F.col("p_size") == 50, "").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.lower("p_type").alias("lowered"),
        F.concat_ws("/", "p_name", "p_brand").alias("joined"),
        F.substring("p_name", 1, 10).alias("first_ten"),
        F.like(F.lower("p_name"), F.concat(F.lit("%"), initial, F.lit("%"))).alias(
            "matches"
        ),
        casts.first_filled(brand, F.col("p_type")).alias("filled"),
    )


@query(
    """
SELECT k AS event_id, n AS from_json, n * 2 + 1 AS second_of_three,
  CAST(n AS DOUBLE) + 0.5 AS as_double, n AS truncated,
  CAST(NULL AS BIGINT) AS refused
FROM event_base"""
)
def scalar_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON to struct, array lookup, zip to map, and strict number reading."""
    parsed = table(spark, sf_dir, "events").select(
        F.col("event_id"), F.from_json("props", "k bigint")["k"].alias("n")
    )
    n = F.col("n")
    named = F.map_from_arrays(
        F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.array(n, n * 2 + 1, n * 3)
    )
    halves = F.concat(n.cast("string"), F.lit(".5"))
    return parsed.select(
        "event_id",
        n.alias("from_json"),
        F.try_element_at(named, F.lit("b")).alias("second_of_three"),
        casts.real_number(halves).alias("as_double"),
        casts.truncated_number(halves).alias("truncated"),
        casts.whole_number(halves).alias("refused"),
    )


# -- sinks -------------------------------------------------------------------


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, label))


@query(
    """
SELECT partition_date, source, run_id, status, rows_loaded, has_uri, logged_at
FROM (SELECT d.day AS partition_date, 'facebook_ads' AS source, 'run-0001' AS run_id,
        CASE WHEN COUNT(e.k) > 0 THEN 'loaded' ELSE 'missing' END AS status,
        COUNT(e.k) AS rows_loaded, COUNT(e.k) > 0 AS has_uri,
        TIMESTAMP '2024-02-01 06:00:00' AS logged_at
      FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31',
              INTERVAL 1 DAY)) AS DATE) AS day) AS d
      LEFT JOIN event_base AS e ON e.day = d.day
      GROUP BY d.day) AS logged"""
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = loads.ingest(
        loads.FACEBOOK_ADS,
        inputs.facebook_documents(spark, sf_dir),
        new_warehouse(spark, "run-log"),
        *EVENT_RANGE,
        RUN_ID,
        RUN_TIME,
    )
    return log.select(
        "partition_date",
        "source",
        "run_id",
        "status",
        "rows_loaded",
        F.col("uri").isNotNull().alias("has_uri"),
        "logged_at",
    )


@query(
    f"""
SELECT {FACEBOOK_COLUMNS}, loaded_at, 'run-0001' AS run_id FROM facebook
UNION ALL
SELECT {FACEBOOK_COLUMNS}, loaded_at, 'run-0002' AS run_id FROM facebook"""
)
def lake_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the same days stand side by side; a repeated run replaces itself."""
    warehouse = new_warehouse(spark, "lake")
    records = inputs.raw_facebook_ads(spark, sf_dir).withColumn(
        "partition_date", F.col("date")
    )
    for run_id in ("run-0001", "run-0002", "run-0002"):
        loads.append_to_lake(records, warehouse, "facebook_ads", run_id)
    return stacked(
        [
            loads.read_lake_run(warehouse, "facebook_ads", run_id).drop("partition_date")
            for run_id in ("run-0001", "run-0002")
        ]
    )


@query(
    f"""
SELECT date, campaign_id, campaign_name, impressions,
  clicks + CASE WHEN date >= DATE '2024-01-16' THEN 1000 ELSE 0 END AS clicks,
  spend_usd, reach, frequency, link_clicks, leads, conversions, loaded_at
FROM facebook"""
)
def load_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all days, then reload half of them twice with other values."""
    warehouse = new_warehouse(spark, "load")
    records = inputs.raw_facebook_ads(spark, sf_dir)
    later = records.where(F.col("date") >= F.lit(date(2024, 1, 16))).withColumn(
        "clicks", F.col("clicks") + 1000
    )
    for frame in (records, later, later):
        loads.load_partitions(frame, warehouse, "facebook_ads")
    # An empty frame replaces nothing.
    loads.load_partitions(records.where(F.lit(False)), warehouse, "facebook_ads")
    return warehouse.read("raw.facebook_ads")


@query(f"SELECT {FACEBOOK_COLUMNS}, loaded_at FROM facebook")
def load_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = new_warehouse(spark, "clustered")
    loads.load_partitions(
        inputs.raw_facebook_ads(spark, sf_dir),
        warehouse,
        "facebook_ads",
        cluster_columns=("campaign_id", "clicks"),
    )
    return warehouse.read("raw.facebook_ads")


@query(f"SELECT k AS event_id, {LOADED_AT} AS loaded_at FROM event_base")
def add_loaded_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "events").select("event_id")
    return loads.add_loaded_at(frame, RUN_TIME)


def ingested(
    spark: SparkSession,
    source: loads.Source,
    documents: DataFrame,
    days: tuple[date, date],
) -> DataFrame:
    """Run the load job and read the table back."""
    warehouse = new_warehouse(spark, "ingest")
    loads.ingest(source, documents, warehouse, *days, RUN_ID, RUN_TIME)
    return warehouse.read(f"raw.{source.table}")


@query(f"SELECT {CHARGE_COLUMNS}, loaded_at FROM paged_charges")
def ingest_stripe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.fetched_stripe_pages(spark, sf_dir)
    return ingested(spark, loads.STRIPE, pages, PAYMENT_RANGE)


@query(f"SELECT {TRANSACTION_COLUMNS}, loaded_at FROM paged_transactions")
def ingest_paypal(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.fetched_paypal_pages(spark, sf_dir)
    return ingested(spark, loads.PAYPAL, pages, PAYMENT_RANGE)


@query(
    """
SELECT date, clicks, impressions, cost_micros, conversions,
  '1234567890' AS customer_id, loaded_at FROM ads"""
)
def ingest_google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.google_ads_documents(spark, sf_dir)
    account = loads.google_ads_account("1234567890")
    return ingested(spark, account, documents, EVENT_RANGE)


@query(
    """
SELECT date, CASE WHEN account = '20' AND date >= DATE '2024-01-16' THEN clicks + 1000
    ELSE clicks END AS clicks,
  impressions, cost_micros, conversions, account AS customer_id, loaded_at
FROM ads, (VALUES ('0010'), ('20')) AS accounts(account)"""
)
def ingest_two_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two accounts of the same days, under one run; then half the days of one again."""
    warehouse = new_warehouse(spark, "accounts")
    documents = inputs.google_ads_documents(spark, sf_dir)
    for customer_id in ("0010", "20"):
        account = loads.google_ads_account(customer_id)
        loads.ingest(account, documents, warehouse, *EVENT_RANGE, RUN_ID, RUN_TIME)
    again = inputs.google_ads_documents(spark, sf_dir, more_clicks=1000)
    days = date(2024, 1, 16), EVENT_RANGE[1]
    loads.ingest(account, again, warehouse, *days, "run-0002", RUN_TIME)
    return warehouse.read("raw.google_ads")


@query(
    """
SELECT date, clicks, impressions, cost_micros, conversions, '1234567890' AS customer_id,
  loaded_at, place
FROM ads, (VALUES ('lake'), ('raw')) AS places(place)"""
)
def ingest_failed_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A retry under the same run id meets bad records: lake and table stay as they were."""
    warehouse = new_warehouse(spark, "retry")
    account = loads.google_ads_account("1234567890")
    good = inputs.google_ads_documents(spark, sf_dir)
    loads.ingest(account, good, warehouse, *EVENT_RANGE, RUN_ID, RUN_TIME)
    bad = inputs.faulty_google_ads_documents(spark, sf_dir)
    try:
        loads.ingest(account, bad, warehouse, *EVENT_RANGE, RUN_ID, RUN_TIME)
    except loads.BadRecord:
        pass
    lake = loads.read_lake_run(warehouse, "google_ads", RUN_ID)
    raw = warehouse.read("raw.google_ads")
    return stacked(
        [
            frame.select(*raw.columns, F.lit(place).alias("place"))
            for frame, place in ((lake, "lake"), (raw, "raw"))
        ]
    )


@query(f"SELECT {FACEBOOK_COLUMNS}, loaded_at FROM facebook")
def ingest_facebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.facebook_documents(spark, sf_dir)
    return ingested(spark, loads.FACEBOOK_ADS, documents, EVENT_RANGE)


@query(f"SELECT *, {LOADED_AT} AS loaded_at FROM ({GA_TEXTS}) AS t")
def ingest_ga(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = inputs.analytics_reports(spark, sf_dir)
    return ingested(spark, loads.GOOGLE_ANALYTICS, reports, EVENT_RANGE)


@query(
    f"""
SELECT *, CAST(NULL AS VARCHAR) AS other_columns, {LOADED_AT} AS loaded_at,
  CAST(snapshot_date AS DATE) AS partition_date
FROM ({SHEET_TEXTS}) AS t"""
)
def ingest_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.inventory_sheets(spark, sf_dir)
    return ingested(spark, loads.sheet("inventory"), documents, EVENT_RANGE)


# -- rebuilds, calendar, audits ----------------------------------------------


@query(
    f"""
SELECT date, campaign_id, campaign_name, impressions,
  clicks + CASE WHEN date BETWEEN DATE '2024-01-15' AND DATE '2024-01-17' THEN 1000
    ELSE 0 END AS clicks,
  spend_usd, reach, frequency, link_clicks, leads, conversions, loaded_at
FROM facebook"""
)
def incr_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw changes on every day; only the rebuilt days show it."""
    warehouse = new_warehouse(spark, "rebuild")
    performance = model("staging.facebook_ads_performance")
    records = inputs.raw_facebook_ads(spark, sf_dir)
    loads.load_partitions(records, warehouse, "facebook_ads")
    run_model(warehouse, performance, *EVENT_RANGE)
    changed = records.withColumn("clicks", F.col("clicks") + 1000)
    loads.load_partitions(changed, warehouse, "facebook_ads")
    run_model(warehouse, performance, date(2024, 1, 15), date(2024, 1, 17))
    return warehouse.read(performance.name)


@query(
    f"""
SELECT d.day AS partition_date, COUNT(e.k) AS events
FROM (SELECT CAST(unnest(generate_series({EVENT_FROM}, {EVENT_TO}, INTERVAL 1 DAY))
        AS DATE) AS day) AS d
LEFT JOIN event_base AS e ON e.day = d.day
GROUP BY d.day"""
)
def partition_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = (
        base(spark, sf_dir, "event_base")
        .groupBy(F.col("day").alias("partition_date"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return (
        calendar_days(spark, *EVENT_RANGE)
        .join(per_day, "partition_date", "left")
        .select("partition_date", F.coalesce("events", F.lit(0)).alias("events"))
    )


@query(
    f"""
SELECT d.day AS partition_date
FROM (SELECT CAST(unnest(generate_series({EVENT_FROM}, {EVENT_TO}, INTERVAL 1 DAY))
        AS DATE) AS day) AS d
WHERE d.day NOT IN (SELECT date FROM ads)"""
)
def backfill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that an ingest run of the whole range left without a finished load."""
    log = loads.ingest(
        loads.google_ads_account("1234567890"),
        inputs.google_ads_documents(spark, sf_dir),
        new_warehouse(spark, "gaps"),
        *EVENT_RANGE,
        RUN_ID,
        RUN_TIME,
    )
    return missing_days(calendar_days(spark, *EVENT_RANGE), log, "google_ads")


# New York is five hours behind UTC in January, where all events are.
@query("SELECT event_id, CAST(ts - INTERVAL 5 HOUR AS DATE) AS run_day FROM events")
def partition_day_ny(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", calc.new_york_day(F.col("ts")).alias("run_day")
    )


@query("SELECT * FROM students WHERE program_id IS NULL")
def audit_no_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_rows(students(spark, sf_dir), "program_id")


# Model, its CTE, audited column, grain.
MODEL_CHECKS = (
    ("staging.stripe_charges", "charges", "charge_id", "charge_date, charge_id"),
    (
        "staging.paypal_transactions",
        "transactions",
        "transaction_id",
        "transaction_date, transaction_id",
    ),
    ("staging.google_ads_performance", "ads", "date", "date, customer_id"),
    ("staging.facebook_ads_performance", "facebook", "date", "date, campaign_id"),
    (
        "staging.analytics_sessions",
        "sessions",
        "date",
        "date, session_source, session_medium, country",
    ),
    ("staging.sheet_inventory", "inventory", "sku_id", "sku_id, snapshot_date"),
    ("staging.sheet_programs", "programs", "program_id", "program_id"),
    ("staging.sheet_students", "students", "student_id", "student_id"),
    (
        "marts.revenue_by_program",
        "revenue",
        "month",
        "month, program_id, payment_source",
    ),
    ("marts.ad_attribution", "attribution", "date", "date"),
    ("marts.stock_levels", "stock", "sku_id", "sku_id, snapshot_date"),
)


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS model, '{column}' AS audited_column,
  COUNT(*) FILTER (WHERE {column} IS NULL) AS null_rows FROM {cte}"""
        for name, cte, column, _ in MODEL_CHECKS
    )
)
def audit_all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = model_frames(spark, sf_dir)
    return stacked(
        [quality.null_count(frames[m.name], m.audit_column, m.name) for m in MODELS]
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS model, '{grain}' AS grain, COUNT(*) AS grain_keys,
  COUNT(*) FILTER (WHERE c > 1) AS repeated_keys,
  COALESCE(MAX(c), 0) AS most_rows_per_key
FROM (SELECT COUNT(*) AS c FROM {cte} GROUP BY {grain}) AS keys_{number}"""
        for number, (name, cte, _, grain) in enumerate(MODEL_CHECKS)
    )
)
def grain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = model_frames(spark, sf_dir)
    return stacked(
        [quality.grain_summary(frames[m.name], m.grain, m.name) for m in MODELS]
    )


RAW_INPUTS = {
    "stripe_charges": (inputs.raw_charges, "charge_date"),
    "paypal_transactions": (inputs.raw_transactions, "transaction_date"),
    "google_ads": (inputs.raw_google_ads, ["date", "customer_id"]),
    "facebook_ads": (inputs.raw_facebook_ads, "date"),
    "google_analytics": (inputs.raw_analytics, "date"),
    "google_sheets_inventory": (inputs.raw_inventory, "partition_date"),
    "google_sheets_programs": (inputs.raw_programs, "partition_date"),
    "google_sheets_students": (inputs.raw_students, "partition_date"),
}


def loaded_raw(warehouse: Warehouse, sf_dir: str, tables: Iterable[str]) -> None:
    """Raw tables as their loads leave them; sheets as landed on one day."""
    sheet_day = F.lit(RUN_TIME.date() - timedelta(days=1))
    for name in tables:
        make, by = RAW_INPUTS[name]
        frame = make(warehouse.spark, sf_dir)
        if by == "partition_date":
            frame = frame.withColumn(by, sheet_day)
        loads.load_partitions(frame, warehouse, name, by)


def built(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart read from a warehouse that holds it, its models and their raw tables."""
    warehouse = new_warehouse(spark, "built")
    mart = model(name)
    stages = [m for m in MODELS if m.name in mart.reads]
    raws = [read.split(".")[1] for m in stages for read in m.reads]
    loaded_raw(warehouse, sf_dir, raws)
    for m in (*stages, mart):
        run_model(warehouse, m, *model_range(m.name))
    return warehouse.read(name)


@query("SELECT * FROM revenue")
def built_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "marts.revenue_by_program")


@query("SELECT * FROM attribution")
def built_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "marts.ad_attribution")


@query("SELECT * FROM stock")
def built_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, "marts.stock_levels")


LATE_DAY, LATE_MONTH = date(2024, 3, 9), (date(2024, 3, 1), date(2024, 3, 31))


@query(
    f"""
SELECT 'staging.stripe_charges' AS model, COUNT(*) AS row_count,
  CAST(1 AS BIGINT) AS days_built
FROM charges WHERE charge_date = DATE '{LATE_DAY}'
UNION ALL
SELECT 'marts.revenue_by_program' AS model, COUNT(*) AS row_count,
  CAST(31 AS BIGINT) AS days_built
FROM revenue WHERE month = DATE '{LATE_MONTH[0]}'"""
)
def incr_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of charges comes late: that day of staging and its month of revenue are
    built again, and no other day or model."""
    warehouse = new_warehouse(spark, "changes")
    tables = ("stripe_charges", "paypal_transactions", "google_sheets_programs")
    loaded_raw(warehouse, sf_dir, tables)
    raw = inputs.raw_charges(spark, sf_dir)
    late = raw.where(F.col("charge_date") == F.lit(LATE_DAY))
    # Before, the day had other amounts.
    kind = raw.schema["gross_amount_usd"].dataType
    early = late.withColumn("gross_amount_usd", (F.col("gross_amount_usd") + 1).cast(kind))
    loads.load_partitions(early, warehouse, "stripe_charges", "charge_date")
    revenue = model("marts.revenue_by_program")
    for m in (*(m for m in MODELS if m.name in revenue.reads), revenue):
        run_model(warehouse, m, *PAYMENT_RANGE)
    loads.load_partitions(late, warehouse, "stripe_charges", "charge_date")
    changed = {"raw.stripe_charges": {LATE_DAY}, "raw.paypal_transactions": {LATE_DAY}}
    done = rebuild_changed(warehouse, changed, *PAYMENT_RANGE)
    done.pop("staging.paypal_transactions")  # built too, found unchanged
    return stacked(
        [
            warehouse.read(name)
            .where(F.col(model(name).time_column).between(*ranges[0]))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(
                F.lit(name).alias("model"),
                "row_count",
                F.lit(sum((b - a).days + 1 for a, b in ranges)).cast("bigint").alias("days_built"),
            )
            for name, ranges in done.items()
        ]
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS model, '{grain}' AS grain, COUNT(*) AS grain_keys,
  COUNT(*) FILTER (WHERE c > 1) AS repeated_keys,
  COALESCE(MAX(c), 0) AS most_rows_per_key
FROM (SELECT COUNT(*) AS c FROM {cte} GROUP BY {grain}) AS keys_{number}"""
        for number, (name, cte, _, grain) in enumerate(MODEL_CHECKS)
    )
)
def grain_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grain report of a built warehouse, some days of it built twice: only the counts
    kept with the builds are read."""
    warehouse = new_warehouse(spark, "grain")
    loaded_raw(warehouse, sf_dir, RAW_INPUTS)
    for m in MODELS:
        run_model(warehouse, m, *model_range(m.name))
    for name in ("staging.facebook_ads_performance", "staging.sheet_students"):
        run_model(warehouse, model(name), date(2024, 1, 10), date(2024, 1, 12))
    return grain_of_warehouse(warehouse)


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS model, COUNT(*) AS row_count FROM {cte}"
        for name, cte, _, _ in MODEL_CHECKS
    )
)
def run_all_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the raw tables, build every model in order, count what was built."""
    warehouse = new_warehouse(spark, "models")
    loaded_raw(warehouse, sf_dir, RAW_INPUTS)
    for m in MODELS:
        run_model(warehouse, m, *model_range(m.name))
    return stacked(
        [
            warehouse.read(m.name)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(m.name).alias("model"), "row_count")
            for m in MODELS
        ]
    )
