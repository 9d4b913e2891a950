"""Engine inputs from the bases: raw tables, and landed JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.ingest import add_loaded_at
from ledgerline.sources.google_sheets import INVENTORY
from ledgerline.sources.landed import documents_from_text
from ledgerline.workload.bases import RUN_TIME, base


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01 AS DECIMAL(27,9))"


def dollars(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01 AS STRING)"


# -- raw tables --------------------------------------------------------------


def raw_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "order_base").selectExpr(
        "'ch_' || k AS charge_id",
        "paid_on AS charge_date",
        f"{money('cents')} AS gross_amount_usd",
        f"{money("if(flag = 'P', 0, cents)")} AS amount_captured_usd",
        f"{money('fee_cents')} AS fee_usd",
        f"{money('cents - fee_cents')} AS net_usd",
        "'usd' AS currency",
        "status",
        """CASE priority WHEN '5-LOW' THEN 'Gift card'
             WHEN '4-NOT SPECIFIED' THEN ''
             WHEN '1-URGENT' THEN 'Enrollment - ' || upper(course)
             ELSE 'Tuition: ' || course END AS description""",
        """CASE priority WHEN '3-MEDIUM' THEN ''
             WHEN '2-HIGH' THEN 'r' || cust || '@example.com'
             ELSE 'c' || cust || '@example.com' END AS customer_email""",
        "'Customer ' || cust AS customer_name",
        "if(flag = 'P', '', 'pi_' || k) AS payment_intent_id",
    )
    return add_loaded_at(frame, RUN_TIME)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "line_base").selectExpr(
        "if(flag = 'R', 'ref_', 'tx_') || k AS transaction_id",
        "paid_on AS transaction_date",
        f"{money('cents')} AS gross_amount_usd",
        "'USD' AS currency_code",
        "status AS transaction_status",
        f"{SUBJECT} AS transaction_subject",
        "if(line_number = 5, '', 's' || supp || '@example.com') AS payer_email",
        """CASE line_number WHEN 5 THEN '' WHEN 6 THEN 'Shore' || supp
             WHEN 7 THEN 'Pat' ELSE 'Pat Shore' || supp END AS payer_name""",
        f"{money('-fee_cents')} AS fee_amount_usd",
        f"{money('if(discount_percent = 0, 0, cents - fee_cents)')} AS net_amount_usd",
    )
    return add_loaded_at(frame, RUN_TIME)


SUBJECT = """CASE WHEN quantity = 50 THEN ''
  WHEN line_status = 'O' THEN upper(course) || ' COURSE'
  ELSE 'Payment for ' || course END"""


def raw_google_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "event_base").selectExpr(
        "ad_day AS date",
        "1 + user_id % 7 AS clicks",
        "100 + user_id AS impressions",
        "cents * 10000 + k % 10000 AS cost_micros",
        f"CAST({AD_CONVERSIONS} AS DOUBLE) AS conversions",
        "CAST(100 + user_id % 5 AS STRING) AS customer_id",
    )
    return add_loaded_at(frame, RUN_TIME)


AD_CONVERSIONS = "CASE event_type WHEN 'purchase' THEN 1.5 WHEN 'signup' THEN 1 ELSE 0 END"


def raw_facebook_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "event_base").selectExpr(
        "day AS date",
        "'cmp_' || n % 10 AS campaign_id",
        "'Campaign ' || n % 10 AS campaign_name",
        "1000 + user_id AS impressions",
        "n AS clicks",
        f"{money('cents')} AS spend_usd",
        "900 + user_id AS reach",
        "CAST((100 + n) / 100 AS DOUBLE) AS frequency",
        "CASE event_type WHEN 'click' THEN n WHEN 'purchase' THEN 1 ELSE 0 END AS link_clicks",
        "CAST(if(event_type = 'signup', 5, 0) AS BIGINT) AS leads",
        "CAST(if(event_type = 'purchase', 2, 0) AS BIGINT) AS conversions",
    )
    return add_loaded_at(frame, RUN_TIME)


def raw_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "event_base").selectExpr(
        "day AS date",
        f"{SESSION_SOURCE} AS sessionSource",
        "event_type AS sessionMedium",
        f"{COUNTRY} AS country",
        "CAST(1 + n % 9 AS STRING) AS sessions",
        "CAST(5 + user_id AS STRING) AS screenPageViews",
        f"{dollars('n')} AS bounceRate",
        f"CAST({AD_CONVERSIONS} AS STRING) AS conversions",
    )
    return add_loaded_at(frame, RUN_TIME)


SESSION_SOURCE = "split_part('google cpc paid direct', ' ', CAST(user_id % 4 AS INT) + 1)"
COUNTRY = "split_part('Japan Peru Kenya', ' ', CAST(n % 3 AS INT) + 1)"


def raw_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "event_base").selectExpr(
        "'st_' || k AS student_id",
        "'First' || user_id AS first_name",
        "'Last' || n AS last_name",
        "'u' || user_id || '@example.com' AS email",
        "'555-' || lpad(CAST(k % 10000 AS STRING), 4, '0') AS phone",
        "if(n = 0, NULL, 'prog_' || user_id % 20) AS program_id",
        """CASE event_type WHEN 'purchase' THEN 'graduated'
             WHEN 'error' THEN 'withdrawn' ELSE 'active' END AS enrollment_status""",
        "CAST(day AS STRING) AS enrolled_at",
        "CAST(day + 180 AS STRING) AS expected_grad_date",
        "if(event_type = 'purchase', CAST(day + 150 AS STRING), NULL) AS actual_grad_date",
    )
    return add_loaded_at(frame, RUN_TIME)


STOCK_TEXTS = {
    "sku_id": "'sku_' || k",
    "sku_name": "name",
    "program_id": "if(size = 50, NULL, 'prog_' || k % 25)",
    "quantity_on_hand": "CAST(size - 5 AS STRING)",
    "reorder_threshold": "'10'",
    "reorder_quantity": "CAST(2 * size AS STRING)",
    "unit_cost_usd": dollars("cents"),
    "units_per_student": dollars("size"),
    "snapshot_date": "CAST(snapshot_date AS STRING)",
}


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = base(spark, sf_dir, "part_base").selectExpr(
        *[f"{text} AS {name}" for name, text in STOCK_TEXTS.items()]
    )
    return add_loaded_at(frame, RUN_TIME)


def raw_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs named after parts, after their nouns, and with a wildcard.

    A noun program ('Ring') and a part program ('Small Ring') both match the
    same subject; 'g_ar' matches 'gear' only as a pattern.
    """
    frame = (
        base(spark, sf_dir, "part_base")
        .selectExpr(
            "k",
            """explode(array(
                 named_struct('family', 'prog_', 'program_name', initcap(name)),
                 named_struct('family', 'fam_', 'program_name', initcap(noun)),
                 named_struct('family', 'wild_', 'program_name',
                              replace(noun, 'ea', '_a')))) AS p""",
        )
        .groupBy("p.family", "p.program_name")
        .agg(F.min("k").alias("k"))
        .selectExpr(
            "family || k AS program_id",
            "program_name",
            "upper(substring(program_name, 1, 3)) || k AS program_code",
            "CAST(4 + k % 48 AS STRING) AS duration_weeks",
            "CAST(10 + k % 30 AS STRING) AS max_enrollment",
            "if(k % 2 = 0, 'TRUE', 'false') AS is_active",
        )
    )
    return add_loaded_at(frame, RUN_TIME)


# -- landed documents --------------------------------------------------------


def spread_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base on all cores: writing and reading JSON is CPU work.

    A table too small to be split is one task, and is spread out; one with a
    split for every core is left alone.
    """
    frame = base(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


CHARGE = """to_json(named_struct(
  'id', 'ch_' || k,
  'created', created,
  'amount', cents,
  'amount_captured', if(flag = 'P', 0, cents),
  'balance_transaction', named_struct('fee', fee_cents, 'net', cents - fee_cents),
  'currency', 'usd',
  'status', status,
  'description', CASE priority WHEN '5-LOW' THEN 'Gift card'
    WHEN '4-NOT SPECIFIED' THEN NULL
    WHEN '1-URGENT' THEN 'Enrollment - ' || upper(course)
    ELSE 'Tuition: ' || course END,
  'billing_details', named_struct(
    'email', CASE priority WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN ''
      ELSE 'c' || cust || '@example.com' END,
    'name', 'Customer ' || cust),
  'receipt_email', CASE priority WHEN '2-HIGH' THEN 'r' || cust || '@example.com'
    WHEN '3-MEDIUM' THEN '' END,
  'payment_intent', if(flag = 'P', NULL, 'pi_' || k)))"""

# Unexpanded balance transaction, no billing texts, no payment intent.
SPARSE_CHARGE = """to_json(named_struct(
  'id', 'ch_' || k || '_b',
  'created', created,
  'amount', cents div 2,
  'amount_captured', cents div 2,
  'balance_transaction', 'txn_' || k,
  'currency', 'usd',
  'status', 'succeeded',
  'billing_details', named_struct('name', CAST(NULL AS STRING)),
  'receipt_email', 'r' || cust || '@example.com'))"""


def stripe_pages(
    spark: SparkSession, sf_dir: str, *more: str
) -> DataFrame:
    """A page per order: none, one or two charges."""
    texts = spread_base(spark, sf_dir, "order_base").selectExpr(
        "paid_on AS landed_date",
        *more,
        f"""'{{"data":[' || concat_ws(',',
              if(priority = '1-URGENT' AND flag = 'O', NULL, {CHARGE}),
              if(flag = 'F', {SPARSE_CHARGE}, NULL))
            || '],"has_more":false}}' AS document""",
    )
    return documents_from_text(texts, schemas.STRIPE_PAGE)


# Pages of a day that are put in order together; days themselves may be of any size.
PAGES_IN_ORDER = 1000


def fetched_stripe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a day as one fetch gives them: each names the charge it follows.

    On even days a last page without charges says that there are no more.  Pages are put
    in order within ranges of their keys; the ends of the ranges are linked after that.
    """
    bucket = f"k div {PAGES_IN_ORDER} AS page_range"
    pages = stripe_pages(spark, sf_dir, "k AS page_key", bucket).where(F.size("data") > 0)
    pages = pages.withColumn("own_end", F.try_element_at("data", F.lit(-1))["id"])
    near = Window.partitionBy("landed_date", "page_range").orderBy("page_key")
    by_range = Window.partitionBy("landed_date").orderBy("page_range")
    edges = pages.groupBy("landed_date", "page_range").agg(
        F.max_by("own_end", "page_key").alias("range_end")
    )
    edges = edges.select(
        "landed_date",
        "page_range",
        F.lag("range_end").over(by_range).alias("range_before"),
        F.lead("range_end").over(by_range).isNotNull().alias("more_ranges"),
    )
    goes_on = F.dayofmonth("landed_date") % 2 == 0
    more_near = F.lead("own_end").over(near).isNotNull()
    linked = pages.withColumns(
        {"near_before": F.lag("own_end").over(near), "more_near": more_near}
    ).join(edges, ["landed_date", "page_range"])
    columns = ["landed_date", "data", "starting_after", "has_more"]
    whole = linked.withColumns(
        {
            "starting_after": F.coalesce("near_before", "range_before"),
            "has_more": F.col("more_near") | F.col("more_ranges") | goes_on,
        }
    ).select(*columns)
    ends = pages.where(goes_on).groupBy("landed_date").agg(
        F.max_by("own_end", "page_key").alias("starting_after")
    )
    data = F.array().cast(pages.schema["data"].dataType).alias("data")
    last = ends.select("landed_date", data, "starting_after", F.lit(False).alias("has_more"))
    return whole.unionByName(last)


def fetched_paypal_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of a day as one fetch gives them: numbered, with their total.

    Numbers count within ranges of keys, from the number of pages in the ranges before.
    Lines are numbered before they become pages: they are a fraction of a page's bytes.
    """
    lines = spread_base(spark, sf_dir, "line_base").selectExpr(
        "*", f"order_key div {PAGES_IN_ORDER} AS page_range"
    )
    near = Window.partitionBy("paid_on", "page_range").orderBy("k")
    day = Window.partitionBy("paid_on")
    sizes = lines.groupBy("paid_on", "page_range").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select(
        "paid_on",
        "page_range",
        (F.sum("n").over(day.orderBy("page_range")) - F.col("n")).alias("pages_before"),
        F.sum("n").over(day).alias("pages_in_all"),
    )
    numbered = lines.withColumn("near_number", F.row_number().over(near)).join(
        offsets, ["paid_on", "page_range"]
    )
    return paypal_documents(numbered, "pages_before + near_number", "pages_in_all")


def stripe_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen pages per chain; some cursors name a lost page.

    Of every seven chains one is cut in two with a loop in its rest, one has a page that
    two others continue, and one ends in a page with more to come.
    """
    texts = spread_base(spark, sf_dir, "order_base").selectExpr(
        "DATE '2024-01-01' + CAST(k div 16 % 182 AS INT) AS landed_date",
        "k div 16 AS chain",
        """to_json(named_struct(
             'starting_after', CASE WHEN flag = 'P' AND priority = '5-LOW'
                 THEN 'ch_lost_' || k
               WHEN k div 16 % 7 = 1 AND k % 16 = 12 THEN 'ch_' || (k + 3)
               WHEN k div 16 % 7 = 2 AND k % 16 = 9 THEN 'ch_' || (k - 2)
               WHEN k % 16 > 0 THEN 'ch_' || (k - 1) END,
             'data', array(named_struct('id', 'ch_' || k)),
             'has_more', k % 16 < 15 AND NOT (k div 16 % 7 = 1 AND k % 16 = 11)
               OR k div 16 % 7 = 3 OR (k div 16 % 7 = 1 AND k % 16 = 15))) AS document""",
    )
    return documents_from_text(texts, schemas.STRIPE_PAGE_LINKS)


TRANSACTION = f"""named_struct(
  'transaction_info', named_struct(
    'transaction_id', 'tx_' || k,
    'paypal_reference_id', if(flag = 'R', 'ref_' || k, ''),
    'transaction_initiation_date', {{initiated}},
    'transaction_amount', named_struct('value', {dollars('cents')},
                                       'currency_code', 'USD'),
    'transaction_status', status,
    'transaction_subject', if(quantity = 50, NULL, {SUBJECT}),
    'fee_amount', if(tax_percent = 0, NULL,
      named_struct('value', {dollars('-fee_cents')}, 'currency_code', 'USD')),
    'transaction_net_amount', if(discount_percent = 0, NULL,
      named_struct('value', {dollars('cents - fee_cents')}))),
  'payer_info', if(line_number = 5, NULL, named_struct(
    'email_address', 's' || supp || '@example.com',
    'payer_name', named_struct(
      'given_name', if(line_number = 6, '', 'Pat'),
      'surname', if(line_number = 7, NULL, 'Shore' || supp)))))"""

INITIATED = """CAST(paid_on AS STRING) || 'T'
  || lpad(CAST(quantity % 24 AS STRING), 2, '0') || ':30:00+0000'"""


def paypal_pages(
    spark: SparkSession, sf_dir: str, *more: str
) -> DataFrame:
    """A page per line: one transaction, or no list at all."""
    return paypal_documents(spread_base(spark, sf_dir, "line_base"), "1", "1", *more)


def paypal_documents(lines: DataFrame, page: str, total_pages: str, *more: str) -> DataFrame:
    transaction = TRANSACTION.format(initiated=INITIATED)
    texts = lines.selectExpr(
        "paid_on AS landed_date",
        *more,
        f"""to_json(named_struct(
              'page', {page},
              'total_pages', {total_pages},
              'transaction_details', if(line_number = 4 AND flag = 'A', NULL,
                array({transaction})))) AS document""",
    )
    return documents_from_text(texts, schemas.PAYPAL_PAGE)


def paypal_page_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A set of one to three numbered pages per order: whole, short or repeated."""
    texts = spread_base(spark, sf_dir, "line_base").selectExpr(
        "DATE '2024-01-01' + CAST(order_key % 182 AS INT) AS landed_date",
        "order_key",
        """to_json(named_struct(
             'page', 1 + (line_number - 1) % (1 + order_key % 3),
             'total_pages', 1 + order_key % 3)) AS document""",
    )
    return documents_from_text(texts, schemas.PAYPAL_PAGE_NUMBERS)


def google_ads_documents(
    spark: SparkSession, sf_dir: str, more_clicks: int = 0
) -> DataFrame:
    clicks = f"CAST({1 + more_clicks} + user_id % 7 AS STRING)"
    return _ads_documents(spark, sf_dir, clicks, "false")


def faulty_google_ads_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable clicks on error events, no conversions on view events."""
    return _ads_documents(
        spark,
        sf_dir,
        "if(event_type = 'error', 'n/a', CAST(1 + user_id % 7 AS STRING))",
        "event_type = 'view'",
    )


def _ads_documents(
    spark: SparkSession, sf_dir: str, clicks: str, without_conversions: str
) -> DataFrame:
    texts = spread_base(spark, sf_dir, "event_base").selectExpr(
        "ad_day AS landed_date",
        f"""to_json(named_struct(
              'segments', named_struct('date', CAST(ad_day AS STRING)),
              'metrics', named_struct(
                'clicks', {clicks},
                'impressions', CAST(100 + user_id AS STRING),
                'costMicros', CAST(cents * 10000 + k % 10000 AS STRING),
                'conversions', if({without_conversions}, NULL,
                  CAST({AD_CONVERSIONS} AS STRING))))) AS document""",
    )
    return documents_from_text(texts, schemas.GOOGLE_ADS_ROW)


def analytics_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report per event: no rows, one, or two."""

    def row(medium: str) -> str:
        dimensions = ("date_format(day, 'yyyyMMdd')", SESSION_SOURCE, medium, COUNTRY)
        metrics = (
            "CAST(1 + n % 9 AS STRING)",
            "CAST(5 + user_id AS STRING)",
            dollars("n"),
            f"CAST({AD_CONVERSIONS} AS STRING)",
        )

        def values(texts: tuple[str, ...]) -> str:
            return f"array({', '.join(f"named_struct('value', {t})" for t in texts)})"

        return (
            f"named_struct('dimension_values', {values(dimensions)}, "
            f"'metric_values', {values(metrics)})"
        )

    texts = spread_base(spark, sf_dir, "event_base").selectExpr(
        "day AS landed_date",
        f"""to_json(named_struct('rows', CASE event_type
              WHEN 'error' THEN NULL
              WHEN 'view' THEN array({row('event_type')}, {row("'second view'")})
              ELSE array({row('event_type')}) END)) AS document""",
    )
    return documents_from_text(texts, schemas.ANALYTICS_REPORT)


def facebook_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions: with a fraction, repeated, of two kinds, empty, missing."""

    def action(kind: str, value: str) -> str:
        return f"named_struct('action_type', '{kind}', 'value', {value})"

    purchase = action("offsite_conversion.fb_pixel_purchase", "'2'")
    texts = spread_base(spark, sf_dir, "event_base").selectExpr(
        "day AS landed_date",
        f"""to_json(named_struct(
              'date_start', CAST(day AS STRING),
              'campaign_id', 'cmp_' || n % 10,
              'campaign_name', 'Campaign ' || n % 10,
              'impressions', CAST(1000 + user_id AS STRING),
              'clicks', CAST(n AS STRING),
              'spend', {dollars('cents')},
              'reach', CAST(900 + user_id AS STRING),
              'frequency', {dollars('100 + n')},
              'actions', CASE event_type
                WHEN 'click' THEN array({action('link_click', "n || '.7'")})
                WHEN 'signup' THEN array({action('lead', "'3'")}, {action('lead', "'5'")})
                WHEN 'purchase' THEN array({purchase}, {action('link_click', "'1'")})
                WHEN 'view' THEN CAST(array() AS
                  ARRAY<STRUCT<action_type: STRING, value: STRING>>)
                END)) AS document""",
    )
    return documents_from_text(texts, schemas.FACEBOOK_INSIGHT)


def inventory_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet per part; odd sizes have their columns in reverse order."""
    texts_of = {**STOCK_TEXTS, "program_id": "'prog_' || k % 25"}

    def values(names: list[str]) -> str:
        header = ", ".join(f"'{name}'" for name in names)
        cells = ", ".join(texts_of[name] for name in names)
        return f"array(array({header}), array({cells}))"

    forward, backward = list(INVENTORY), list(reversed(INVENTORY))
    texts = spread_base(spark, sf_dir, "part_base").selectExpr(
        "snapshot_date AS landed_date",
        f"""to_json(named_struct('sheet', 'inventory', 'values',
              if(size % 2 = 0, {values(forward)}, {values(backward)}))) AS document""",
    )
    return documents_from_text(texts, schemas.SHEET_VALUES)


