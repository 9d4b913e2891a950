"""Business columns derived from the star-schema tables, row by row.

The engine's inputs (charges, transactions, ads, sessions, students, stock) are
read out of ``orders``, ``lineitem``, ``events`` and ``part``: one input row per
table row, without joins, so a query's work grows with its table.  The texts
below are shared by Spark and by the SQL check, because both must start from
the same input; everything after them is written separately.

Seven years of order and ship dates are folded onto the 182 days from
2024-01-01 to 2024-06-30 (day 19723 since 1970 is the first), keeping all rows.

Written for both dialects, with two names replaced for each: ``//`` is whole
division and ``epoch_days(d)`` the days since 1970-01-01.
"""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

# The words that part names are made of, in no special order.
ADJECTIVES = "blue cold hot large new old red small"
NOUNS = "anvil bolt gear gizmo plate ring rod widget"

RUN_ID = "run-0001"
RUN_TIME = datetime(2024, 2, 1, 6, 0, tzinfo=UTC)
PAYMENT_RANGE = (date(2024, 1, 1), date(2024, 6, 30))
EVENT_RANGE = (date(2024, 1, 1), date(2024, 1, 31))

ORDER_BASE = f"""
SELECT
  o_orderkey AS k,
  o_custkey AS cust,
  o_orderstatus AS flag,
  o_orderpriority AS priority,
  DATE '2024-01-01' + CAST(epoch_days(CAST(o_orderdate AS DATE)) % 182 AS INT)
    AS paid_on,
  (epoch_days(CAST(o_orderdate AS DATE)) % 182 + 19723) * 86400
    + (o_custkey * 61) % 86400 AS created,
  CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
  CAST(round(o_totalprice * 100) AS BIGINT) * 29 // 1000 + 30 AS fee_cents,
  CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'pending'
    ELSE 'failed' END AS status,
  split_part('{ADJECTIVES}', ' ', CAST(o_custkey % 8 AS INT) + 1) || ' '
    || split_part('{NOUNS}', ' ', CAST((o_custkey // 8) % 8 AS INT) + 1) AS course
FROM orders
"""

LINE_BASE = f"""
SELECT
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-'
    || CAST(l_partkey AS STRING) AS k,
  l_orderkey AS order_key,
  l_linenumber AS line_number,
  l_suppkey AS supp,
  l_returnflag AS flag,
  l_linestatus AS line_status,
  CAST(l_quantity AS INT) AS quantity,
  DATE '2024-01-01' + CAST(epoch_days(CAST(l_shipdate AS DATE)) % 182 AS INT)
    AS paid_on,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
  CAST(round(l_tax * 100) AS BIGINT) AS tax_percent,
  CAST(round(l_discount * 100) AS BIGINT) AS discount_percent,
  CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT)
    // 100 AS fee_cents,
  CASE l_returnflag WHEN 'N' THEN 'S' WHEN 'A' THEN 'P' ELSE 'V' END AS status,
  split_part('{ADJECTIVES}', ' ', CAST(l_partkey % 8 AS INT) + 1) || ' '
    || split_part('{NOUNS}', ' ', CAST((l_partkey // 8) % 8 AS INT) + 1) AS course
FROM lineitem
"""

EVENT_BASE = """
SELECT
  event_id AS k,
  user_id,
  event_type,
  CAST(ts AS DATE) AS day,
  CAST(ts AS DATE) - CAST(CASE WHEN extract(day FROM ts) % 7 = 0 THEN 1 ELSE 0 END
    AS INT) AS ad_day,
  CAST(round(value * 100) AS BIGINT) AS cents,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS n
FROM events
"""

PART_BASE = """
SELECT
  p_partkey AS k,
  p_name AS name,
  split_part(p_name, ' ', 2) AS noun,
  CAST(p_size AS BIGINT) AS size,
  CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
  DATE '2024-01-01' + CAST(p_partkey % 30 AS INT) AS snapshot_date
FROM part
"""

BASES = {
    "order_base": ("orders", ORDER_BASE),
    "line_base": ("lineitem", LINE_BASE),
    "event_base": ("events", EVENT_BASE),
    "part_base": ("part", PART_BASE),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, text = BASES[name]
    text = text.replace("//", " div ").replace("epoch_days(", "unix_date(")
    text = text.replace(f"FROM {source}\n", f"FROM {{{source}}}\n")
    return spark.sql(text, **{source: table(spark, sf_dir, source)})


def base_sql(name: str) -> str:
    text = BASES[name][1]
    return text.replace("epoch_days(", "date_diff('day', DATE '1970-01-01', ")
