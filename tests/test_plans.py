"""The plans themselves: joins, shuffles, pruning."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import ingest as loads
from ledgerline.plans import marts, staging
from ledgerline.plans.warehouse import Warehouse
from ledgerline.session import scratch_path
from ledgerline.workload.catalog import QUERIES
from ledgerline.workload.inputs import raw_charges, raw_transactions

SF_DIR = "/root/testdata/sf0.001"
# These run jobs of their own and read back a table.
WRITERS = {
    "run_log",
    "lake_append",
    "load_partition",
    "load_clustered",
    "incr_rebuild",
    "run_all_models",
    "incr_changed_days",
    "grain_from_states",
} | {name for name in QUERIES if name.startswith(("ingest_", "built_"))}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(frame) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(frame)))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_products(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_revenue_shuffles_once_per_aggregate(spark):
    # Stripe and PayPal; programs are matched within the rows.
    assert hash_exchanges(QUERIES["mart_revenue"](spark, SF_DIR)) == 2


def test_attribution_broadcasts_day_frames(spark):
    text = plan(QUERIES["mart_attribution"](spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in text


def test_stock_does_not_shuffle_the_inventory(spark):
    frame = QUERIES["mart_stock"](spark, SF_DIR)
    assert hash_exchanges(frame) == 0
    assert "BroadcastHashJoin" in plan(frame)


def test_partition_and_column_pruning(spark):
    warehouse = Warehouse(spark, scratch_path(spark, "plans"))
    start, end = date(2024, 2, 1), date(2024, 2, 29)
    for name, make, day in (
        ("stripe_charges", raw_charges, "charge_date"),
        ("paypal_transactions", raw_transactions, "transaction_date"),
    ):
        rows = make(spark, SF_DIR).where(F.col(day).between(start, end))
        loads.load_partitions(rows, warehouse, name, day)
    charges = staging.stripe_charges(warehouse.read("raw.stripe_charges"), start, end)
    text = plan(marts.stripe_revenue(charges, start, end))
    (scan,) = re.findall(r"FileScan parquet .*", text)
    assert re.search(r"PartitionFilters: \[[^]]*charge_date", scan)
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,succeeded)]" in scan
    columns = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert re.findall(r"(\w+):", columns) == [
        "gross_amount_usd",
        "fee_usd",
        "net_usd",
        "status",
        "description",
    ]
