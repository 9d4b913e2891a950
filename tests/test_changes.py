"""Counts kept with builds, and which models a changed day makes due."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import snapshots, states
from ledgerline.plans import changes
from ledgerline.plans import ingest as loads
from ledgerline.plans.changes import due_ranges, runs_of_days
from ledgerline.plans.models import model
from ledgerline.plans.runner import grain_report, run_model
from ledgerline.schemas import RUN_LOG

D1, D2, D3 = (date(2024, 3, n) for n in (8, 9, 10))
FIRST, LAST = date(2024, 1, 1), date(2024, 6, 30)


def test_runs_of_days():
    days = [D3, D1, D2, D1, date(2024, 3, 20)]
    assert runs_of_days(days) == [(D1, D3), (date(2024, 3, 20),) * 2]
    assert runs_of_days([]) == []


@pytest.mark.parametrize(
    ("name", "changed", "want"),
    [
        ("staging.stripe_charges", {"raw.stripe_charges": {D2}}, [(D2, D2)]),
        ("staging.stripe_charges", {"raw.paypal_transactions": {D2}}, []),
        ("marts.revenue_by_program", {"staging.stripe_charges": {D2}}, [(date(2024, 3, 1), date(2024, 3, 31))]),
        ("marts.revenue_by_program", {"staging.sheet_programs": {D2}}, [(FIRST, LAST)]),
        ("staging.sheet_programs", {"raw.google_sheets_programs": {D2}}, [(FIRST, LAST)]),
        ("marts.ad_attribution", {"staging.sheet_students": {D1, D2}, "staging.analytics_sessions": {D3}}, [(D1, D3)]),
        ("marts.stock_levels", {"staging.sheet_inventory": {D2}}, [(D2, D2)]),
        ("marts.stock_levels", {"staging.sheet_students": {D2}}, [(FIRST, LAST)]),
        ("marts.stock_levels", {"staging.sheet_students": set()}, []),
    ],
)
def test_edges(name, changed, want):
    assert due_ranges(model(name), changed, FIRST, LAST) == want


def test_loads_since_a_moment(warehouse):
    spark, noon = warehouse.spark, datetime(2024, 4, 1, 12, tzinfo=UTC)
    rows = [
        ("stripe_charges", D1, "r1", "loaded", noon),
        ("stripe_charges", D2, "r2", "loaded", noon + timedelta(seconds=1)),
        ("stripe_charges", D3, "r2", "skipped", noon + timedelta(seconds=1)),
        ("google_ads", D3, "r3", "loaded", noon + timedelta(days=1)),
    ]
    names = RUN_LOG.fieldNames()
    values = [
        tuple({"source": s, "partition_date": d, "run_id": r, "status": x, "logged_at": t}.get(n) for n in names)
        for s, d, r, x, t in rows
    ]
    frame = spark.createDataFrame(values, RUN_LOG)
    for source in ("stripe_charges", "google_ads"):
        rows = frame.where(F.col("source") == source)
        loads._replace_log_rows(warehouse, source, rows, D1, D3)
    found = changes.loaded_since(warehouse, noon)
    assert found == {"raw.stripe_charges": {D2}, "raw.google_ads": {D3}}


def facebook(spark, *rows):
    """Raw rows of day, campaign and clicks."""
    from test_tables import fb_raw

    return fb_raw(spark, *rows)


def test_states_follow_the_builds_that_count(warehouse):
    spark, name = warehouse.spark, "staging.facebook_ads_performance"
    path = warehouse.path(name)
    loads.load_partitions(facebook(spark, (D1, "a", 1), (D1, "a", 2), (D2, "b", 3)), warehouse, "facebook_ads")
    run_model(warehouse, model(name), D1, D3)
    first = snapshots.current(spark, path)

    def report():
        return tuple(states.grain_of(spark, path, snapshots.current(spark, path)).head())

    assert report() == (2, 1, 2)
    # One day again, with other values and another key: only it is counted anew.
    loads.load_partitions(facebook(spark, (D1, "a", 1), (D1, "c", 2)), warehouse, "facebook_ads")
    run_model(warehouse, model(name), D1, D1)
    second = snapshots.current(spark, path)
    assert report() == (3, 0, 1)
    assert states.changed_days(spark, path, first, second) == [D1]
    # Again without any change; rows come in another order.
    loads.load_partitions(facebook(spark, (D1, "c", 2), (D1, "a", 1)), warehouse, "facebook_ads")
    run_model(warehouse, model(name), D1, D2)
    third = snapshots.current(spark, path)
    assert states.changed_days(spark, path, second, third) == [] and report() == (3, 0, 1)
    assert states.changed_days(spark, path, snapshots.Snapshot(), third) == [D1, D2]


def test_keys_that_cross_days_are_added_up(spark, warehouse):
    path = f"{warehouse.root}/t"
    rows = [(D1, "a"), (D1, "a"), (D2, "a"), (D2, None), (D3, None), (D3, "b")]
    frame = spark.createDataFrame(rows, "day_of date, student string")
    states.keep(frame.where(F.col("day_of") < F.lit(D3)), path, "one", "day_of", ("student",))
    states.keep(frame, path, "two", "day_of", ("student",))
    mixed = snapshots.Snapshot(1, "day_of", None, {str(D1): "one", str(D2): "one", str(D3): "two"})
    assert tuple(states.grain_of(spark, path, mixed).head()) == (3, 2, 3)
    less = snapshots.Snapshot(1, "day_of", None, {str(D2): "two"})
    assert tuple(states.grain_of(spark, path, less).head()) == (2, 0, 1)
    assert tuple(states.grain_of(spark, path, snapshots.Snapshot()).head()) == (0, 0, 0)


def test_unchanged_models_pass_nothing_on(warehouse):
    spark = warehouse.spark
    loads.load_partitions(facebook(spark, (D1, "a", 1), (D2, "b", 3)), warehouse, "facebook_ads")
    run_model(warehouse, model("staging.facebook_ads_performance"), FIRST, LAST)
    loads.load_partitions(facebook(spark, (D1, "a", 9)), warehouse, "facebook_ads")
    done = changes.rebuild_changed(warehouse, {"raw.facebook_ads": {D1, D2}}, FIRST, LAST)
    # No mart reads it; both days were built, one differs.
    assert done == {"staging.facebook_ads_performance": [(D1, D2)]}
    rows = warehouse.read("staging.facebook_ads_performance").collect()
    assert {(r.date, r.clicks) for r in rows} == {(D1, 9), (D2, 3)}


def test_the_report_of_an_empty_warehouse(warehouse):
    rows = grain_report(warehouse).collect()
    assert len(rows) == 11 and all(r.grain_keys == 0 for r in rows)
