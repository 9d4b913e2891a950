"""Model registry: what each table is built from, when, and how it is audited."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from ledgerline.plans import marts, staging

BY_DAY, BY_MONTH, FULL = "by day range", "by month range", "full"

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Model:
    """One staging or mart table.

    ``grain`` is what the table is meant to be keyed by.  It is reported, never
    enforced: attribution has one row per day and program, and revenue repeats
    its grain for every subject and program name.
    """

    name: str
    kind: str
    time_column: str | None
    grain: tuple[str, ...]
    audit_column: str
    reads: tuple[str, ...]
    build: Callable[[Inputs, date, date], DataFrame]
    # The input has the same day folders, so the write needs no shuffle.
    keeps_layout: bool = False
    # Inputs that are not limited to the day range.
    whole_reads: tuple[str, ...] = ()


def _staging(
    table: str,
    raw: str,
    time_column: str | None,
    grain: tuple[str, ...],
    audit_column: str,
    keeps_layout: bool = False,
) -> Model:
    project = getattr(staging, table)

    def build(inputs: Inputs, start: date, end: date) -> DataFrame:
        if time_column is None:
            return project(inputs[f"raw.{raw}"])
        return project(inputs[f"raw.{raw}"], start, end)

    return Model(
        name=f"staging.{table}",
        kind=FULL if time_column is None else BY_DAY,
        time_column=time_column,
        grain=grain,
        audit_column=audit_column,
        reads=(f"raw.{raw}",),
        build=build,
        keeps_layout=keeps_layout,
        # Sheets are kept by the day they were landed, not by their own dates.
        whole_reads=() if keeps_layout else (f"raw.{raw}",),
    )


def _mart(
    table: str,
    kind: str,
    time_column: str,
    grain: tuple[str, ...],
    audit_column: str,
    reads: tuple[str, ...],
    whole_reads: tuple[str, ...] = (),
) -> Model:
    assemble = getattr(marts, table)

    def build(inputs: Inputs, start: date, end: date) -> DataFrame:
        return assemble(*[inputs[name] for name in reads], start, end)

    return Model(
        f"marts.{table}",
        kind,
        time_column,
        grain,
        audit_column,
        reads,
        build,
        whole_reads=whole_reads,
    )


MODELS: tuple[Model, ...] = (
    _staging(
        "stripe_charges",
        "stripe_charges",
        "charge_date",
        ("charge_date", "charge_id"),
        "charge_id",
        keeps_layout=True,
    ),
    _staging(
        "paypal_transactions",
        "paypal_transactions",
        "transaction_date",
        ("transaction_date", "transaction_id"),
        "transaction_id",
        keeps_layout=True,
    ),
    _staging(
        "google_ads_performance",
        "google_ads",
        "date",
        ("date", "customer_id"),
        "date",
        keeps_layout=True,
    ),
    _staging(
        "facebook_ads_performance",
        "facebook_ads",
        "date",
        ("date", "campaign_id"),
        "date",
        keeps_layout=True,
    ),
    _staging(
        "analytics_sessions",
        "google_analytics",
        "date",
        ("date", "session_source", "session_medium", "country"),
        "date",
        keeps_layout=True,
    ),
    _staging(
        "sheet_inventory",
        "google_sheets_inventory",
        "snapshot_date",
        ("sku_id", "snapshot_date"),
        "sku_id",
    ),
    _staging(
        "sheet_programs", "google_sheets_programs", None, ("program_id",), "program_id"
    ),
    _staging(
        "sheet_students",
        "google_sheets_students",
        "enrolled_at",
        ("student_id",),
        "student_id",
    ),
    _mart(
        "revenue_by_program",
        BY_MONTH,
        "month",
        ("month", "program_id", "payment_source"),
        "month",
        (
            "staging.stripe_charges",
            "staging.paypal_transactions",
            "staging.sheet_programs",
        ),
        whole_reads=("staging.sheet_programs",),
    ),
    _mart(
        "ad_attribution",
        BY_DAY,
        "date",
        ("date",),
        "date",
        (
            "staging.sheet_students",
            "staging.google_ads_performance",
            "staging.analytics_sessions",
        ),
    ),
    _mart(
        "stock_levels",
        BY_DAY,
        "snapshot_date",
        ("sku_id", "snapshot_date"),
        "sku_id",
        ("staging.sheet_inventory", "staging.sheet_students"),
        # Active students are counted whenever they enrolled.
        whole_reads=("staging.sheet_students",),
    ),
)


def model(name: str) -> Model:
    return next(m for m in MODELS if m.name == name)
