"""Build models in order: staging first, then marts, each audited when written."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import whole_months
from ledgerline.operators import files, snapshots, states
from ledgerline.operators.partitions import (
    count_on_write,
    list_days,
    write_days,
    written,
)
from ledgerline.operators.quality import AuditError
from ledgerline.plans.models import BY_MONTH, FULL, MODELS, Model
from ledgerline.plans.models import model as model_named
from ledgerline.plans.warehouse import Warehouse


# Day columns of the raw tables that staging reads by range.
RAW_DAYS = {
    "raw.stripe_charges": "charge_date",
    "raw.paypal_transactions": "transaction_date",
    "raw.google_ads": "date",
    "raw.facebook_ads": "date",
    "raw.google_analytics": "date",
}


def kept_by(name: str) -> str:
    """The column a table's folders are named by."""
    return RAW_DAYS.get(name) or model_named(name).time_column


def run_model(
    warehouse: Warehouse, model: Model, start: date, end: date, sweep: bool = True
) -> int:
    """Build one model for a day range; rows written.

    A by-month model is widened to whole months, since its days only make sense
    together.  Days of the range that have no rows any more are removed.  Rows are
    written as a build beside those of the table, counted by the null-key audit on the
    way, and become the table's in one step, only if they pass it.  Counts of its days
    are kept with the build, for the grain report and for telling which days changed.
    """
    if model.kind == BY_MONTH:
        start, end = whole_months(start, end)
    inputs = {
        name: warehouse.read_whole(name, start, end)
        if name in model.whole_reads
        else warehouse.read_range(name, kept_by(name), start, end)
        for name in model.reads
    }
    frame = model.build(inputs, start, end)
    path, spark = warehouse.path(model.name), warehouse.spark
    before = snapshots.current(spark, path)
    build, made = snapshots.new_build(path)
    if model.kind == FULL:
        counted, observation = count_on_write(frame, model.audit_column)
        counted.write.parquet(made)
        counts = written(observation, made)
    else:
        counts = write_days(
            frame,
            made,
            [model.time_column],
            rebalance=not model.keeps_layout,
            key_column=model.audit_column,
        )
    if counts.null_keys:
        files.delete(spark, made)
        raise AuditError(
            f"{model.name}: {counts.null_keys} rows with null {model.audit_column}"
        )
    if model.kind == FULL:
        builds = {snapshots.WHOLE: build}
    else:
        days = list_days(spark, made, model.time_column)
        builds = snapshots.with_range(before, build, days, start, end)
    rows = spark.read.schema(frame.schema).parquet(made)
    states.keep(rows, path, build, model.time_column, model.grain)
    snapshots.publish(spark, path, before, builds, frame.schema, model.time_column)
    if sweep:
        snapshots.sweep(spark, path)
    return counts.rows


def grain_report(warehouse: Warehouse) -> DataFrame:
    """One row per model of how its grain keys repeat, from the counts kept with its builds."""
    spark, found = warehouse.spark, []
    for m in MODELS:
        path = warehouse.path(m.name)
        counts = states.grain_of(spark, path, snapshots.current(spark, path))
        named = F.lit(m.name).alias("model"), F.lit(", ".join(m.grain)).alias("grain")
        found.append(counts.select(*named, "*"))
    return reduce(DataFrame.unionByName, found)


def run_all_models(warehouse: Warehouse, start: date, end: date) -> dict[str, int]:
    """Every model in registry order, which puts staging before marts."""
    return {m.name: run_model(warehouse, m, start, end) for m in MODELS}
