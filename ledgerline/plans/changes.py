"""Which days of which models have to be built again after some days of raw tables changed.

Changes run along the edges of the model graph.  An input read by days passes on its own
days, one that feeds months passes on their months, and one that is read whole makes all
days of the model due.  A built model passes on only those days whose content differs from
what it was before, told by the states kept beside its builds: a sheet landed again without
a change ends there.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ledgerline.functions.calc import whole_months
from ledgerline.operators import snapshots, states
from ledgerline.plans.models import BY_MONTH, FULL, MODELS, Model
from ledgerline.plans.runner import run_model
from ledgerline.plans.warehouse import Warehouse

Days = set[date]


def loaded_since(warehouse: Warehouse, since: datetime) -> dict[str, Days]:
    """Raw tables and the days that runs logged after ``since`` have loaded.

    At most one row per source and day.
    """
    # Times of the log are UTC, whatever zone the driver is in.
    late = F.unix_micros("logged_at") > F.lit(int(since.timestamp() * 1_000_000))
    loads = warehouse.run_log().where(late & (F.col("status") == "loaded"))
    found: dict[str, Days] = {}
    for row in loads.select("source", "partition_date").distinct().collect():
        found.setdefault(f"raw.{row['source']}", set()).add(row["partition_date"])
    return found


def due_ranges(
    model: Model, changed: Mapping[str, Days], first: date, last: date
) -> list[tuple[date, date]]:
    """Day ranges of a model that its changed inputs make due, within the whole range
    ``first`` to ``last`` of the warehouse."""
    inputs = [name for name in model.reads if changed.get(name)]
    if not inputs:
        return []
    if model.kind == FULL or any(name in model.whole_reads for name in inputs):
        return [(first, last)]
    days = set().union(*(changed[name] for name in inputs))
    return runs_of_days(
        day
        for changed_day in days
        for day in (_month(changed_day) if model.kind == BY_MONTH else [changed_day])
    )


def _month(day: date) -> list[date]:
    start, end = whole_months(day, day)
    return [start + timedelta(n) for n in range((end - start).days + 1)]


def runs_of_days(days: Iterable[date]) -> list[tuple[date, date]]:
    """Stretches of consecutive days."""
    ranges: list[tuple[date, date]] = []
    for day in sorted(set(days)):
        if ranges and ranges[-1][1] + timedelta(1) == day:
            ranges[-1] = ranges[-1][0], day
        else:
            ranges.append((day, day))
    return ranges


def rebuild_changed(
    warehouse: Warehouse, changed: Mapping[str, Days], first: date, last: date
) -> dict[str, list[tuple[date, date]]]:
    """Build again what the changed days of raw tables make due; the ranges built.

    A model whose new rows are what they were before passes nothing on.
    """
    spark, known = warehouse.spark, dict(changed)
    done: dict[str, list[tuple[date, date]]] = {}
    for model in MODELS:
        ranges = due_ranges(model, known, first, last)
        path = warehouse.path(model.name)
        before = snapshots.current(spark, path)
        for start, end in ranges:
            run_model(warehouse, model, start, end, sweep=False)
        if ranges:
            done[model.name] = ranges
            after = snapshots.current(spark, path)
            # The day of a table that isn't kept by days stands for all of it.
            differ = states.changed_days(spark, path, before, after)
            known[model.name] = {day or first for day in differ}
            snapshots.sweep(spark, path)
    return done
