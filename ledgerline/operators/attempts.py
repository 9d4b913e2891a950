"""Runs kept in the lake: every attempt stays, and only finished ones are read.

Rows lie under ``partition_date=D/run_id=R/attempt=A/kind=K``.  Nothing is ever replaced
there.  When all rows of an attempt are written and judged, one small file under
``_committed/run_id=R`` says so, with the days that the attempt stands for.  A reader
takes, for each day (and each scope, where several accounts share a source), the last
attempt that says so; what a failed attempt has left is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import SparkSession

from ledgerline.operators import files

RECORD, REJECT, PAGE_ONLY = "record", "reject", "page"


@dataclass(frozen=True)
class Attempt:
    """One finished attempt: the days that it stands for, and those it has rows of."""

    number: int
    name: str
    scope: str
    stands_for: tuple[str, ...]
    has_rows: tuple[str, ...] = field(default=())


def new_name() -> str:
    return uuid.uuid4().hex


def folder(lake: str, day: date | str, run_id: str, attempt: str) -> str:
    return f"{lake}/partition_date={day}/run_id={run_id}/attempt={attempt}"


def folders(
    spark: SparkSession, lake: str, run_id: str, attempt: str, days: Iterable[date]
) -> dict[date, str]:
    """The folders that an attempt has for some days."""
    named = {day: folder(lake, day, run_id, attempt) for day in days}
    return {day: path for day, path in named.items() if files.exists(spark, path)}


def committed(spark: SparkSession, lake: str, run_id: str) -> list[Attempt]:
    """Finished attempts of a run, the first one first."""
    home = f"{lake}/_committed/run_id={run_id}"
    names = [name for name in files.names(spark, home) if name.endswith(".json")]
    read = [json.loads(files.read_text(spark, f"{home}/{name}")) for name in sorted(names)]
    return [
        Attempt(r["number"], r["name"], r["scope"], tuple(r["stands_for"]), tuple(r["has_rows"]))
        for r in read
    ]


def commit(
    spark: SparkSession,
    lake: str,
    run_id: str,
    name: str,
    scope: str,
    stands_for: Iterable[date],
    has_rows: Iterable[date],
) -> Attempt:
    """Let readers see an attempt.  The file appears at once or not at all; should another
    attempt take the number first, the next one is tried."""
    while True:
        earlier = committed(spark, lake, run_id)
        number = 1 + max((a.number for a in earlier), default=0)
        days = tuple(sorted(str(d) for d in stands_for)), tuple(sorted(str(d) for d in has_rows))
        made = Attempt(number, name, scope, *days)
        path = f"{lake}/_committed/run_id={run_id}/{number:08d}.json"
        if files.create_text(spark, path, json.dumps(asdict(made))):
            return made


def standing(
    spark: SparkSession,
    lake: str,
    run_id: str,
    start: date | None = None,
    end: date | None = None,
) -> list[str]:
    """Folders of the attempts that count, of the days ``start`` to ``end`` if given."""
    last: dict[tuple[str, str], tuple[str, bool]] = {}
    for attempt in committed(spark, lake, run_id):
        for day in attempt.stands_for:
            last[attempt.scope, day] = attempt.name, day in attempt.has_rows
    return [
        folder(lake, day, run_id, name)
        for (_, day), (name, filled) in sorted(last.items())
        if filled
        and (start is None or day >= str(start))
        and (end is None or day <= str(end))
    ]
