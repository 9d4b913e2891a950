"""Tables that change in one step: builds side by side, and a list of those that count.

A build lies in a folder of its own, ``build=<name>``, with the day folders that it made.
A snapshot is one small file ``_manifest/<number>.json`` that names the build of every
day; the highest number is the table.  Publishing creates the next one, so a reader sees
all days of a rebuild or none, and a job that dies before that has changed nothing.
Builds that neither of the last two snapshots names are removed after publishing: a
reader that has begun on the snapshot before still finds its files.

A table has one writer at a time; another one that publishes first makes it fail.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerline.operators import files

WHOLE = "whole"  # the only "day" of a table that is not kept by days
KEPT = 2


class Overtaken(RuntimeError):
    """Another job has published the table meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """Which build holds each day, and the columns of the table."""

    number: int = 0
    column: str | None = None
    schema: str | None = None
    builds: dict[str, str] = field(default_factory=dict)

    def days(self) -> list[date]:
        return sorted(date.fromisoformat(day) for day in self.builds if day != WHOLE)


def new_build(path: str) -> tuple[str, str]:
    """A name for a build and the folder to write it to."""
    name = uuid.uuid4().hex
    return name, f"{path}/build={name}"


def current(spark: SparkSession, path: str) -> Snapshot:
    """The last snapshot; one without builds where nothing has been published."""
    numbers = _numbers(spark, path)
    if not numbers:
        return Snapshot()
    return _read(spark, path, numbers[-1])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = files.names(spark, f"{path}/_manifest")
    return sorted(int(name[:-5]) for name in names if name.endswith(".json"))


def _file(path: str, number: int) -> str:
    return f"{path}/_manifest/{number:08d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Snapshot:
    return Snapshot(**json.loads(files.read_text(spark, _file(path, number))))


def publish(
    spark: SparkSession, path: str, before: Snapshot, builds: dict[str, str], schema: StructType, column: str | None
) -> Snapshot:
    """Make ``builds`` the table; ``before`` is the snapshot it was made from."""
    made = Snapshot(before.number + 1, column, schema.json(), builds)
    if not files.create_text(spark, _file(path, made.number), json.dumps(asdict(made))):
        raise Overtaken(f"{path} has been published by another job")
    return made


def with_range(before: Snapshot, build: str, days: list[date], start: date, end: date) -> dict[str, str]:
    """Builds after the days ``start`` to ``end`` have become just ``days`` of ``build``."""
    kept = {d: b for d, b in before.builds.items() if not str(start) <= d <= str(end)}
    return kept | {str(day): build for day in days}


def sweep(spark: SparkSession, path: str) -> list[str]:
    """Remove what the last snapshots don't name; the builds that went."""
    numbers = _numbers(spark, path)
    named = {build for n in numbers[-KEPT:] for build in _read(spark, path, n).builds.values()}
    for number in numbers[:-KEPT]:
        files.delete(spark, _file(path, number))
    gone = []
    for home in (path, f"{path}/_states", f"{path}/_keys"):
        for name in files.names(spark, home):
            if name.startswith("build=") and name[6:] not in named:
                files.delete(spark, f"{home}/{name}")
                gone.append(name[6:])
    return sorted(set(gone))


def read(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """The table, or its days ``start`` to ``end``; no other folder is listed.

    Without ``schema`` the columns are those it was published with.
    """
    snapshot = current(spark, path)
    if schema is None:
        if snapshot.schema is None:
            raise FileNotFoundError(f"{path} has not been published")
        schema = StructType.fromJson(json.loads(snapshot.schema))
    folders = [
        f"{path}/build={build}" + ("" if day == WHOLE else f"/{snapshot.column}={day}")
        for day, build in sorted(snapshot.builds.items())
        if day == WHOLE
        or (start is None or day >= str(start)) and (end is None or day <= str(end))
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return rows.select(*schema.fieldNames())
