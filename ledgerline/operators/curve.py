"""An order of rows along a space-filling curve over several columns."""

from __future__ import annotations

from math import isnan

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampType

BITS = 6  # a column's values fall into 64 ranges of about as many rows
ACCURACY = 2000


def sorted_within(
    frame: DataFrame, first: list[str], columns: tuple[str, ...], bounds: list[list[float]]
) -> DataFrame:
    """Rows of each task by the columns ``first``, then by ``columns``: one by its values,
    several along the curve through them, whose ``bounds`` are those of ``range_bounds``.

    The curve takes one bit of each column's range number in turn (Z order), so a file, or
    a row group of it, spans a small part of each column and a filter on any of them skips
    most.  Sorting by one column after another would serve the first one only.

    A sort evaluates what it sorts by at every comparison, so the place on the curve is a
    column of its own, made once for each row in steps and dropped again.
    """
    if len(columns) < 2:
        return frame.sortWithinPartitions(*first, *columns)
    made = [_unused(frame, f"curve_{name}") for name in columns]
    place = _unused(frame, "curve")
    numbers = {m: _number(frame, name) for m, name in zip(made, columns)}
    ranges = {m: _range(F.col(m), b) for m, b in zip(made, bounds)}
    placed = frame.withColumns(numbers).withColumns(ranges)
    placed = placed.withColumn(place, _curve([F.col(m) for m in made]))
    return placed.sortWithinPartitions(*first, place, *columns).drop(place, *made)


def _unused(frame: DataFrame, name: str) -> str:
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _number(frame: DataFrame, name: str) -> Column:
    """A number in the order of the column, as far as eight bytes tell."""
    kind = frame.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, StringType):
        # The first six bytes; more would not be whole in a double.
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, (NumericType, BooleanType)):
        return column.cast("double")
    raise TypeError(f"{name}: rows can't be clustered by {kind.simpleString()}")


def range_bounds(frame: DataFrame, columns: tuple[str, ...]) -> list[list[float]]:
    """What parts the ranges of each of several columns, in order.

    One aggregate gives them: ``2 ** BITS - 1`` numbers a column.
    """
    if len(columns) < 2:
        return [[] for _ in columns]
    parts = F.array([F.lit(n / 2**BITS) for n in range(1, 2**BITS)])
    found = frame.agg(
        *[F.percentile_approx(_number(frame, c), parts, ACCURACY).alias(c) for c in columns]
    ).head()
    # As Spark orders them: not-a-number behind all others.
    order = lambda bound: (isnan(bound), bound)
    return [sorted(set(bounds or []), key=order) for bounds in found]


def _range(number: Column, bounds: list[float]) -> Column:
    """How many bounds lie below a number, found by halving; 0 for null."""

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        above = number > F.lit(bounds[middle])
        return F.when(above, among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(bounds)).cast("bigint")


def _curve(ranges: list[Column]) -> Column:
    """Bits of the range numbers in turn, the highest ones first."""
    z = F.lit(0).cast("bigint")
    for bit in range(BITS - 1, -1, -1):
        for number in ranges:
            z = z * 2 + F.getbit(number, F.lit(bit)).cast("bigint")
    return z
