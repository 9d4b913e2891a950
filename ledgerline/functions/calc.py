"""Arithmetic and calendar helpers shared by parsers, staging and marts."""

from __future__ import annotations

import calendar
from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import MONEY, WIDE_MONEY

SECONDS_PER_DAY = 86_400


def cents_to_dollars(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def micros_to_dollars(micros: Column) -> Column:
    """Millionths of a dollar, rounded to cents in decimal (ties away from zero)."""
    exact = micros.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    return F.round(exact, 2).cast("decimal(20,2)")


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Null where the denominator is zero or null."""
    return F.try_divide(numerator, denominator)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def epoch_to_date(seconds: Column) -> Column:
    """UTC day of Unix seconds, whatever the session zone is."""
    days = F.floor(seconds / F.lit(SECONDS_PER_DAY))
    return F.date_from_unix_date(days.try_cast("int"))


def epoch_bounds(start: date | Column, end: date | Column) -> tuple[Column, Column]:
    """First and last second of the UTC days ``start`` to ``end``."""
    second = lambda day: F.unix_date(F.lit(day)).cast("bigint") * SECONDS_PER_DAY
    return second(start), second(end) + (SECONDS_PER_DAY - 1)


def times_count(amount: Column, count: Column) -> Column:
    """An amount of money times a 64-bit count, exact to nine decimals.

    The plain product would have 27 + 19 digits and lose decimals, so whole and
    fractional parts are multiplied by themselves.
    """
    number = count.cast("decimal(19,0)")
    whole = F.floor(amount).cast("decimal(18,0)")
    part = (amount - whole).cast("decimal(10,9)")
    return ((whole * number).cast("decimal(37,9)") + part * number).cast(WIDE_MONEY)


def in_range(day: Column, start: date | Column, end: date | Column) -> Column:
    return day.between(F.lit(start), F.lit(end))


def whole_months(start: date, end: date) -> tuple[date, date]:
    """Widen a day range to the first and last day of its months."""
    last_day = calendar.monthrange(end.year, end.month)[1]
    return start.replace(day=1), end.replace(day=last_day)


def new_york_day(utc_clock: Column) -> Column:
    """Run-day label of a UTC wall-clock time; record dates stay in UTC."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), utc_clock)
    return local.cast("date")
