"""Strict text casts.  Each returns null for text it refuses.

They do not depend on the ANSI setting: the caller tells "absent" from
"refused" by looking at the input as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.schemas import MONEY

# Java reads "1.5d" and "0x1p3" as doubles; the vendors' number format does not.
JAVA_ONLY_DOUBLE = r"[xXpP]|[0-9.][dDfF]\s*$"


def whole_number(text: Column) -> Column:
    """``"15"`` to 15; ``"2.0"`` and ``"x"`` are refused."""
    return text.try_cast("bigint")


def real_number(text: Column) -> Column:
    """``"1.11"``, ``"1e3"`` or ``"inf"`` to a double."""
    return F.when(~text.rlike(JAVA_ONLY_DOUBLE), text.try_cast("double"))


def money(text: Column) -> Column:
    """Amount text to nine decimals, rounded half away from zero."""
    return text.try_cast(MONEY)


def truncated_number(text: Column) -> Column:
    """``"4.7"`` to 4, ``"-4.7"`` to -4."""
    return real_number(text).try_cast("bigint")


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` and nothing else: no times, no one-digit months."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d\z"), text.try_cast("date"))


def compact_date(text: Column) -> Column:
    """``yyyyMMdd``; the day may have one digit."""
    dashed = F.concat_ws(
        "-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)
    )
    return F.when(text.rlike(r"^\d{7,8}\z"), dashed.try_cast("date"))


def first_filled(*texts: Column) -> Column:
    """First text that is neither null nor empty, else ``""``."""
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in texts], F.lit(""))


def refused(text: Column, value: Column) -> Column:
    """Required field: absent, or present but not readable."""
    return text.isNull() | value.isNull()
