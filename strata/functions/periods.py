"""Calendar buckets and the integer keys of the calendar dimensions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(x: Column) -> Column:
    return F.to_date(x)


def date_key(x: Column) -> Column:
    """yyyyMMdd as an integer, by arithmetic instead of formatting."""
    return F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)


def month_key(x: Column) -> Column:
    """yyyyMM as an integer."""
    return F.year(x) * 100 + F.month(x)


def month_start(key: Column) -> Column:
    """First day of the month of a yyyyMM key."""
    return F.make_date((key / 100).cast("int"), (key % 100).cast("int"), F.lit(1))
