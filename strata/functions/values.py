"""Value checks that turn an impossible value into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(x: Column) -> Column:
    return F.when(x >= 0, x)


def within(x: Column, low, high) -> Column:
    """`x` if it lies in the closed range, else NULL."""
    return F.when(x.between(low, high), x)
