"""Measures of several event sources in one aggregation.

Every source is brought to one long layout: the group keys and one column per measure,
NULL where the source says nothing about it. One group-by over the union then gives
every measure at once, and its groups are the distinct keys of all sources: no separate
key list, no joins of aggregates, one scan per source and one shuffle, of partial
aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_layout(
    df: DataFrame, keys: Mapping[str, Column], measures: Mapping[str, str], **values: Column
) -> DataFrame:
    """Keys and all measures (name to type) of one source; measures without a value are NULL."""
    return df.select(
        *[c.alias(k) for k, c in keys.items()],
        *[values.get(m, F.lit(None)).cast(t).alias(m) for m, t in measures.items()],
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def mean_of(value_sum: Column, value_count: Column) -> Column:
    """Mean of integers from their sum and number, rounded half up to 2 decimals, exactly; NULL without values."""
    mean = value_sum.cast("decimal(20,0)") / F.nullif(value_count, F.lit(0)).cast("decimal(20,0)")
    return F.round(mean, 2).cast("decimal(5,2)")


def average(value_sum: str, value_count: str) -> Column:
    """The mean of a group, from columns of partial sums and numbers."""
    return mean_of(F.sum(value_sum), F.sum(value_count))
