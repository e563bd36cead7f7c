"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_bucket(columns: Sequence[str], hex_digits: int) -> Column:
    """An even spread of distinct keys over 16 ** hex_digits buckets."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, hex_digits), 16, 10).cast("int")


def with_surrogate_key(
    df: DataFrame,
    name: str,
    unique: Sequence[str],
    start: DataFrame | None = None,
    hex_digits: int = 3,
) -> DataFrame:
    """Number the rows start+1, start+2, ... by (bucket, unique columns).

    `unique` must identify a row. Rows are numbered inside hash buckets and shifted by
    the count of the buckets before, so no task sees more than one bucket. The number
    depends on the data alone: a recomputed partition gives the same keys. The table of
    offsets has at most 16 ** hex_digits rows, which bounds what is broadcast.
    `start` is a one-row DataFrame with the highest key in use (NULL counts as 0).
    """
    first = F.lit(0).cast("bigint") if start is None else F.coalesce(start.scalar(), F.lit(0)).cast("bigint")
    bucketed = df.withColumn("_bucket", key_bucket(unique, hex_digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy(*unique)
    return (
        bucketed.withColumn("_row", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, first + F.col("_offset") + F.col("_row"))
        .select(name, *df.columns)
    )
