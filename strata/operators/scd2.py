"""Type 2 dimensions: first load, merge of a batch, and what a batch closes and opens."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import with_surrogate_key
from strata.sources.extract import timestamp
from strata.specs import FIRST_DAY, OPEN_END, DimensionSpec


def dimension_columns(spec: DimensionSpec) -> list[str]:
    validity = ["effective_from", "effective_to", "created_at", "updated_at", "is_current"]
    return [spec.surrogate_key, spec.natural_key, *spec.attributes, *validity]


def _open_version(df: DataFrame, effective_from: Column, run_ts: str | datetime) -> DataFrame:
    return df.withColumns(
        {
            "effective_from": effective_from,
            "effective_to": F.lit(OPEN_END).cast("date"),
            "created_at": timestamp(run_ts),
            "updated_at": timestamp(run_ts),
            "is_current": F.lit(True),
        }
    )


def initial_versions(source: DataFrame, spec: DimensionSpec, run_ts: str | datetime) -> DataFrame:
    """One current version per natural key; `source` already has the surrogate key.

    It starts at the business date, else at the creation date, else at the first calendar day.
    """
    starts = [F.to_date("created_at"), F.lit(FIRST_DAY).cast("date")]
    if spec.business_date:
        starts.insert(0, F.to_date(spec.business_date))
    return _open_version(source, F.coalesce(*starts), run_ts).select(*dimension_columns(spec))


def merge_versions(
    dim: DataFrame, batch: DataFrame, spec: DimensionSpec, run_ts: str | datetime
) -> DataFrame:
    """The dimension after a batch of source rows, at most one per natural key.

    A current row that differs from its batch row in a tracked column (NULLs compare as
    values) is closed the day before the change. New keys and changed keys get a new
    current version from the day of the change, with surrogate keys after those in use.
    The day of the change is that of `updated_at`, or of `created_at` if never updated.
    A second change on one day leaves the first version inverted: it matches no day.
    Both steps compare with the dimension as it was before the batch.
    """
    key = spec.natural_key
    changed_on = F.to_date(F.coalesce("updated_at", "created_at"))
    new = batch.select(
        F.col(key).alias("_key"),
        changed_on.alias("_changed_on"),
        *[F.col(c).alias(f"_{c}") for c in spec.tracked],
    )
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in spec.tracked]
    )
    closes = F.col("_key").isNotNull() & differs
    # Closed versions pass untouched; only current rows, one per key, meet the batch.
    current = dim.filter("is_current")
    kept = (
        current.join(new, F.col(key) == F.col("_key"), "left")
        .withColumn("_closes", closes)
        .withColumns(
            {
                "effective_to": F.when(F.col("_closes"), F.date_sub("_changed_on", 1)).otherwise(
                    F.col("effective_to")
                ),
                "updated_at": F.when(F.col("_closes"), timestamp(run_ts)).otherwise(F.col("updated_at")),
                "is_current": ~F.col("_closes"),
            }
        )
        .select(*dimension_columns(spec))
        .unionByName(dim.filter("not is_current").select(*dimension_columns(spec)))
    )

    opened = opened_versions(current, batch, spec, run_ts, start=dim.agg(F.max(spec.surrogate_key)))
    return kept.unionByName(opened)


def opened_versions(
    current: DataFrame, batch: DataFrame, spec: DimensionSpec, run_ts: str | datetime, start: DataFrame
) -> DataFrame:
    """The versions that a batch opens, with surrogate keys after `start`."""
    key = spec.natural_key
    known = current.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in spec.tracked]
    )
    unchanged = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in spec.tracked],
        F.col(key) == F.col("_key"),
    )
    changed_on = F.to_date(F.coalesce("updated_at", "created_at"))
    opened = _open_version(batch.join(known, unchanged, "left_anti"), changed_on, run_ts)
    numbered = with_surrogate_key(opened, spec.surrogate_key, [key], start=start)
    return numbered.select(*dimension_columns(spec))


def closed_versions(current: DataFrame, opened: DataFrame, spec: DimensionSpec, run_ts: str | datetime) -> DataFrame:
    """The current versions that newly opened ones take the place of, closed the day before."""
    starts = opened.select(spec.natural_key, F.col("effective_from").alias("_starts"))
    ended = {
        "effective_to": F.date_sub("_starts", 1),
        "updated_at": timestamp(run_ts),
        "is_current": F.lit(False),
    }
    return current.join(starts, spec.natural_key).withColumns(ended).select(*dimension_columns(spec))
