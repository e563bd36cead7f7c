"""Upserts as anti join plus union: both sides read the target as it was."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import with_surrogate_key
from strata.sources.extract import event_date_column, in_window


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `target` whose key is not in `batch`, and all of `batch`.

    `batch` holds one row per key and no NULL key. It is read twice: persist it when it
    is costly to compute.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def replace_window(
    target: DataFrame, extract: DataFrame, start: str | datetime, end: str | datetime
) -> DataFrame:
    """The target with its rows of the closed date range replaced by the extract.

    Rows without a date stay. A table without a date column is replaced whole.
    """
    column = event_date_column(target)
    if column is None:
        return extract.select(*target.columns)
    kept = target.filter(~F.coalesce(in_window(column, start, end), F.lit(False)))
    return kept.unionByName(extract.select(*target.columns))


def upsert_type1(dim: DataFrame, batch: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Replace dimension rows by natural key, keeping the surrogate key of a known row."""
    return upsert(dim, numbered_type1(dim, batch, natural_key, surrogate_key), [natural_key])


def numbered_type1(dim: DataFrame, batch: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """The rows of a batch with the surrogate keys of known rows.

    New rows get keys after the highest one in use, so rows that point here stay valid.
    """
    known = dim.select(natural_key, surrogate_key)
    updated = batch.join(known, natural_key)
    new = with_surrogate_key(
        batch.join(known, natural_key, "left_anti"),
        surrogate_key,
        [natural_key],
        start=dim.agg(F.max(surrogate_key)),
    )
    return updated.unionByName(new)
