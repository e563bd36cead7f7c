"""Silver tables, full and incremental."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame

from strata.operators.clean import clean
from strata.operators.upsert import upsert
from strata.sources.extract import changed_since
from strata.sources.staging import stage_rows
from strata.specs import TABLES


def silver_full(table: str, bronze: DataFrame, tie_break: Sequence[str] = (), reread: bool = False) -> DataFrame:
    return clean(bronze, TABLES[table], tie_break, reread)


def silver_batch(
    table: str,
    bronze: DataFrame,
    watermark: str | datetime | Column,
    tie_break: Sequence[str] = (),
    reread: bool = False,
) -> DataFrame:
    """Cleaned rows of the bronze rows changed since the watermark.

    The filter comes before the dedup: Catalyst cannot push it below the window.
    """
    return clean(changed_since(bronze, watermark), TABLES[table], tie_break, reread)


def silver_incremental(
    table: str,
    target: DataFrame,
    bronze: DataFrame,
    watermark: str | datetime | Column,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The target after the batch, which is written first: the upsert reads it twice."""
    batch = stage_rows(silver_batch(table, bronze, watermark, tie_break, reread=True))
    return upsert(target, batch, TABLES[table].keys)
