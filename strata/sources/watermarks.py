"""The control table: the newest change and the last load that each table has seen."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.upsert import upsert
from strata.sources.extract import high_water_mark, timestamp
from strata.sources.tables import Lake
from strata.specs import EPOCH

CONTROL = "gold.watermark_tracker"
NEVER = datetime.fromisoformat(EPOCH)
_SCHEMA = "table_name string, last_watermark timestamp_ntz, last_load bigint"


@dataclass(frozen=True, order=True)
class Mark:
    """How far a table has come: the newest change it has seen, and the number of the last
    bronze load it has taken in. Loads of a table are numbered from 0."""

    at: datetime = NEVER
    load: int = -1


def control_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return lake.read(CONTROL) if lake.exists(CONTROL) else spark.createDataFrame([], _SCHEMA)


def stored_marks(lake: Lake) -> dict[str, Mark]:
    """All stored marks: a few per table of the warehouse."""
    rows = control_table(lake.spark, lake).collect()
    return {r["table_name"]: Mark(r["last_watermark"], r["last_load"]) for r in rows}


def newest_update(table: DataFrame) -> datetime:
    """Where to start without a stored watermark: the newest `updated_at`, if there is one."""
    newest = table.agg(F.max("updated_at")).first()[0] if "updated_at" in table.columns else None
    return newest or NEVER


def newest_change(df: DataFrame) -> datetime:
    return high_water_mark(df).first()["last_watermark"]


def advanced(control: DataFrame, marks: dict[str, Mark]) -> DataFrame:
    """The control table with the given marks inserted or overwritten."""
    rows = [(name, str(mark.at), mark.load) for name, mark in marks.items()]
    batch = control.sparkSession.createDataFrame(rows, "table_name string, at string, last_load bigint")
    at = timestamp(F.col("at")).cast("timestamp_ntz").alias("last_watermark")
    return upsert(control, batch.select("table_name", at, "last_load"), ["table_name"])
