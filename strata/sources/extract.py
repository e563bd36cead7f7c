"""Bronze extracts: snapshots, high-water-mark deltas and backfill windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.specs import EPOCH, EVENT_DATE_COLUMNS, TABLES


def timestamp(value: str | datetime | Column) -> Column:
    """A time without zone, from text, a datetime or a column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def read_seed(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A lookup table from its CSV file; the schema is given, so nothing is inferred."""
    return (
        spark.read.schema(TABLES[table].source_schema)
        .option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("mode", "FAILFAST")
        .csv(f"{directory}/{table}.csv")
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table of the operational database, read by `partitions` tasks over ranges of its first key.

    Filters such as `changed_since` are pushed into the database's WHERE clause.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=TABLES[table].keys[0],
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            fetchsize=str(fetch_size),
            preferTimestampNTZ="true",
            **options,
        )
        .load()
    )


def with_lineage(source: DataFrame, run_ts: str | datetime, source_system: str) -> DataFrame:
    """The source rows as they are, stamped with load time and origin."""
    return source.withColumns(
        {"load_timestamp": timestamp(run_ts), "source_system": F.lit(source_system)}
    )


def is_changed(watermark: str | datetime | Column) -> Column:
    wm = timestamp(watermark)
    return (F.col("created_at") > wm) | (F.col("updated_at") > wm)


def changed_since(df: DataFrame, watermark: str | datetime | Column) -> DataFrame:
    """Rows created or updated strictly after the watermark."""
    return df.filter(is_changed(watermark))


def undated() -> Column:
    """A row that no watermark can find, having neither time."""
    return F.col("created_at").isNull() & F.col("updated_at").isNull()


def row_hash(columns: Sequence[str]) -> Column:
    """A hash of a whole row in which a null differs from any value and no column from another."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def last_snapshot(landed: DataFrame, keys: Sequence[str], columns: Sequence[str], load: str) -> DataFrame:
    """Hashes of the rows a source held when it was last landed: of each key those of its
    last load. `landed` keeps every load, numbered in the column `load`."""
    hashed = landed.select(*keys, F.col(load).alias("_load"), row_hash(columns).alias("_hash"))
    return hashed.groupBy(*keys).agg(F.max_by(F.col("_hash"), F.col("_load")).alias("_hash")).select("_hash")


def snapshot_difference(rows: DataFrame, landed: DataFrame, keys: Sequence[str], load: str) -> DataFrame:
    """The rows that are new or differ from their last landed version, for sources whose rows
    do not say when they changed.

    A row that goes back to an earlier content counts as changed; a row that the source no
    longer has is not reported. Each key has one row in the source.
    """
    seen = last_snapshot(landed, keys, rows.columns, load)
    hashed = rows.withColumn("_hash", row_hash(rows.columns))
    return hashed.join(seen, "_hash", "left_anti").select(*rows.columns)


def high_water_mark(df: DataFrame) -> DataFrame:
    """One row with the newest creation or update time, or the epoch for an empty table."""
    newest = F.greatest(F.max("created_at"), F.max("updated_at"))
    return df.agg(F.coalesce(newest, timestamp(EPOCH)).alias("last_watermark"))


def event_date_column(df: DataFrame) -> str | None:
    """The column a date-range backfill goes by, or None for a table without dates."""
    return next((c for c in EVENT_DATE_COLUMNS if c in df.columns), None)


def in_window(column: str, start: str | datetime, end: str | datetime) -> Column:
    return F.col(column).between(timestamp(start), timestamp(end))


def window_extract(source: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Rows of a closed date range; the whole table if it has no date column."""
    column = event_date_column(source)
    return source if column is None else source.filter(in_window(column, start, end))
