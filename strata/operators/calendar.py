"""Calendar dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import date_key, month_key
from strata.specs import FIRST_DAY, LAST_DAY


def _series(spark: SparkSession, first, last, step: str) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return bounds.select(F.explode(F.sequence("first", "last", F.expr(f"interval 1 {step}"))).alias("d"))


def _month_columns(d: Column) -> list[Column]:
    return [
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
    ]


def date_dimension(
    spark: SparkSession, first: str | date = FIRST_DAY, last: str | date = LAST_DAY
) -> DataFrame:
    """One row per day. Weeks are ISO weeks, the year is the calendar year."""
    d = F.col("d")
    return _series(spark, first, last, "day").select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_number"),
        *_month_columns(d),
    )


def month_dimension(
    spark: SparkSession, first: str | date = FIRST_DAY, last: str | date = LAST_DAY
) -> DataFrame:
    """One row per month."""
    d = F.col("d")
    return _series(spark, first, last, "month").select(month_key(d).alias("month_key"), *_month_columns(d))
