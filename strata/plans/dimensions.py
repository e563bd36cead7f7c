"""The five maintained dimensions, from silver tables.

Joins carry no broadcast hints: lookups are broadcast by their size on disk, and a
lookup that outgrows the threshold falls back to a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.clean import latest_per_key
from strata.operators.keys import with_surrogate_key
from strata.operators.scd2 import initial_versions, merge_versions
from strata.operators.upsert import upsert_type1
from strata.sources.extract import changed_since, is_changed
from strata.sources.staging import stage_rows
from strata.specs import DIMENSIONS

Silver = Mapping[str, DataFrame]

# The silver table whose changes drive each dimension.
DRIVING_TABLE = {
    "dim_customer": "customer",
    "dim_content": "content",
    "dim_subscription_plan": "subscription_plan",
    "dim_inventory": "inventory_item",
    "dim_warehouse": "warehouse",
}


def latest_address(addresses: DataFrame) -> DataFrame:
    """Newest address per customer; the highest id among equally new ones."""
    return latest_per_key(
        addresses.select("customer_id", "city_id", "address_id", "updated_at"),
        ["customer_id"],
        [F.col("updated_at").desc_nulls_last(), F.col("address_id").desc()],
    ).select("customer_id", "city_id")


def _customers(rows: DataFrame, silver: Silver, few: bool = False) -> DataFrame:
    """Customers with the place of their newest address. Of `few` customers, only the
    addresses are ranked that are theirs."""
    cities = silver["city"].select("city_id", "country_id", F.col("city_name").alias("city"))
    countries = silver["country"].select("country_id", F.col("country_name").alias("country"))
    addresses = silver["customer_address"]
    if few:
        addresses = addresses.join(rows.select("customer_id"), "customer_id", "left_semi")
    return (
        rows.join(latest_address(addresses), "customer_id", "left")
        .join(cities, "city_id", "left")
        .join(countries, "country_id", "left")
    )


def _inventory(rows: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Items with the keys of their current content version and of their warehouse."""
    contents = dims["dim_content"].filter("is_current").select("content_id", "content_key")
    warehouses = dims["dim_warehouse"].select("warehouse_id", "warehouse_key")
    return rows.join(contents, "content_id", "left").join(warehouses, "warehouse_id", "left")


def _warehouses(rows: DataFrame, silver: Silver) -> DataFrame:
    cities = silver["city"].select("city_id", F.col("city_name").alias("city"))
    return rows.join(cities, "city_id", "left")


def _source(
    name: str, rows: DataFrame, silver: Silver, dims: Mapping[str, DataFrame], few: bool = False
) -> DataFrame:
    if name == "dim_customer":
        return _customers(rows, silver, few)
    if name == "dim_inventory":
        return _inventory(rows, dims)
    if name == "dim_warehouse":
        return _warehouses(rows, silver)
    return rows


def dimension_full(
    name: str, silver: Silver, dims: Mapping[str, DataFrame], run_ts: str | datetime
) -> DataFrame:
    """A dimension from scratch. `dim_inventory` reads `dim_content` and `dim_warehouse` from `dims`."""
    spec = DIMENSIONS[name]
    # Numbered before the joins, which keep one row per key: the count then needs none of them.
    rows = with_surrogate_key(silver[DRIVING_TABLE[name]], spec.surrogate_key, [spec.natural_key])
    source = _source(name, rows, silver, dims)
    if spec.tracked:
        return initial_versions(source, spec, run_ts)
    return source.select(spec.surrogate_key, spec.natural_key, *spec.attributes)


def dimension_batch(
    name: str,
    silver: Silver,
    dims: Mapping[str, DataFrame],
    watermark: str | datetime | Column,
    include_child_changes: bool = False,
) -> DataFrame:
    """Source rows of a dimension changed since the watermark.

    A new address alone does not make a customer row count as changed, unless
    `include_child_changes` is set; the change then has the time of the newer of the two.
    """
    rows = silver[DRIVING_TABLE[name]]
    if include_child_changes and name == "dim_customer":
        moves = (
            changed_since(silver["customer_address"], watermark)
            .groupBy("customer_id")
            .agg(F.max(F.greatest("created_at", "updated_at")).alias("_moved_at"))
        )
        changed = (
            rows.join(moves, "customer_id", "left")
            .filter(is_changed(watermark) | F.col("_moved_at").isNotNull())
            .withColumn("updated_at", F.greatest("updated_at", "_moved_at"))
            .drop("_moved_at")
        )
    else:
        changed = changed_since(rows, watermark)
    return _source(name, changed, silver, dims, few=True)


def dimension_incremental(
    name: str,
    dim: DataFrame,
    silver: Silver,
    dims: Mapping[str, DataFrame],
    watermark: str | datetime | Column,
    run_ts: str | datetime,
    include_child_changes: bool = False,
) -> DataFrame:
    spec = DIMENSIONS[name]
    # Written first: what closes, the number of what opens and what opens are all read from it.
    batch = stage_rows(dimension_batch(name, silver, dims, watermark, include_child_changes))
    if spec.tracked:
        return merge_versions(dim, batch, spec, run_ts)
    batch = batch.select(spec.natural_key, *spec.attributes)
    return upsert_type1(dim, batch, spec.natural_key, spec.surrogate_key)
