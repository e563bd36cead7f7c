"""One query per operator, table and fact, over the given tables.

Dates and times come out as text and decimals as doubles, so that both engines' results
compare by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timedelta
from functools import lru_cache, partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalogue.sources import (
    RUN_TS,
    SOURCE_SYSTEM,
    SOURCES,
    TIE_BREAK,
    bronze,
    from_one_table,
    given,
    source,
)
from strata.functions import (
    day,
    lower_text,
    month_key,
    non_negative,
    title_text,
    trimmed_text,
    upper_text,
    within,
)
from strata.operators.calendar import date_dimension, month_dimension
from strata.operators.clean import latest_of_repeated, latest_version, newest_first, valid_span
from strata.operators.keys import with_surrogate_key
from strata.operators.measures import union_all
from strata.operators.timeline import at_day, interval_timeline, version_timeline
from strata.operators.upsert import replace_window, upsert
from strata.plans import jobs
from strata.plans.dimensions import DRIVING_TABLE, dimension_batch, dimension_full, dimension_incremental, latest_address
from strata.plans.facts import FACT_SOURCES, GRAIN, fact_affected, fact_full, fact_recomputed, fact_without
from strata.plans.silver import silver_full, silver_incremental
from strata.sources.directory import by_table
from strata.sources.extract import (
    changed_since,
    event_date_column,
    high_water_mark,
    in_window,
    timestamp,
    window_extract,
)
from strata.sources.staging import shared_folder, stage_all, stage_rows
from strata.sources.tables import MONTH, RUN, Lake
from strata.specs import DIMENSIONS, EVENT_TIMES, TABLES

Query = Callable[[SparkSession, str], DataFrame]

# Rows of this time and later are the second load of the incremental queries. The small
# dimensions change early in the data, so that theirs lies there.
CUT = "2023-09-01 00:00:00"
DIMENSION_CUTS = {
    "dim_warehouse": "2023-05-04 00:00:00",
    "dim_content": "2023-05-08 00:00:00",
    "dim_subscription_plan": "2023-05-20 00:00:00",
}
EVENT_CUT = "2024-01-20 00:00:00"
LATE_MONTH = 202203
WINDOW = ("2024-01-05 00:00:00", "2024-01-12 00:00:00")


CUT_WATERMARK = "2023-08-31 23:59:59.999999"  # the last instant before the cut


def plain(df: DataFrame) -> DataFrame:
    def column(name: str, kind: str):
        if kind == "date" or kind.startswith("timestamp"):
            return F.col(name).cast("string").alias(name)
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name)

    return df.select(*[column(f.name, f.dataType.simpleString()) for f in df.schema])


# --- silver and bronze ------------------------------------------------------------------


def _silver(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return silver_full(table, bronze(spark, sf, table), TIE_BREAK.get(table, ()))


def silver_table(table: str, spark: SparkSession, sf: str) -> DataFrame:
    return plain(_silver(spark, sf, table).drop("load_timestamp"))


def bronze_snapshot_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return plain(bronze(spark, sf, "payment"))


def bronze_delta_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Rentals changed since the newest time of what was loaded before the cut."""
    rentals = source(spark, sf, "rental")
    loaded = rentals.filter(F.col("updated_at") < timestamp(CUT))
    return plain(changed_since(rentals, high_water_mark(loaded).scalar()))


def table_high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    marks = [
        high_water_mark(source(spark, sf, t)).select(F.lit(t).alias("table_name"), "last_watermark")
        for t in SOURCES
    ]
    return plain(union_all(marks))


def watermark_control_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The control table after the first load of all event tables and a second load of some."""
    def marks(cut: str | None, tables: list[str]) -> DataFrame:
        parts = []
        for t in tables:
            rows = source(spark, sf, t)
            rows = rows if cut is None else rows.filter(F.col("updated_at") < timestamp(cut))
            parts.append(high_water_mark(rows).select(F.lit(t).alias("table_name"), "last_watermark"))
        return union_all(parts)

    events = [t for t, spec in TABLES.items() if spec.events]
    return plain(upsert(marks(CUT, events), marks(None, events[::2]), ["table_name"]))


def backfill_window_extract(spark: SparkSession, sf: str) -> DataFrame:
    return plain(window_extract(source(spark, sf, "streaming_session"), *WINDOW))


def backfill_window_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze loaded late in the window, then the window taken again from the source."""
    rows = source(spark, sf, "streaming_session")
    column = event_date_column(rows)
    damaged = rows.filter(~in_window(column, *WINDOW) | (F.col("stream_id") % 3 == 0))
    return plain(replace_window(damaged, window_extract(rows, *WINDOW), *WINDOW))


def _silver_in_two_loads(table: str, cut: str, spark: SparkSession, sf: str) -> DataFrame:
    """The first load sees what the source held before the cut: no row created or updated since."""
    rows = bronze(spark, sf, table)
    ties = TIE_BREAK.get(table, ())
    loaded = rows.filter(F.greatest("created_at", "updated_at") < timestamp(cut))
    before = stage_rows(silver_full(table, loaded, ties, reread=True))
    return silver_incremental(table, before, rows, high_water_mark(before).scalar(), ties)


def silver_in_two_loads(table: str, cut: str, spark: SparkSession, sf: str) -> DataFrame:
    return plain(_silver_in_two_loads(table, cut, spark, sf).drop("load_timestamp"))


def silver_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    """Each text rule on the line items' flags and the names of parts and suppliers."""
    names = given(spark, sf, "lineitem").join(
        given(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    raw = F.concat(
        F.lit("  "), "p_name", F.lit("'s "), "l_returnflag", F.lit("-"), "p_type", F.lit("_4k"),
        F.when(F.col("l_linenumber") == 1, F.lit("  ")).otherwise(F.lit("")),
    )
    raw = F.when(F.col("l_linenumber") == 7, F.lit("   ")).otherwise(raw)
    return names.select(raw.alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n")).select(
        "raw",
        "n",
        trimmed_text(F.col("raw")).alias("trimmed"),
        upper_text(F.col("raw")).alias("upper_case"),
        lower_text(F.col("raw")).alias("lower_case"),
        title_text(F.col("raw")).alias("title_case"),
    )


def silver_null_out_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return given(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        non_negative(F.col("c_acctbal")).alias("non_negative"),
        within(F.col("c_custkey") % 10, 1, 5).alias("in_range"),
    )


def silver_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    lines = given(spark, sf, "lineitem").withColumns(
        {"updated_at": F.col("l_shipdate"), "load_timestamp": timestamp(RUN_TS)}
    )
    ties = ["l_partkey", "l_suppkey", "l_extendedprice"]
    latest = latest_version(lines, ["l_orderkey", "l_linenumber"], ties)
    return plain(latest.drop("updated_at", "load_timestamp"))


def silver_interval_filter(spark: SparkSession, sf: str) -> DataFrame:
    rentals = source(spark, sf, "rental")
    return plain(valid_span(rentals, "rental_date", "return_date"))


# --- calendar and dimensions ------------------------------------------------------------


def dim_date_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of the calendar with its payments; payments outside it drop out."""
    paid = (
        source(spark, sf, "payment")
        .groupBy(day("payment_date").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("payments"))
    )
    return plain(date_dimension(spark).join(paid, "full_date", "left").fillna(0, ["payments"]))


def dim_month_orders(spark: SparkSession, sf: str) -> DataFrame:
    paid = (
        source(spark, sf, "payment")
        .groupBy(month_key("payment_date").alias("month_key"))
        .agg(F.count(F.lit(1)).alias("payments"))
    )
    return plain(month_dimension(spark).join(paid, "month_key", "left").fillna(0, ["payments"]))


def latest_customer_address(spark: SparkSession, sf: str) -> DataFrame:
    return latest_address(_silver(spark, sf, "customer_address"))


DIMENSION_TABLES = {
    "dim_customer": ("customer", "customer_address", "city", "country"),
    "dim_content": ("content",),
    "dim_subscription_plan": ("subscription_plan",),
    "dim_warehouse": ("warehouse", "city"),
    "dim_inventory": ("inventory_item", "content", "warehouse", "city"),
}


class Warehouse:
    """Silver tables and dimensions as of a time (or of everything), built when asked for.

    As in the loads, what several later steps read is written first.
    """

    def __init__(self, spark: SparkSession, sf: str, cut: str | None = None):
        self.spark, self.sf, self.cut = spark, sf, cut
        self._made: dict[str, DataFrame] = {}
        self._landed: dict[str, DataFrame] = {}

    def before(self, cut: str) -> Warehouse:
        """The same warehouse as of a time; both read the bronze rows that are written."""
        earlier = Warehouse(self.spark, self.sf, cut)
        earlier._landed = self._landed
        return earlier

    def land(self, *tables: str) -> None:
        """Write bronze tables that are made by a join, for several loads."""
        made = {t: bronze(self.spark, self.sf, t) for t in tables if not from_one_table(t) and t not in self._landed}
        self._landed.update(stage_all(made))

    def _table(self, t: str) -> DataFrame:
        if t not in self._made:
            rows = self._landed[t] if t in self._landed else bronze(self.spark, self.sf, t)
            if self.cut is not None:
                updated = F.coalesce("updated_at", timestamp("1900-01-01"))
                rows = rows.filter(updated < timestamp(self.cut))
            reread = t in self._landed or from_one_table(t)
            self._made[t] = silver_full(t, rows, TIE_BREAK.get(t, ()), reread)
        return self._made[t]

    def kept(self, t: str) -> DataFrame:
        """A silver table that several steps read, written."""
        self._made[t] = stage_rows(self._table(t))
        return self._made[t]

    def silver(self, *tables: str) -> dict[str, DataFrame]:
        return {t: self._table(t) for t in tables}

    def _dimension(self, name: str, made: dict[str, DataFrame]) -> DataFrame:
        self.kept(DRIVING_TABLE[name])  # numbering counts its rows before it numbers them
        return dimension_full(name, self.silver(*DIMENSION_TABLES[name]), made, RUN_TS)

    def stored(self, tables: Sequence[str], names: Sequence[str]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
        """Written silver tables and dimensions of one load; items come after what they look up."""
        looked_up = {"dim_content", "dim_warehouse"} if "dim_inventory" in names else set()
        first = [d for d in DIMENSION_TABLES if d in looked_up.union(names) and d != "dim_inventory"]
        made = stage_all({**self.silver(*tables), **{d: self._dimension(d, {}) for d in first}})
        silver = {t: made.pop(t) for t in tables}
        if looked_up:
            made["dim_inventory"] = stage_rows(self._dimension("dim_inventory", made))
        made["dim_date"] = date_dimension(self.spark)
        made["dim_month"] = month_dimension(self.spark)
        return silver, made


def dimension_table(name: str, spark: SparkSession, sf: str) -> DataFrame:
    wh = Warehouse(spark, sf)
    needed = {}
    if name == "dim_inventory":
        _, needed = wh.stored([], ["dim_content", "dim_warehouse"])
    wh.kept(DRIVING_TABLE[name])
    dim = dimension_full(name, wh.silver(*DIMENSION_TABLES[name]), needed, RUN_TS)
    return plain(dim.drop("created_at", "updated_at"))


def cut_of(dimension: str) -> str:
    return DIMENSION_CUTS.get(dimension, CUT)


def just_before(time: str) -> str:
    """The last instant before a time: changes are taken strictly after a watermark."""
    return str(datetime.fromisoformat(time) - timedelta(microseconds=1))


def _merged(name: str, spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """A dimension of the rows before its cut, merged with the rows since, and the
    dimensions of the first load."""
    after = Warehouse(spark, sf)
    after.land(DRIVING_TABLE[name])
    _, dims = after.before(cut_of(name)).stored([], [name])
    after.kept(DRIVING_TABLE[name])
    silver = after.silver(*DIMENSION_TABLES[name])
    return dimension_incremental(name, dims[name], silver, dims, just_before(cut_of(name)), RUN_TS), dims


def dimension_in_two_loads(name: str, spark: SparkSession, sf: str) -> DataFrame:
    merged, _ = _merged(name, spark, sf)
    return plain(merged.drop("created_at", "updated_at"))


def merged_dimensions(names: Sequence[str], spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Written dimensions with several versions of a key, and the calendar."""
    made: dict[str, DataFrame] = {}
    for name in names:
        merged, first = _merged(name, spark, sf)
        made[name] = merged
        if name == "dim_inventory":
            made["dim_warehouse"] = first["dim_warehouse"]
    return stage_all(made) | {"dim_date": date_dimension(spark), "dim_month": month_dimension(spark)}


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that go on after 100, in bands of a thousand: dense, unique and from the start on."""
    pairs = given(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    start = spark.range(100, 101).toDF("last")
    keyed = with_surrogate_key(pairs, "pair_key", ["l_partkey", "l_suppkey"], start)
    return keyed.groupBy(F.floor((F.col("pair_key") - 101) / 1000).alias("band")).agg(
        F.count("*").alias("n"),
        F.countDistinct("pair_key").alias("n_keys"),
        F.countDistinct("l_partkey", "l_suppkey").alias("n_pairs"),
        F.min("pair_key").alias("first_key"),
        F.max("pair_key").alias("last_key"),
    )


# --- lookups ----------------------------------------------------------------------------


def _order_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Customer versions from orders: each ends the day before a later order, some ends are wrong."""
    orders = given(spark, sf, "orders")
    start = F.to_date(F.col("o_orderdate") + F.expr("interval '25' year"))
    return orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("customer_key"),
        start.alias("effective_from"),
        F.when(F.col("o_orderkey") % 6 == 0, F.lit("9999-12-31").cast("date"))
        .otherwise(F.date_add(start, (F.col("o_orderkey") % 1500 - 20).cast("int")))
        .alias("effective_to"),
        (F.col("o_orderkey") % 6 == 0).alias("is_current"),
    )


def _session_days(spark: SparkSession, sf: str) -> DataFrame:
    return (
        given(spark, sf, "events")
        .select(F.col("user_id").alias("customer_id"), day("ts").alias("activity_date"))
        .distinct()
    )


def pit_lookup_fallback(spark: SparkSession, sf: str) -> DataFrame:
    versions = version_timeline(_order_versions(spark, sf), "customer_id", "customer_key")
    return plain(at_day(_session_days(spark, sf), versions, "customer_id", F.col("activity_date")))


def active_interval_lookup(spark: SparkSession, sf: str) -> DataFrame:
    active = interval_timeline(
        source(spark, sf, "customer_subscription"),
        "customer_id",
        "start_date",
        "end_date",
        order=["start_date", "subscription_id"],
        answer=["subscription_id", "plan_id"],
    )
    found = at_day(_session_days(spark, sf), active, "customer_id", F.col("activity_date"), "left")
    return plain(found)


def pit_lookup_many_versions(spark: SparkSession, sf: str) -> DataFrame:
    """The same versions under keys of a few customers each, so that a key has more of them
    than are cut within a row."""
    versions = _order_versions(spark, sf).withColumn("customer_id", F.col("customer_id") % 5)
    days = _session_days(spark, sf).withColumn("customer_id", F.col("customer_id") % 5).distinct()
    timeline = version_timeline(versions, "customer_id", "customer_key")
    return plain(at_day(days, timeline, "customer_id", F.col("activity_date")))


def active_interval_many(spark: SparkSession, sf: str) -> DataFrame:
    """Active subscriptions under keys of a few customers each."""
    held = source(spark, sf, "customer_subscription").withColumn("customer_id", F.col("customer_id") % 5)
    days = _session_days(spark, sf).withColumn("customer_id", F.col("customer_id") % 5).distinct()
    order = ["start_date", "subscription_id"]
    active = interval_timeline(held, "customer_id", "start_date", "end_date", order=order, answer=["subscription_id", "plan_id"])
    return plain(at_day(days, active, "customer_id", F.col("activity_date"), "left"))


# --- facts ------------------------------------------------------------------------------

FACT_DIMENSIONS = {
    "fact_customer_daily_activity": ("dim_customer", "dim_subscription_plan"),
    "fact_content_monthly_performance": ("dim_content",),
    "fact_inventory_daily_utilisation": ("dim_inventory",),
}
FACT_TABLES = {
    "fact_customer_daily_activity": (*FACT_SOURCES["fact_customer_daily_activity"], "customer_subscription"),
    "fact_content_monthly_performance": (*FACT_SOURCES["fact_content_monthly_performance"], "inventory_item"),
    "fact_inventory_daily_utilisation": FACT_SOURCES["fact_inventory_daily_utilisation"],
}


def fact_table(name: str, spark: SparkSession, sf: str, settled_only: bool = True) -> DataFrame:
    wh = Warehouse(spark, sf)
    # the timeline of subscriptions reads them more than once
    reread = [t for t in FACT_TABLES[name] if t == "customer_subscription"]
    kept, _ = wh.stored(reread, [])
    dims = merged_dimensions(FACT_DIMENSIONS[name], spark, sf)
    return plain(fact_full(name, wh.silver(*FACT_TABLES[name]) | kept, dims, settled_only))


def fact_in_two_loads(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """A fact of the rows before a cut, then refreshed for the keys changed since.

    The first load sees every event table up to the cut; the dimensions and the tables
    that only place events (items, subscriptions) are those of the second load. The months
    of the affected keys are passed, as a load does.
    """
    wh = Warehouse(spark, sf)
    wh.land(*FACT_SOURCES[name])
    first = wh.before(EVENT_CUT)
    silver, _ = wh.stored(FACT_TABLES[name], [])
    dims = merged_dimensions(FACT_DIMENSIONS[name], spark, sf)
    before = {**silver, **first.silver(*FACT_SOURCES[name])}
    loaded = stage_rows(fact_full(name, before, dims))
    marks = {t: EVENT_WATERMARK for t in FACT_SOURCES[name]}
    affected = stage_rows(fact_affected(name, silver, marks, dims))
    key = GRAIN[name][0][1]
    month = F.col(key) if key == "month_key" else month_key(key)
    found = affected.groupBy(month.alias("m")).count().collect()
    small = sum(r["count"] for r in found) <= jobs.Settings(SOURCE_SYSTEM).broadcast_keys
    new = fact_recomputed(name, silver, dims, affected, months=[r["m"] for r in found], small_affected=small)
    return plain(fact_without(name, loaded, affected, dims).unionByName(new.select(*loaded.columns)))


EVENT_WATERMARK = just_before(EVENT_CUT)


def fact_affected_keys(name: str, spark: SparkSession, sf: str) -> DataFrame:
    silver = Warehouse(spark, sf).silver(*FACT_TABLES[name])
    calendar = {"dim_date": date_dimension(spark), "dim_month": month_dimension(spark)}
    marks = {t: EVENT_WATERMARK for t in FACT_SOURCES[name]}
    return plain(fact_affected(name, silver, marks, calendar))


def dimension_batch_customer(spark: SparkSession, sf: str) -> DataFrame:
    silver = Warehouse(spark, sf).silver(*DIMENSION_TABLES["dim_customer"])
    batch = dimension_batch("dim_customer", silver, {}, CUT_WATERMARK)
    spec = DIMENSIONS["dim_customer"]
    return plain(batch.select(spec.natural_key, *spec.attributes, "updated_at"))


# --- whole loads ------------------------------------------------------------------------


def _load_settings(fact: str) -> jobs.Settings:
    dims = list(FACT_DIMENSIONS[fact])
    if "dim_inventory" in dims:
        dims = ["dim_content", "dim_warehouse", *dims]
    tables = dict.fromkeys([*FACT_TABLES[fact], *[t for d in dims for t in DIMENSION_TABLES[d]]])
    return jobs.Settings(SOURCE_SYSTEM, tables=tuple(tables), gold=(*dims, fact))


def _new_lake(spark: SparkSession) -> Lake:
    name = f"q{uuid.uuid4().hex[:8]}_"
    return Lake(spark, name, f"{shared_folder(spark).rstrip('/')}/lakes")


WHOLE = jobs.Settings(SOURCE_SYSTEM)


def _by_natural_key(lake: Lake, fact: str) -> DataFrame:
    """A stored fact with natural keys in place of surrogate keys, which depend on the loads."""
    natural, dim, surrogate = GRAIN[fact][0][0], *GRAIN[fact][1:]
    rows = lake.read(f"gold.{fact}").join(lake.read(f"gold.{dim}").select(surrogate, natural), surrogate)
    if "subscription_plan_key" in rows.columns:
        plans = lake.read("gold.dim_subscription_plan").select(F.col("plan_key").alias("subscription_plan_key"), "plan_id")
        rows = rows.join(plans, "subscription_plan_key", "left")
    if "warehouse_key" in rows.columns:
        rows = rows.join(lake.read("gold.dim_warehouse").select("warehouse_key", "warehouse_id"), "warehouse_key")
    return plain(rows.drop(surrogate, "subscription_plan_key", "warehouse_key"))


def fact_with_late_keys(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """A load in which half of the customers, titles and items are missing while all events
    are there, then an incremental load with everything. Of the warehouse, the tables that
    the fact is made from."""
    lake, settings, written = _new_lake(spark), _load_settings(name), written_source(spark, sf)
    late = {"customer": "customer_id", "content": "content_id", "inventory_item": "inventory_id"}

    def before(table: str) -> DataFrame:
        rows = written(table)
        return rows.filter(F.col(late[table]) % 2 == 0) if table in late else rows

    def after(table: str) -> DataFrame:
        """The others come as new rows of the operational system."""
        rows = written(table)
        if table not in late:
            return rows
        new = F.col(late[table]) % 2 == 1
        return rows.withColumn("updated_at", F.when(new, timestamp(RUN_TS)).otherwise(F.col("updated_at")))

    jobs.full_load(lake, before, "2026-12-31 00:00:00", settings)
    jobs.incremental_load(lake, after, RUN_TS, settings)
    return _by_natural_key(lake, name)


def fact_of_few_months(name: str, spark: SparkSession, sf: str) -> DataFrame:
    """A load that lacks the events of one month, then an incremental load with them. Rentals
    of that month come back in any month, and rentals of any month come back in it."""
    lake, settings = _new_lake(spark), replace(_load_settings(name), late_keys=False)
    written = written_source(spark, sf)

    def late(table: str):
        return month_key(EVENT_TIMES[table]) == LATE_MONTH if table in FACT_SOURCES[name] else F.lit(False)

    def before(table: str) -> DataFrame:
        return written(table).filter(~F.coalesce(late(table), F.lit(False)))

    def after(table: str) -> DataFrame:
        rows = written(table)
        return rows.withColumn("updated_at", F.when(late(table), timestamp(RUN_TS)).otherwise(F.col("updated_at")))

    jobs.full_load(lake, before, "2026-12-31 00:00:00", settings)
    jobs.incremental_load(lake, after, RUN_TS, settings)
    return _by_natural_key(lake, name)


def bronze_undated_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Payments from a source that keeps no times, loaded three times: some are new in the
    second load, some change, and some of those change back. Every landed version with the
    number of its load."""
    lake, settings = _new_lake(spark), jobs.Settings(SOURCE_SYSTEM, tables=("payment",), gold=())
    key, kind, never = F.col("payment_id"), F.col("payment_type"), F.lit(None).cast("timestamp_ntz")
    rows = source(spark, sf, "payment").withColumns({"created_at": never, "updated_at": never})
    moved = F.lit("moved")
    loads = [
        rows.filter(key % 10 != 0),
        rows.withColumn("payment_type", F.when(key % 7 == 0, moved).otherwise(kind)),
        rows.withColumn("payment_type", F.when((key % 7 == 0) & (key % 14 != 0), moved).otherwise(kind)),
    ]
    for n, held in enumerate(loads):
        load = jobs.bronze_incremental_load if n else jobs.bronze_full_load
        load(lake, lambda _, held=held: held, f"2026-12-0{n + 1} 00:00:00", settings)
    landed = lake.stored("bronze.payment").withColumnRenamed(RUN, "load")
    return plain(landed.select("payment_id", "customer_id", "amount", "payment_date", "payment_type", "load"))


def rental_months(column: str, spark: SparkSession, sf: str) -> DataFrame:
    """The directory of the months in which a customer or an item has rentals, after two loads."""
    lake, settings = _new_lake(spark), jobs.Settings(SOURCE_SYSTEM, tables=("rental",), gold=())
    rows = written_source(spark, sf)("rental")
    new = F.col("rental_id") % 3 == 0
    arrived = rows.withColumn("updated_at", F.when(new, timestamp(RUN_TS)).otherwise(F.col("updated_at")))
    jobs.full_load(lake, lambda _: rows.filter(~new), "2026-12-31 00:00:00", settings)
    jobs.incremental_load(lake, lambda _: arrived, RUN_TS, settings)
    return lake.stored(by_table("silver.rental", column)).withColumnRenamed(MONTH, "month_key")


def _all_facts(lake: Lake) -> DataFrame:
    """The rows of all facts with natural keys; a fact has nulls in the columns of the others."""
    parts = [_by_natural_key(lake, fact).withColumn("fact", F.lit(fact)) for fact in GRAIN]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pipeline_full_load(spark: SparkSession, sf: str) -> DataFrame:
    """All tables loaded through all layers; the facts."""
    lake = _new_lake(spark)
    jobs.full_load(lake, partial(source_without_ties, spark, sf), RUN_TS, WHOLE)
    return _all_facts(lake)


def pipeline_incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """A full load before some events arrived, then an incremental load with them; the facts."""
    lake, written = _new_lake(spark), written_source(spark, sf)
    late = ("streaming_session", "wishlist")

    def before(table: str) -> DataFrame:
        rows = written(table)
        return rows.filter(F.col("updated_at") < timestamp(EVENT_CUT)) if table in late else rows

    jobs.full_load(lake, before, "2026-12-31 00:00:00", WHOLE)
    jobs.incremental_load(lake, written, RUN_TS, WHOLE)
    return _all_facts(lake)


def pipeline_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """A load that lost sessions of a date range, repaired by a backfill of that range; the facts."""
    lake, source_rows = _new_lake(spark), written_source(spark, sf)

    def damaged(table: str) -> DataFrame:
        rows = source_rows(table)
        if table != "streaming_session":
            return rows
        return rows.filter(~in_window("created_at", *WINDOW) | (F.col("stream_id") % 3 == 0))

    jobs.full_load(lake, damaged, "2026-12-31 00:00:00", WHOLE)
    jobs.backfill(lake, source_rows, RUN_TS, *WINDOW, WHOLE)
    return _all_facts(lake)


def source_without_ties(
    spark: SparkSession, sf: str, table: str, kept: Callable[[DataFrame], DataFrame] = lambda ranked: ranked
) -> DataFrame:
    """An operational table as its system holds it: the newest version of each key.

    The jobs have no tie-break columns, so ties are settled before them; `kept` may write the
    rows that were ranked for it. Settling reads a table several times, so one that comes of a
    join is written first and joined once.
    """
    spec, rows = TABLES[table], source(spark, sf, table)
    rows = rows if from_one_table(table) else stage_rows(rows)
    rows = rows.withColumn("load_timestamp", timestamp(RUN_TS))
    latest = latest_of_repeated(rows, spec.keys, newest_first(TIE_BREAK.get(table, ())), kept)
    return latest.drop("load_timestamp")


def written_source(spark: SparkSession, sf: str) -> jobs.Source:
    """The operational tables for queries of several loads, settled when a load first asks for
    them. Their rows of repeated keys, which were ranked, are written, and one that comes of a
    join; a scan of a given table is read from it."""
    return lru_cache(maxsize=None)(lambda table: source_without_ties(spark, sf, table, stage_rows))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_snapshot_lineage": bronze_snapshot_lineage,
        "bronze_delta_extract": bronze_delta_extract,
        "table_high_water_mark": table_high_water_mark,
        "watermark_control_upsert": watermark_control_upsert,
        "backfill_window_extract": backfill_window_extract,
        "backfill_window_replace": backfill_window_replace,
        "silver_clean_text": silver_clean_text,
        "silver_null_out_invalid": silver_null_out_invalid,
        "silver_dedup_latest": silver_dedup_latest,
        "silver_interval_filter": silver_interval_filter,
    }
    for table in TABLES:
        found[f"silver_{table}"] = partial(silver_table, table)
    for table, cut in TWO_LOADS.items():
        found[f"silver_{table}_incremental"] = partial(silver_in_two_loads, table, cut)
    found |= {
        "dim_date": dim_date_orders,
        "dim_month": dim_month_orders,
        "latest_customer_address": latest_customer_address,
        "surrogate_keys": surrogate_keys,
        "dim_customer_batch": dimension_batch_customer,
    }
    for name in DIMENSION_TABLES:
        found[f"{name}_full"] = partial(dimension_table, name)
        found[f"{name}_incremental"] = partial(dimension_in_two_loads, name)
    found |= {
        "pit_lookup_fallback": pit_lookup_fallback,
        "active_interval_lookup": active_interval_lookup,
        "pit_lookup_many_versions": pit_lookup_many_versions,
        "active_interval_many": active_interval_many,
    }
    for name in FACT_TABLES:
        found[name] = partial(fact_table, name)
        found[f"{name}_incremental"] = partial(fact_in_two_loads, name)
        found[f"{name}_affected"] = partial(fact_affected_keys, name)
        found[f"{name}_late"] = partial(fact_with_late_keys, name)
        found[f"{name}_few_months"] = partial(fact_of_few_months, name)
    found |= {
        "bronze_undated_loads": bronze_undated_loads,
        "rental_months_by_customer": partial(rental_months, "customer_id"),
        "rental_months_by_item": partial(rental_months, "inventory_id"),
        "pipeline_full_load": pipeline_full_load,
        "pipeline_incremental_load": pipeline_incremental_load,
        "pipeline_backfill": pipeline_backfill,
    }
    found["fact_customer_daily_activity_all_payments"] = partial(
        fact_table, "fact_customer_daily_activity", settled_only=False
    )
    return found


# Tables loaded in two steps, among them composite keys and inverted spans on the newest row.
# The cut of each lies where its rows change.
TWO_LOADS = {
    **dict.fromkeys(
        ("rental", "delivery", "payment", "review", "content_artist", "content_genre", "customer", "customer_address",
         "customer_subscription", "inventory_item"), CUT),
    **dict.fromkeys(("streaming_session", "wishlist", "support_ticket", "recommendation"), EVENT_CUT),
    "content": DIMENSION_CUTS["dim_content"],
}
