"""The three fact tables, full and incremental.

Each fact is: the event sources in one long layout, one aggregation to its grain, the
calendar, and the point-in-time lookups. Aggregation comes before every join, so a
customer, item or title that holds much of the events reaches the joins as one row per
day or month.

There are two incremental forms, and both give the rows a full load would give, up to which
surrogate key stands for a natural key. One finds the keys with changed rows, recomputes
them from all their history and replaces them (`fact_incremental`). The other, which the
jobs use, keeps partial sums and adds signed changes to them (`fact_states`, `fact_state`),
so that it reads no history, and an event that moves leaves the day it was on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import date_key, day, month_key, month_start
from strata.operators.clean import rows_of_keys
from strata.operators.measures import long_layout, mean_of, union_all
from strata.operators.timeline import at_day, interval_timeline, version_timeline
from strata.plans.stored import RETURNS, SIGN
from strata.sources.extract import changed_since, timestamp
from strata.sources.staging import stage
from strata.sources.tables import MONTH

Frames = Mapping[str, DataFrame]
Watermarks = Mapping[str, "str | datetime"]

CUSTOMER_DAY = ("customer_id", "activity_date")
CONTENT_MONTH = ("content_id", "month_key")
INVENTORY_DAY = ("inventory_id", "activity_date")

# The silver tables whose changes make a fact recompute keys.
FACT_SOURCES = {
    "fact_customer_daily_activity": ("streaming_session", "rental", "payment", "support_ticket"),
    "fact_content_monthly_performance": ("streaming_session", "rental", "review", "wishlist"),
    "fact_inventory_daily_utilisation": ("rental",),
}


def in_months(column: Column, months: Sequence[int] | None) -> Column:
    """A time that falls into one of the yyyyMM months, as ranges a file scan can use.

    Consecutive months become one range. `months` is bounded by the calendar.
    """
    if months is None:
        return F.lit(True)
    ranges: list[list[int]] = []
    for n in sorted({m // 100 * 12 + m % 100 - 1 for m in months}):
        if ranges and n == ranges[-1][1]:
            ranges[-1][1] = n + 1
        else:
            ranges.append([n, n + 1])
    condition = F.lit(False)
    for first, after in ranges:
        bounds = [f"{n // 12:04d}-{n % 12 + 1:02d}-01 00:00:00" for n in (first, after)]
        condition = condition | ((column >= timestamp(bounds[0])) & (column < timestamp(bounds[1])))
    return condition


def _rows(
    silver: Frames, table: str, watermarks: Watermarks | None, months: Sequence[int] | None = None
) -> DataFrame:
    """A silver table, or only its rows changed since the table's watermark.

    `months` skips the stored partitions of other months. Rows in the partition of events
    without a date have no place in a month.
    """
    rows = silver[table] if watermarks is None else changed_since(silver[table], watermarks[table])
    if months is None or MONTH not in rows.columns:
        return rows
    return rows.filter(F.col(MONTH).isin([int(m) for m in months]))


def _keep(df: DataFrame, keys: Sequence[str], affected: DataFrame | None) -> DataFrame:
    return df if affected is None else df.join(affected.select(*keys), list(keys), "left_semi")


# --- customer x day ---------------------------------------------------------------------


def _signed(df: DataFrame, values: Mapping[str, Column]) -> dict[str, Column]:
    """The measures of an event row and their number, `events`; subtracted if the row is one that was."""
    values = {"events": F.lit(1), **values}
    return {m: c * F.col(SIGN) for m, c in values.items()} if SIGN in df.columns else values


def state_of(events: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Partial sums of the measures per key. Sums of two sets of events add up to those of both."""
    return events.groupBy(*keys).agg(*[F.sum(m).cast(t).alias(m) for m, t in measures.items()])


CUSTOMER_MEASURES = {
    "events": "bigint",
    "streams": "bigint",
    "duration": "bigint",
    "rentals": "bigint",
    "returns": "bigint",
    "amount": "decimal(14,2)",
    "tickets": "bigint",
}


def _starts_and_returns(
    silver: Frames, key: str, watermarks: Watermarks | None, months: Sequence[int] | None
) -> DataFrame:
    """Two rows per rental: its start and its return, each at its own time.

    Of all rentals in one scan. Of some months from the rentals and the returns stored by
    them: an item can come back in any month, also in one before that of the rental.
    """
    if months is None or RETURNS not in silver or watermarks is not None:
        rentals = _rows(silver, "rental", watermarks)
        both = rentals.select(
            key,
            *[c for c in (SIGN,) if c in rentals.columns],
            F.expr(
                "inline(array(struct(rental_date as at, 1 as rentals, null as returns),"
                " struct(return_date as at, null as rentals, 1 as returns)))"
            ),
        )
        return both.filter(in_months(F.col("at"), months))
    one, none = F.lit(1), F.lit(None).cast("int")
    parts = [
        _rows(silver, table, None, months).select(key, F.col(at).alias("at"), rentals.alias("rentals"), returns.alias("returns"))
        for table, at, rentals, returns in (("rental", "rental_date", one, none), (RETURNS, "return_date", none, one))
    ]
    return union_all(parts).filter(in_months(F.col("at"), months))


def customer_day_events(
    silver: Frames,
    settled_only: bool = True,
    watermarks: Watermarks | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    """Customer events in one layout: all of them, or those of changed rows, or of some months.

    `settled_only` counts the amount of a payment only if its status is COMPLETED or
    missing; any payment still makes its day a day of activity.
    """
    def layout(df: DataFrame, at: str, **values: Column) -> DataFrame:
        keys = {"customer_id": F.col("customer_id"), "activity_date": day(at)}
        return long_layout(df, keys, CUSTOMER_MEASURES, **_signed(df, values))

    def daily(table: str, at: str, **values: Column) -> DataFrame:
        rows = _rows(silver, table, watermarks, months).filter(in_months(F.col(at), months))
        return layout(rows, at, **values)

    one = F.lit(1)
    settled = F.col("status").isNull() | (F.col("status") == "COMPLETED")
    amount = F.when(settled, F.col("amount")) if settled_only else F.col("amount")
    return union_all(
        [
            daily("streaming_session", "start_time", streams=one, duration=F.col("watch_duration")),
            layout(
                _starts_and_returns(silver, "customer_id", watermarks, months),
                "at",
                rentals=F.col("rentals"),
                returns=F.col("returns"),
            ),
            daily("payment", "payment_date", amount=amount),
            daily("support_ticket", "opened_date", tickets=one),
        ]
    ).dropna(subset=list(CUSTOMER_DAY))


def customer_day_measures(
    events: DataFrame, affected: DataFrame | None = None, small_affected: bool = False
) -> DataFrame:
    """Measures per customer and day, of the affected keys only if they are given.

    `small_affected` says that their size was checked: they are then broadcast to the
    events before the shuffle. Otherwise the aggregate comes first, so that only one row
    per key meets them.
    """
    if affected is not None and small_affected:
        events = _keep(events, CUSTOMER_DAY, F.broadcast(affected))
        affected = None
    measured = measured_of("fact_customer_daily_activity", state_of(events, CUSTOMER_DAY, CUSTOMER_MEASURES))
    return _keep(measured, CUSTOMER_DAY, affected)


def customer_day_fact(
    measured: DataFrame, subscriptions: DataFrame, dims: Frames, keep_natural_key: bool = False
) -> DataFrame:
    """Add the calendar, the customer version and the plan of the active subscription."""
    calendar = dims["dim_date"].select(F.col("full_date").alias("activity_date"), "date_key")
    when = F.col("activity_date")
    customers = version_timeline(dims["dim_customer"], "customer_id", "customer_key")
    active = interval_timeline(
        subscriptions,
        "customer_id",
        "start_date",
        "end_date",
        order=["start_date", "subscription_id"],
        answer=["plan_id"],
    )
    plans = version_timeline(dims["dim_subscription_plan"], "plan_id", "plan_key").withColumnRenamed(
        "plan_key", "subscription_plan_key"
    )
    fact = at_day(measured.join(calendar, "activity_date"), customers, "customer_id", when)
    fact = at_day(fact, active, "customer_id", when, "left")
    fact = at_day(fact, plans, "plan_id", when, "left")
    return fact.select(
        *(["customer_id"] if keep_natural_key else []),
        "customer_key",
        "date_key",
        "subscription_plan_key",
        "stream_count",
        "total_streaming_duration",
        "rental_count",
        "returned_item_count",
        "total_amount_spent",
        "support_ticket_count",
    )


# --- content x month --------------------------------------------------------------------


CONTENT_MEASURES = {
    "events": "bigint",
    "streams": "bigint",
    "rentals": "bigint",
    "revenue": "decimal(22,2)",
    "rating_sum": "bigint",
    "rating_count": "bigint",
    "wishes": "bigint",
}


ITEM_MONTH = ("inventory_id", "month_key")
ITEM_MEASURES = {"events": "bigint", "rentals": "bigint", "revenue": "decimal(22,2)"}


def rental_sums(silver: Frames, watermarks: Watermarks | None = None, months: Sequence[int] | None = None) -> DataFrame:
    """Rentals per item and month: an item rented often meets its title as one row a month."""
    rows = _rows(silver, "rental", watermarks, months)
    rows = rows.filter(F.col("rental_date").isNotNull() & F.col("inventory_id").isNotNull()).filter(in_months(F.col("rental_date"), months))
    fee = F.coalesce("rental_fee", F.lit(0)) + F.coalesce("late_fee", F.lit(0))
    keys = {"inventory_id": F.col("inventory_id"), "month_key": month_key("rental_date")}
    each = long_layout(rows, keys, ITEM_MEASURES, **_signed(rows, {"rentals": F.lit(1), "revenue": fee}))
    return state_of(each, ITEM_MONTH, ITEM_MEASURES)


def of_titles(sums: DataFrame, items: DataFrame) -> DataFrame:
    """Sums per item and month as events of the items' titles."""
    found = sums.join(items.select("inventory_id", "content_id"), "inventory_id")
    keys = {"content_id": F.col("content_id"), "month_key": F.col("month_key")}
    return long_layout(found, keys, CONTENT_MEASURES, **{m: F.col(m) for m in ITEM_MEASURES}).dropna(subset=list(CONTENT_MONTH))


def title_events(silver: Frames, watermarks: Watermarks | None = None, months: Sequence[int] | None = None) -> DataFrame:
    """Events that name their title, in one layout.

    A review without a rating counts for nothing and makes no month.
    """
    def monthly(table: str, at: str, **values: Column) -> DataFrame:
        rows = _rows(silver, table, watermarks, months).filter(in_months(F.col(at), months))
        keys = {"content_id": F.col("content_id"), "month_key": month_key(at)}
        return long_layout(rows, keys, CONTENT_MEASURES, **_signed(rows, values))

    one = F.lit(1)
    silver = {**silver, "review": silver["review"].filter("rating is not null")}
    return union_all(
        [
            monthly("streaming_session", "start_time", streams=one),
            monthly("review", "review_date", rating_sum=F.col("rating"), rating_count=one),
            monthly("wishlist", "added_date", wishes=one),
        ]
    ).dropna(subset=list(CONTENT_MONTH))


def content_month_events(
    silver: Frames, watermarks: Watermarks | None = None, months: Sequence[int] | None = None
) -> DataFrame:
    """Content events in one layout; rentals come already summed per item and month."""
    rented = of_titles(rental_sums(silver, watermarks, months), silver["inventory_item"])
    return title_events(silver, watermarks, months).unionByName(rented)


def content_month_measures(
    events: DataFrame, affected: DataFrame | None = None, small_affected: bool = False
) -> DataFrame:
    if affected is not None and small_affected:
        events = _keep(events, CONTENT_MONTH, F.broadcast(affected))
        affected = None
    measured = measured_of("fact_content_monthly_performance", state_of(events, CONTENT_MONTH, CONTENT_MEASURES))
    return _keep(measured, CONTENT_MONTH, affected)


def content_month_fact(measured: DataFrame, dims: Frames, keep_natural_key: bool = False) -> DataFrame:
    """Add the content version of the first day of the month; months outside the calendar drop."""
    contents = version_timeline(dims["dim_content"], "content_id", "content_key")
    months = dims["dim_month"].select("month_key")
    fact = at_day(
        measured.join(months, "month_key"), contents, "content_id", month_start(F.col("month_key"))
    )
    return fact.select(
        *(["content_id"] if keep_natural_key else []),
        "content_key",
        "month_key",
        "total_stream_count",
        "total_rental_count",
        "revenue_generated",
        "average_customer_rating",
        "wishlist_addition_count",
    )


# --- inventory x day --------------------------------------------------------------------


INVENTORY_MEASURES = {"events": "bigint", "rentals": "bigint", "returns": "bigint"}


def inventory_day_events(
    silver: Frames, watermarks: Watermarks | None = None, months: Sequence[int] | None = None
) -> DataFrame:
    rows = _starts_and_returns(silver, "inventory_id", watermarks, months)
    keys = {"inventory_id": F.col("inventory_id"), "activity_date": day("at")}
    values = _signed(rows, {"rentals": F.col("rentals"), "returns": F.col("returns")})
    return long_layout(rows, keys, INVENTORY_MEASURES, **values).dropna(subset=list(INVENTORY_DAY))


def inventory_day_measures(
    events: DataFrame, affected: DataFrame | None = None, small_affected: bool = False
) -> DataFrame:
    if affected is not None and small_affected:
        events = _keep(events, INVENTORY_DAY, F.broadcast(affected))
        affected = None
    measured = measured_of("fact_inventory_daily_utilisation", state_of(events, INVENTORY_DAY, INVENTORY_MEASURES))
    return _keep(measured, INVENTORY_DAY, affected)


def inventory_day_fact(measured: DataFrame, dims: Frames, keep_natural_key: bool = False) -> DataFrame:
    """Add the item version and its warehouse; a day with a rental is fully utilised.

    Items without a known warehouse drop out. That test is made on the timeline of the
    items, before the fact rows come in.
    """
    items = version_timeline(dims["dim_inventory"], "inventory_id", "inventory_key", ["warehouse_key"]).join(
        dims["dim_warehouse"].select("warehouse_key"), "warehouse_key", "left_semi"
    )
    calendar = dims["dim_date"].select(F.col("full_date").alias("activity_date"), "date_key")
    fact = at_day(
        measured.join(calendar, "activity_date"), items, "inventory_id", F.col("activity_date")
    )
    rented = F.col("rental_count") > 0
    return fact.select(
        *(["inventory_id"] if keep_natural_key else []),
        "inventory_key",
        "warehouse_key",
        "date_key",
        "rental_count",
        "return_count",
        F.when(rented, 0).otherwise(1).alias("days_available"),
        F.when(rented, F.lit(100))
        .otherwise(F.lit(0))
        .cast("decimal(5,2)")
        .alias("inventory_utilisation_percentage"),
    )


# --- full and incremental ---------------------------------------------------------------


def fact_events(
    name: str,
    silver: Frames,
    settled_only: bool = True,
    watermarks: Watermarks | None = None,
    months: Sequence[int] | None = None,
) -> DataFrame:
    if name == "fact_customer_daily_activity":
        return customer_day_events(silver, settled_only, watermarks, months)
    if name == "fact_content_monthly_performance":
        return content_month_events(silver, watermarks, months)
    return inventory_day_events(silver, watermarks, months)


def _measure(
    name: str, events: DataFrame, affected: DataFrame | None = None, small_affected: bool = False
) -> DataFrame:
    measures = {
        "fact_customer_daily_activity": customer_day_measures,
        "fact_content_monthly_performance": content_month_measures,
        "fact_inventory_daily_utilisation": inventory_day_measures,
    }
    return measures[name](events, affected, small_affected)


def measured_of(name: str, state: DataFrame) -> DataFrame:
    """A fact's measures from their partial sums, one row per key."""
    def whole(measure: str, cast: str = "bigint") -> Column:
        return F.coalesce(F.col(measure), F.lit(0)).cast(cast)

    measures = {
        "fact_customer_daily_activity": {
            "stream_count": whole("streams"),
            "total_streaming_duration": whole("duration", "int"),
            "rental_count": whole("rentals"),
            "returned_item_count": whole("returns"),
            "total_amount_spent": whole("amount", "decimal(14,2)"),
            "support_ticket_count": whole("tickets"),
        },
        "fact_content_monthly_performance": {
            "total_stream_count": whole("streams"),
            "total_rental_count": whole("rentals"),
            "revenue_generated": whole("revenue", "decimal(14,2)"),
            "average_customer_rating": mean_of(F.col("rating_sum"), F.col("rating_count")),
            "wishlist_addition_count": whole("wishes"),
        },
        "fact_inventory_daily_utilisation": {"rental_count": whole("rentals"), "return_count": whole("returns")},
    }
    return state.select(*GRAIN[name][0], *[c.alias(m) for m, c in measures[name].items()])


# Partial sums that are stored for each fact: their keys and measures. Rentals count for the
# title of their item, so they are kept by item until they are looked up.
STATES: dict[str, dict[str, tuple[tuple[str, ...], dict[str, str]]]] = {
    "fact_customer_daily_activity": {"state": (CUSTOMER_DAY, CUSTOMER_MEASURES)},
    "fact_content_monthly_performance": {"state": (CONTENT_MONTH, CONTENT_MEASURES), "items": (ITEM_MONTH, ITEM_MEASURES)},
    "fact_inventory_daily_utilisation": {"state": (INVENTORY_DAY, INVENTORY_MEASURES)},
}


def fact_states(name: str, silver: Frames, settled_only: bool = True) -> dict[str, DataFrame]:
    """The partial sums of a fact's events: of silver tables, or of their change feeds."""
    if name == "fact_customer_daily_activity":
        events = customer_day_events(silver, settled_only)
    elif name == "fact_content_monthly_performance":
        events = title_events(silver)
    else:
        events = inventory_day_events(silver)
    found = {"state": state_of(events, *STATES[name]["state"])}
    return found | ({"items": rental_sums(silver)} if "items" in STATES[name] else {})


def fact_state(name: str, states: Frames, items: DataFrame | None = None) -> DataFrame:
    """The partial sums at the grain of the fact; keys without any events left are none."""
    keys, measures = STATES[name]["state"]
    found = states["state"].select(*keys, *measures)
    if "items" in states:
        rented = of_titles(states["items"].filter("events > 0"), items)
        found = state_of(found.unionByName(rented), keys, measures)
    return found.filter("events > 0")


def fact_of_state(name: str, state: DataFrame, silver: Frames, dims: Frames) -> DataFrame:
    return _finish(name, measured_of(name, state), silver, dims)


def _finish(
    name: str, measured: DataFrame, silver: Frames, dims: Frames, keep_natural_key: bool = False
) -> DataFrame:
    if name == "fact_customer_daily_activity":
        return customer_day_fact(measured, silver["customer_subscription"], dims, keep_natural_key)
    if name == "fact_content_monthly_performance":
        return content_month_fact(measured, dims, keep_natural_key)
    return inventory_day_fact(measured, dims, keep_natural_key)


# Grain of a fact: its natural keys, and the dimension that turns the surrogate key back.
GRAIN = {
    "fact_customer_daily_activity": (CUSTOMER_DAY, "dim_customer", "customer_key"),
    "fact_content_monthly_performance": (CONTENT_MONTH, "dim_content", "content_key"),
    "fact_inventory_daily_utilisation": (INVENTORY_DAY, "dim_inventory", "inventory_key"),
}


def fact_full(
    name: str,
    silver: Frames,
    dims: Frames,
    settled_only: bool = True,
    keep_natural_key: bool = False,
) -> DataFrame:
    return _finish(
        name, _measure(name, fact_events(name, silver, settled_only)), silver, dims, keep_natural_key
    )


def fact_affected(name: str, silver: Frames, watermarks: Watermarks | None, dims: Frames) -> DataFrame:
    """Grain keys inside the calendar that hold rows changed since their table's watermark,
    or, without watermarks, any rows."""
    keys = GRAIN[name][0]
    return calendar_only(fact_events(name, silver, watermarks=watermarks).select(*keys).distinct(), dims)


def calendar_only(found: DataFrame, dims: Frames) -> DataFrame:
    if "month_key" in found.columns:
        return found.join(dims["dim_month"].select("month_key"), "month_key", "left_semi").select(*found.columns)
    days = dims["dim_date"].select(F.col("full_date").alias("activity_date"))
    return found.join(days, "activity_date", "left_semi").select(*found.columns)


def new_natural_keys(name: str, dims: Frames, loaded: str | datetime) -> DataFrame:
    """Natural keys whose first dimension row is younger than the fact's last load."""
    natural, dim = GRAIN[name][0][0], dims[GRAIN[name][1]]
    young = dim.filter(F.col("created_at") > timestamp(loaded)).select(natural).distinct()
    return young.join(dim.filter(F.col("created_at") <= timestamp(loaded)), natural, "left_anti")


def placed_items(silver: Frames, loaded: str | datetime) -> DataFrame:
    """Items that came or changed after the fact's last load, with their titles."""
    items = silver["inventory_item"].filter(F.col("load_timestamp") > timestamp(loaded))
    return items.select("inventory_id", "content_id").dropna()


def of_affected(name: str, silver: Frames, dims: Frames, affected: DataFrame, small: bool) -> tuple[Frames, Frames]:
    """Silver tables and dimensions with only those versions and subscriptions that the
    affected keys look up, so that no timeline is built for other keys."""
    natural, dim = GRAIN[name][0][0], GRAIN[name][1]
    wanted = affected.select(natural).distinct()
    wanted = F.broadcast(wanted) if small else wanted
    dims = {**dims, dim: _keep(dims[dim], [natural], wanted)}
    if name == "fact_customer_daily_activity":
        silver = {**silver, "customer_subscription": _keep(silver["customer_subscription"], [natural], wanted)}
    return silver, dims


def fact_recomputed(
    name: str,
    silver: Frames,
    dims: Frames,
    affected: DataFrame,
    settled_only: bool = True,
    months: Sequence[int] | None = None,
    small_affected: bool = False,
) -> DataFrame:
    """Fact rows of the affected keys, from all their history.

    `months` are the months of the affected keys, if known: they let the scans skip the rest.
    """
    events = fact_events(name, silver, settled_only, months=months)
    measured = _measure(name, events, affected, small_affected)
    return _finish(name, measured, *of_affected(name, silver, dims, affected, small_affected))


def fact_without(name: str, fact: DataFrame, affected: DataFrame, dims: Frames) -> DataFrame:
    """The fact rows whose natural key is not affected."""
    return fact_split(name, fact, affected, dims)[0]


def fact_split(name: str, fact: DataFrame, affected: DataFrame, dims: Frames) -> tuple[DataFrame, DataFrame]:
    """The fact rows whose natural key is not affected, and those whose key is.

    The natural key decides: a row that points at another version of the same customer,
    title or item than the recomputed row is still replaced. Only the versions of affected
    keys meet the fact, and only the rows that may have one of them move.
    """
    keys, dim, surrogate = GRAIN[name]
    natural = keys[0]
    gone = affected
    if "month_key" not in keys:
        gone = affected.select(natural, date_key("activity_date").alias("date_key"))
    gone = gone.join(dims[dim].select(surrogate, natural), natural).drop(natural)
    gone = stage(gone)
    touched, others = rows_of_keys(fact, gone.columns, gone)
    kept, old = (touched.join(gone, gone.columns, how).select(*fact.columns) for how in ("left_anti", "left_semi"))
    return others.select(*fact.columns).unionByName(kept), old


def fact_incremental(
    name: str,
    fact: DataFrame,
    silver: Frames,
    dims: Frames,
    watermarks: Watermarks,
    settled_only: bool = True,
) -> DataFrame:
    affected = fact_affected(name, silver, watermarks, dims)
    new = fact_recomputed(name, silver, dims, affected, settled_only)
    return fact_without(name, fact, affected, dims).unionByName(new.select(*fact.columns))
