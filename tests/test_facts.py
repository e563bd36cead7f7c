"""The three facts on hand-made edge rows, and the shape of their plans."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from strata.operators.calendar import date_dimension, month_dimension
from strata.plans.facts import GRAIN, fact_affected, fact_full, fact_incremental, fact_recomputed
from strata.sources.staging import stage
from strata.specs import TABLES

END = date(9999, 12, 31)
OLD, NEW = datetime(2024, 1, 1), datetime(2024, 3, 1)
NIGHT, MIDNIGHT = datetime(2024, 1, 5, 23, 59, 59), datetime(2024, 1, 6)


def table(spark, name, *rows):
    names = [c.split()[0] for c in TABLES[name].source_schema.split(", ")]
    return spark.createDataFrame(
        [tuple({"created_at": OLD, "updated_at": OLD, **r}.get(n) for n in names) for r in rows],
        TABLES[name].source_schema)


@lru_cache(maxsize=1)
def _dims(spark):
    validity = "effective_from date, effective_to date, is_current boolean"
    made = {
        "dim_date": date_dimension(spark, "2024-01-01", "2024-02-29"),
        "dim_month": month_dimension(spark, "2024-01-01", "2024-02-29"),
        "dim_customer": spark.createDataFrame(
            [(1, 10, date(2020, 1, 1), date(2024, 1, 5), False), (2, 10, date(2024, 1, 6), END, True),
             (3, 20, date(2024, 1, 20), END, True)], "customer_key bigint, customer_id bigint, " + validity),
        "dim_subscription_plan": spark.createDataFrame(
            [(1, 1, date(2020, 1, 1), END, True), (2, 2, date(2020, 1, 1), END, True)],
            "plan_key bigint, plan_id bigint, " + validity),
        "dim_content": spark.createDataFrame(
            [(1, 100, date(2024, 1, 1), date(2024, 1, 20), False), (2, 100, date(2024, 1, 21), END, True)],
            "content_key bigint, content_id bigint, " + validity),
        "dim_inventory": spark.createDataFrame(
            [(1, 1000, 7, date(2020, 1, 1), END, True), (2, 2000, None, date(2020, 1, 1), END, True),
             (3, 3000, 8, date(2020, 1, 1), END, True)],
            "inventory_key bigint, inventory_id bigint, warehouse_key bigint, " + validity),
        "dim_warehouse": spark.createDataFrame([(7, 70)], "warehouse_key bigint, warehouse_id bigint"),
    }
    return {k: stage(df) for k, df in made.items()}


def dims(spark):
    return dict(_dims(spark))


def silver(spark):
    return dict(_silver(spark))


@lru_cache(maxsize=1)
def _silver(spark):
    def session(i, who, start, minutes, content=100):
        return dict(stream_id=i, customer_id=who, content_id=content, start_time=start, watch_duration=minutes)

    def pay(i, who, amount, status, at=MIDNIGHT, **more):
        return dict(payment_id=i, customer_id=who, amount=amount and Decimal(amount), status=status,
                    payment_date=at, **more)

    def rent(i, who, item, start, back=None, fee=None, late=None):
        return dict(rental_id=i, customer_id=who, inventory_id=item, rental_date=start, return_date=back,
                    rental_fee=fee and Decimal(fee), late_fee=late and Decimal(late))

    def review(i, rating, at=MIDNIGHT, content=100):
        return dict(review_id=i, content_id=content, rating=rating, review_date=at)

    made = {
        "streaming_session": table(
            spark, "streaming_session",
            session(1, 10, NIGHT, 5), session(2, 10, MIDNIGHT, None), session(3, None, NIGHT, 9),
            session(4, 10, None, 9), session(5, 99, NIGHT, 9, content=None),
            session(6, 10, datetime(2024, 3, 1), 1, content=999)),
        "payment": table(
            spark, "payment",
            pay(1, 10, "1.10", "COMPLETED"), pay(2, 10, "2.20", None), pay(3, 10, "4.40", "FAILED"),
            pay(4, 20, "8.80", "FAILED"), pay(5, 10, None, "COMPLETED", NIGHT), pay(6, 10, "9", None, None)),
        "rental": table(
            spark, "rental",
            rent(1, 10, 1000, NIGHT, MIDNIGHT, "1.00", "0.50"), rent(2, 10, 1000, MIDNIGHT, MIDNIGHT),
            rent(3, 20, 2000, MIDNIGHT, fee="7"), rent(4, 20, None, MIDNIGHT), rent(5, 20, 3000, MIDNIGHT, fee="7"),
            rent(6, 20, 4000, MIDNIGHT, fee="7"), rent(7, 20, 1000, datetime(2023, 12, 31), datetime(2024, 2, 1))),
        "support_ticket": table(
            spark, "support_ticket", dict(ticket_id=1, customer_id=20, opened_date=MIDNIGHT),
            dict(ticket_id=2, customer_id=20, opened_date=None)),
        "review": table(
            spark, "review", review(1, 2), review(2, 3), review(3, 2), review(4, None),
            review(5, None, datetime(2024, 2, 1)), review(6, 5, content=None)),
        "wishlist": table(spark, "wishlist", dict(wishlist_id=1, content_id=100, added_date=MIDNIGHT)),
        "inventory_item": table(
            spark, "inventory_item", dict(inventory_id=1000, content_id=100), dict(inventory_id=2000, content_id=None),
            dict(inventory_id=3000, content_id=100)),
        "customer_subscription": table(
            spark, "customer_subscription",
            dict(subscription_id=1, customer_id=10, plan_id=1, start_date=date(2024, 1, 1)),
            dict(subscription_id=2, customer_id=10, plan_id=2, start_date=date(2024, 1, 6), end_date=date(2024, 1, 6)),
            dict(subscription_id=3, customer_id=20, plan_id=9, start_date=date(2024, 1, 1))),
    }
    return {k: stage(df) for k, df in made.items()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_customer_days(spark):
    name = "fact_customer_daily_activity"
    fact = fact_full(name, silver(spark), dims(spark))
    assert rows(fact) == [
        # customer, day, plan, streams, minutes, rentals, returns, amount, tickets
        (1, 20240105, 1, 1, 5, 1, 0, Decimal("0.00"), 0),
        (2, 20240106, 2, 1, 0, 1, 2, Decimal("3.30"), 0),
        # before its first version: the current one; the plan is unknown
        (3, 20240106, None, 0, 0, 4, 0, Decimal("0.00"), 1),
        (3, 20240201, None, 0, 0, 0, 1, Decimal("0.00"), 0),
    ]
    every = fact_full(name, silver(spark), dims(spark), settled_only=False)
    assert [(r[0], r[7]) for r in rows(every)] == [
        (1, Decimal("0.00")), (2, Decimal("7.70")), (3, Decimal("8.80")), (3, Decimal("0.00"))]


def test_content_months(spark):
    fact = fact_full("fact_content_monthly_performance", silver(spark), dims(spark))
    # February has only a review without a rating: no row. Unknown titles and March drop out.
    assert rows(fact) == [(1, 202401, 3, 3, Decimal("8.50"), Decimal("2.33"), 1)]


def test_inventory_days(spark):
    fact = fact_full("fact_inventory_daily_utilisation", silver(spark), dims(spark))
    # items without a known warehouse drop out; a day with only a return is available
    assert rows(fact) == [
        (1, 7, 20240105, 1, 0, 0, Decimal("100.00")),
        (1, 7, 20240106, 1, 2, 0, Decimal("100.00")),
        (1, 7, 20240201, 0, 1, 1, Decimal("0.00")),
    ]


@pytest.mark.parametrize("name", list(GRAIN))
def test_incremental_equals_full_and_repeats(spark, name):
    tables, around = silver(spark), dims(spark)
    marks = dict.fromkeys(TABLES, "2024-02-01 00:00:00")
    old = {t: df for t, df in tables.items()}
    for t in ("streaming_session", "rental", "payment", "review"):
        key = TABLES[t].keys[0]
        late = tables[t].filter(f"{key} % 2 = 0").withColumn("updated_at", F.lit(NEW).cast("timestamp_ntz"))
        old[t] = tables[t].filter(f"{key} % 2 = 1")
        tables[t] = old[t].unionByName(late)
    full = fact_full(name, tables, around)
    loaded = stage(fact_full(name, old, around))
    assert rows(loaded) != rows(full)
    once = stage(fact_incremental(name, loaded, tables, around, marks))
    assert rows(once) == rows(full)
    assert rows(fact_incremental(name, once, tables, around, marks)) == rows(full)

    affected = stage(fact_affected(name, tables, marks, around))
    assert 0 < affected.count()
    forms = [
        rows(fact_recomputed(name, tables, around, affected, months=months, small_affected=small))
        for months in (None, [202401, 202402]) for small in (False, True)
    ]
    assert all(f == forms[0] for f in forms) and forms[0]


def test_fact_rows_of_another_version_are_replaced(spark):
    """A stored row that points at an older version of its customer goes as well."""
    name = "fact_customer_daily_activity"
    tables, around = silver(spark), dims(spark)
    full = stage(fact_full(name, tables, around))
    wrong = full.replace({2: 1}, subset=["customer_key"])
    again = fact_incremental(name, wrong, tables, around, dict.fromkeys(TABLES, "2023-01-01 00:00:00"))
    assert rows(again) == rows(full)


@pytest.mark.parametrize("name", list(GRAIN))
def test_plans_have_no_pair_joins(spark, name):
    text = fact_full(name, silver(spark), dims(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "partial_sum" in text  # rows of a key are summed before the shuffle
