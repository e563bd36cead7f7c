"""A small operational system for job tests: random rows in two batches.

Rows of the second batch are new, or newer versions that keep the customer, item and
times of their first version: a move to another key is not seen by an incremental load.
"""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from strata.specs import TABLES

DAY0 = datetime(2024, 1, 1)


def rows(seed: int = 7) -> dict[str, list[dict]]:
    rng = random.Random(seed)
    out: dict[str, list[dict]] = {t: [] for t in TABLES}

    def at(days: float) -> datetime:
        return DAY0 + timedelta(days=days, seconds=rng.randrange(3600))

    def add(table: str, created: datetime, updated: datetime | None = None, **values) -> None:
        names = TABLES[table].business_columns
        row = dict.fromkeys(names)
        row |= values
        assert set(row) == set(names), (table, set(row) ^ set(names))
        out[table].append(row | {"created_at": created, "updated_at": updated or created})

    for i in range(1, 4):
        add("country", at(0), country_id=i, country_name=f" land {i} ", country_code=f"l{i}")
        add("content_type", at(0), content_type_id=i, content_type=" movie")
        add("genre", at(0), genre_id=i, genre_name="sci-fi")
        add("artist", at(0), artist_id=i, artist_name=" someone", country="sri lanka")
        add("device", at(0), device_id=i, device_name="smart-tv")
        add("payment_method", at(0), payment_method_id=i, method_name="credit card")
        add("support_category", at(0), category_id=i, category_name="billing")
        add("courier", at(0), courier_id=i, courier_name="fast")
    for i in range(1, 7):
        add("city", at(0), city_id=i, country_id=i % 3 + 1, city_name=f" city {i}")
    for i in range(1, 4):
        add("warehouse", at(0), warehouse_id=i, city_id=i, warehouse_name=f" wh {i}")
    add("warehouse", at(0), at(21), warehouse_id=2, city_id=5, warehouse_name="wh 2 new")
    add("warehouse", at(22), warehouse_id=4, city_id=1, warehouse_name="wh 4")
    for i in range(1, 5):
        add("subscription_plan", at(0), plan_id=i, plan_name=f"plan {i}", monthly_fee=Decimal(i),
            video_quality="hd", max_devices=i)
    add("subscription_plan", at(0), at(23), plan_id=3, plan_name="plan 3", monthly_fee=Decimal(9),
        video_quality="hd", max_devices=3)

    for i in range(1, 21):
        person = dict(customer_id=i, customer_no=f"C{i}", first_name="o'neil", last_name=f"x{i}",
                      email=f"A{i}@B.C", phone=" ", date_of_birth=date(1990, 1, 1), gender="male",
                      registration_date=date(2023, 12, 1 + i) if i % 3 else None)
        add("customer", at(0), status="active", **person)
        if i % 4 == 0:
            add("customer", at(0), at(10), status="paused", **person)
        if i % 5 == 0:
            add("customer", at(0), at(24), status="gone", **person)
        add("customer_address", at(1), address_id=i, customer_id=i, city_id=i % 7, address_line="l",
            postal_code="1", address_type="home")
        for k in range(3):
            start = date(2024, 1, 1) + timedelta(days=rng.randrange(40))
            end = start + timedelta(days=rng.randrange(-2, 20)) if rng.random() < 0.7 else None
            add("customer_subscription", at(rng.random() * 18), subscription_id=i * 10 + k, customer_id=i,
                plan_id=rng.randrange(1, 6), start_date=start, end_date=end, status="on", auto_renew=True)
    for i in range(1, 16):
        title = dict(content_id=i, content_type_id=1, release_date=date(2024, 1, 5) if i % 2 else None,
                     language="en", age_rating="pg")
        add("content", at(0), title=f"t{i}", duration_minutes=i - 3, **title)
        if i % 4 == 0:
            add("content", at(0), at(25), title=f"t{i} again", duration_minutes=i, **title)
        add("content_genre", at(0), content_id=i, genre_id=i % 3 + 1)
        add("content_artist", at(0), content_id=i, artist_id=i % 3 + 1, role="lead-actor")
    for i in range(1, 31):
        item = dict(inventory_id=i, content_id=i % 16 or None, warehouse_id=i % 4 or None, barcode="b",
                    purchase_date=date(2024, 1, 3) if i % 2 else None)
        add("inventory_item", at(0), item_condition="good", status="in", **item)
        if i % 6 == 0:
            add("inventory_item", at(0), at(26), item_condition="worn", status="in", **item)

    n = 0
    for _ in range(600):
        n += 1
        t = at(rng.random() * 35)
        customer = rng.choice([None, 99, *[1] * 10, *range(1, 21)])
        kind = rng.randrange(7)
        if kind == 0:
            add("streaming_session", t, stream_id=n, customer_id=customer, content_id=rng.randrange(1, 18),
                device_id=1, start_time=t, end_time=t + timedelta(minutes=rng.randrange(-2, 90)),
                watch_duration=rng.randrange(-5, 90), completion_percentage=Decimal(rng.randrange(-5, 120)))
        elif kind == 1:
            rental = dict(rental_id=n, customer_id=customer, inventory_id=rng.choice([None, *range(1, 33)]),
                          rental_date=t, due_date=t, rental_fee=Decimal(rng.randrange(-1, 9)), late_fee=None)
            add("rental", t, return_date=None, status="out", **rental)
            back = t + timedelta(days=rng.randrange(1, 9))
            add("rental", t, back, return_date=back, status="back", **rental)
            add("delivery", t, delivery_id=n, rental_id=n, courier_id=1, dispatch_date=t, delivered_date=t,
                returned_date=None, delivery_status="done")
        elif kind == 2:
            pay = dict(payment_id=n, customer_id=customer, rental_id=None, subscription_id=None,
                       payment_method_id=1, amount=Decimal(rng.randrange(-1, 50)), payment_date=t,
                       payment_type="card")
            add("payment", t, status=rng.choice(["completed", "failed", None, " "]), **pay)
            if rng.random() < 0.3:
                add("payment", t, t + timedelta(days=6), status="completed", **pay)
        elif kind == 3:
            add("review", t, review_id=n, customer_id=customer, content_id=rng.randrange(1, 18),
                rating=rng.choice([None, 0, 1, 2, 3, 4, 5, 6]), review_text=" ", review_date=t)
        elif kind == 4:
            add("wishlist", t, wishlist_id=n, customer_id=customer, content_id=rng.randrange(1, 18), added_date=t)
        elif kind == 5:
            add("support_ticket", t, ticket_id=n, customer_id=customer, category_id=1, opened_date=t,
                closed_date=t + timedelta(hours=rng.randrange(-3, 40)), priority="low", status="open")
        else:
            add("recommendation", t, recommendation_id=n, customer_id=customer, content_id=1,
                recommendation_date=t, algorithm_version="v1", clicked=True)
    return out
