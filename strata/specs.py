"""What each operational table holds and how its silver form is cleaned.

`columns` is the business part of the source schema; every source table also has
`created_at` and `updated_at`, and bronze adds the lineage columns.
`rules` name the cleaning of single columns; a column without a rule passes through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from strata.functions import lower_text, non_negative, title_text, trimmed_text, upper_text, within

Rule = Callable[[Column], Column]

STAMPS = ("created_at", "updated_at")
LINEAGE = ("load_timestamp", "source_system")


def _rating(x: Column) -> Column:
    return within(x, 1, 5)


def _percentage(x: Column) -> Column:
    return within(x, 0, 100)


@dataclass(frozen=True)
class TableSpec:
    keys: tuple[str, ...]
    columns: str
    rules: dict[str, Rule] = field(default_factory=dict)
    #: (start, end): rows whose start lies after their end are dropped after the dedup
    span: tuple[str, str] | None = None
    #: event tables grow without end: silver is stored by month of the event, upserted by partition
    events: bool = False

    @property
    def business_columns(self) -> list[str]:
        return [c.split()[0] for c in self.columns.split(", ")]

    @property
    def source_schema(self) -> str:
        return self.columns + "".join(f", {c} timestamp_ntz" for c in STAMPS)

    @property
    def silver_columns(self) -> list[str]:
        return [*self.business_columns, *STAMPS, *LINEAGE]


# The table schemas, keys and column rules of the operational system.
TABLES: dict[str, TableSpec] = {
    "country": TableSpec(
        ("country_id",),
        "country_id bigint, country_name string, country_code string",
        {"country_name": trimmed_text, "country_code": upper_text},
    ),
    "city": TableSpec(
        ("city_id",),
        "city_id bigint, country_id bigint, city_name string",
        {"city_name": trimmed_text},
    ),
    "content_type": TableSpec(
        ("content_type_id",),
        "content_type_id bigint, content_type string",
        {"content_type": trimmed_text},
    ),
    "genre": TableSpec(
        ("genre_id",),
        "genre_id bigint, genre_name string",
        {"genre_name": title_text},
    ),
    "artist": TableSpec(
        ("artist_id",),
        "artist_id bigint, artist_name string, country string",
        {"artist_name": trimmed_text, "country": title_text},
    ),
    "device": TableSpec(
        ("device_id",),
        "device_id bigint, device_name string",
        {"device_name": title_text},
    ),
    "payment_method": TableSpec(
        ("payment_method_id",),
        "payment_method_id bigint, method_name string",
        {"method_name": title_text},
    ),
    "support_category": TableSpec(
        ("category_id",),
        "category_id bigint, category_name string",
        {"category_name": title_text},
    ),
    "courier": TableSpec(
        ("courier_id",),
        "courier_id bigint, courier_name string",
        {"courier_name": title_text},
    ),
    "warehouse": TableSpec(
        ("warehouse_id",),
        "warehouse_id bigint, city_id bigint, warehouse_name string",
        {"warehouse_name": trimmed_text},
    ),
    "subscription_plan": TableSpec(
        ("plan_id",),
        "plan_id bigint, plan_name string, monthly_fee decimal(10,2), video_quality string, max_devices int",
        {
            "plan_name": trimmed_text,
            "monthly_fee": non_negative,
            "video_quality": title_text,
            "max_devices": non_negative,
        },
    ),
    "customer": TableSpec(
        ("customer_id",),
        "customer_id bigint, customer_no string, first_name string, last_name string, email string, "
        "phone string, date_of_birth date, gender string, registration_date date, status string",
        {
            "customer_no": trimmed_text,
            "first_name": title_text,
            "last_name": title_text,
            "email": lower_text,
            "phone": trimmed_text,
            "gender": title_text,
            "status": upper_text,
        },
    ),
    "customer_address": TableSpec(
        ("address_id",),
        "address_id bigint, customer_id bigint, city_id bigint, address_line string, postal_code string, "
        "address_type string",
        {"address_line": trimmed_text, "postal_code": trimmed_text, "address_type": title_text},
    ),
    "customer_subscription": TableSpec(
        ("subscription_id",),
        "subscription_id bigint, customer_id bigint, plan_id bigint, start_date date, end_date date, "
        "status string, auto_renew boolean",
        {"status": upper_text},
        span=("start_date", "end_date"),
    ),
    "content": TableSpec(
        ("content_id",),
        "content_id bigint, content_type_id bigint, title string, release_date date, duration_minutes int, "
        "language string, age_rating string",
        {
            "title": trimmed_text,
            "duration_minutes": non_negative,
            "language": trimmed_text,
            "age_rating": upper_text,
        },
    ),
    "content_genre": TableSpec(
        ("content_id", "genre_id"),
        "content_id bigint, genre_id bigint",
    ),
    "content_artist": TableSpec(
        ("content_id", "artist_id"),
        "content_id bigint, artist_id bigint, role string",
        {"role": title_text},
    ),
    "streaming_session": TableSpec(
        ("stream_id",),
        "stream_id bigint, customer_id bigint, content_id bigint, device_id bigint, start_time timestamp_ntz, "
        "end_time timestamp_ntz, watch_duration int, completion_percentage decimal(5,2)",
        {"watch_duration": non_negative, "completion_percentage": _percentage},
        span=("start_time", "end_time"),
        events=True,
    ),
    "inventory_item": TableSpec(
        ("inventory_id",),
        "inventory_id bigint, content_id bigint, warehouse_id bigint, barcode string, purchase_date date, "
        "item_condition string, status string",
        {"barcode": trimmed_text, "item_condition": title_text, "status": upper_text},
    ),
    "rental": TableSpec(
        ("rental_id",),
        "rental_id bigint, customer_id bigint, inventory_id bigint, rental_date timestamp_ntz, "
        "due_date timestamp_ntz, return_date timestamp_ntz, rental_fee decimal(10,2), late_fee decimal(10,2), "
        "status string",
        {"rental_fee": non_negative, "late_fee": non_negative, "status": upper_text},
        events=True,
    ),
    "delivery": TableSpec(
        ("delivery_id",),
        "delivery_id bigint, rental_id bigint, courier_id bigint, dispatch_date timestamp_ntz, "
        "delivered_date timestamp_ntz, returned_date timestamp_ntz, delivery_status string",
        {"delivery_status": upper_text},
        events=True,
    ),
    "payment": TableSpec(
        ("payment_id",),
        "payment_id bigint, customer_id bigint, rental_id bigint, subscription_id bigint, "
        "payment_method_id bigint, amount decimal(10,2), payment_date timestamp_ntz, payment_type string, "
        "status string",
        {"amount": non_negative, "payment_type": upper_text, "status": upper_text},
        events=True,
    ),
    "review": TableSpec(
        ("review_id",),
        "review_id bigint, customer_id bigint, content_id bigint, rating int, review_text string, "
        "review_date timestamp_ntz",
        {"rating": _rating, "review_text": trimmed_text},
        events=True,
    ),
    "wishlist": TableSpec(
        ("wishlist_id",),
        "wishlist_id bigint, customer_id bigint, content_id bigint, added_date timestamp_ntz",
        events=True,
    ),
    "support_ticket": TableSpec(
        ("ticket_id",),
        "ticket_id bigint, customer_id bigint, category_id bigint, opened_date timestamp_ntz, "
        "closed_date timestamp_ntz, priority string, status string",
        {"priority": upper_text, "status": upper_text},
        span=("opened_date", "closed_date"),
        events=True,
    ),
    "recommendation": TableSpec(
        ("recommendation_id",),
        "recommendation_id bigint, customer_id bigint, content_id bigint, recommendation_date timestamp_ntz, "
        "algorithm_version string, clicked boolean",
        {"algorithm_version": trimmed_text},
        events=True,
    ),
}

# Fixed value: lookups that come as seed files with a header line.
SEED_TABLES = (
    "artist",
    "city",
    "content_type",
    "country",
    "courier",
    "device",
    "genre",
    "payment_method",
    "subscription_plan",
    "support_category",
    "warehouse",
)

# When an event of each event table happened. Silver is stored by its month.
EVENT_TIMES = {
    "streaming_session": "start_time",
    "rental": "rental_date",
    "delivery": "dispatch_date",
    "payment": "payment_date",
    "review": "review_date",
    "wishlist": "added_date",
    "support_ticket": "opened_date",
    "recommendation": "recommendation_date",
}

# Other keys of event rows, by which the months that hold them are listed.
LOOKED_UP_BY = {
    "streaming_session": ("customer_id", "content_id"),
    "rental": ("customer_id", "inventory_id"),
    "rental_return": ("customer_id", "inventory_id"),
    "payment": ("customer_id",),
    "review": ("content_id",),
    "wishlist": ("content_id",),
    "support_ticket": ("customer_id",),
}

# Fixed value: event-date columns in order of preference for a date-range backfill.
EVENT_DATE_COLUMNS = (
    "created_at",
    "start_time",
    "rental_date",
    "payment_date",
    "opened_date",
    "review_date",
    "added_date",
)

OPEN_END = "9999-12-31"  # fixed value: effective_to of a version that is still valid
FIRST_DAY = "2020-01-01"  # fixed value: first calendar day, and the start of undated dimension rows
LAST_DAY = "2035-12-31"  # fixed value: last calendar day
EPOCH = "1900-01-01 00:00:00"  # fixed value: watermark of a table that holds nothing yet


@dataclass(frozen=True)
class DimensionSpec:
    natural_key: str
    surrogate_key: str
    attributes: tuple[str, ...]
    #: a change in one of these makes a new version; empty for a type 1 dimension
    tracked: tuple[str, ...] = ()
    #: start of the first version, before the creation date is tried
    business_date: str | None = None


# The gold dimensions and the columns that make a new version.
DIMENSIONS: dict[str, DimensionSpec] = {
    "dim_customer": DimensionSpec(
        "customer_id",
        "customer_key",
        (
            "customer_no", "first_name", "last_name", "email", "phone", "date_of_birth", "gender",
            "registration_date", "status", "city", "country",
        ),
        ("first_name", "last_name", "email", "phone", "status", "city", "country"),
        "registration_date",
    ),
    "dim_content": DimensionSpec(
        "content_id",
        "content_key",
        ("title", "release_date", "duration_minutes", "language", "age_rating"),
        ("title", "duration_minutes", "language", "age_rating"),
        "release_date",
    ),
    "dim_subscription_plan": DimensionSpec(
        "plan_id",
        "plan_key",
        ("plan_name", "monthly_fee", "video_quality", "max_devices"),
        ("plan_name", "monthly_fee", "video_quality", "max_devices"),
    ),
    "dim_inventory": DimensionSpec(
        "inventory_id",
        "inventory_key",
        ("content_key", "warehouse_key", "barcode", "purchase_date", "item_condition", "status"),
        ("item_condition", "status", "warehouse_key"),
        "purchase_date",
    ),
    "dim_warehouse": DimensionSpec(
        "warehouse_id",
        "warehouse_key",
        ("warehouse_name", "city"),
    ),
}
