"""Silver tables and dimensions as they are stored.

Event tables lie by the month of the event, with directories of their keys. Rentals are
stored twice: by the month of the rental, and a row per return by the month of the return,
which need not be a later one. Both are written from the same batch.

What a merge changes goes to the table's change feed before it: each row of the batch with
sign 1, and the row it replaces, if there is one, with sign -1, in a partition of the bronze
load that brought it. Whoever keeps sums of the events adds a feed's signed rows to them.

Tables without events and dimensions lie in buckets of their keys, and a load rewrites the
buckets that it has rows for. A type 2 dimension is two tables under one view: the current
versions in buckets, and the closed ones in a partition of the load that closed them, which
no later load touches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.clean import latest_per_key
from strata.operators.scd2 import closed_versions, dimension_columns, opened_versions
from strata.operators.upsert import numbered_type1, upsert
from strata.sources.directory import keys_table, known_keys, list_rows, months_of, publish_directories
from strata.sources.tables import MONTH, RUN, Lake, month_of
from strata.specs import DIMENSIONS, EVENT_TIMES, LOOKED_UP_BY, TABLES

RETURNS = "rental_return"
SIGN = "_sign"


def returns_of(rentals: DataFrame) -> DataFrame:
    """A row per return."""
    return rentals.filter("return_date is not null").select("rental_id", "customer_id", "inventory_id", "return_date")


@dataclass(frozen=True)
class Layout:
    """One way in which the rows of an event table are stored."""

    name: str
    keys: Sequence[str]
    at: str
    rows: Callable[[DataFrame], DataFrame] = lambda df: df

    @property
    def table(self) -> str:
        return f"silver.{self.name}"

    @property
    def columns(self) -> Sequence[str]:
        """Other keys by which rows are looked up."""
        return LOOKED_UP_BY.get(self.name, ())

    def publish(self, lake: Lake, rows: DataFrame, about: int = 0) -> None:
        """Replace the layout whole, from about so many rows."""
        lake.publish(self.rows(rows), self.table, MONTH, month_of(self.at), about=about)
        publish_directories(lake, self.table, self.keys, self.columns, about)

    def merge(self, lake: Lake, batch: DataFrame, since: int, load: int, about: int) -> None:
        """Upsert the batch of about so many rows; a row that has no place in this layout any
        more goes from it."""
        if not lake.exists(keys_table(self.table)):  # written by other means
            publish_directories(lake, self.table, self.keys, self.columns)
        rows = self.rows(batch).withColumn(MONTH, month_of(self.at))
        known = known_keys(lake, self.table, batch, self.keys).persist()
        held = months_of(known)
        if self.name in TABLES:
            _feed(lake, self.name, batch, held, since, load, about)
        list_rows(lake, self.table, rows, self.keys, self.columns, known)
        known.unpersist()
        lake.merge(rows, self.table, self.keys, held, gone=batch)


def layouts(table: str) -> list[Layout]:
    own = [Layout(table, TABLES[table].keys, EVENT_TIMES[table])]
    return own + ([Layout(RETURNS, TABLES[table].keys, "return_date", returns_of)] if table == "rental" else [])


def feed_table(table: str) -> str:
    return f"silver.{table}__changes"


def _no_changes(lake: Lake, table: str) -> DataFrame:
    return lake.read(f"silver.{table}").limit(0).withColumns({SIGN: F.lit(1), RUN: F.lit(0).cast("bigint")})


def changes_between(lake: Lake, table: str, after: int, upto: int) -> DataFrame:
    """The signed rows of the loads after one number up to another."""
    feed = lake.stored(feed_table(table)) if lake.exists(feed_table(table)) else _no_changes(lake, table)
    return feed.filter((F.col(RUN) > after) & (F.col(RUN) <= upto)).drop(RUN)


def _feed(lake: Lake, table: str, batch: DataFrame, held: Sequence[int], since: int, load: int, about: int) -> None:
    """Write what a batch is about to change to the feed, as the load of that number.

    Loads after `since`, the last that silver has taken in, are there if a merge failed after
    its feed was written, or was made in two batches. The table may then have rows as they
    are now, and the feed knows what they were before. All go into the one load.
    """
    keys = list(TABLES[table].keys)
    if not lake.exists(feed_table(table)):
        lake.publish(_no_changes(lake, table), feed_table(table), RUN, F.col(RUN))
    open_loads = lake.stored(feed_table(table)).filter(F.col(RUN) > since)
    runs = [r[0] for r in open_loads.select(RUN).distinct().collect()]
    feed = latest_per_key(open_loads, [*keys, SIGN], [F.col(RUN).desc()]).drop(RUN)
    stored = lake.stored(f"silver.{table}").filter(F.col(MONTH).isin(list(held))).drop(MONTH)
    before = stored.join(batch.select(*keys), keys, "left_semi") if held else stored
    now = batch.withColumn(SIGN, F.lit(1))
    if runs:
        before = before.join(feed.select(*keys).distinct(), keys, "left_anti")
        now = upsert(feed.filter(F.col(SIGN) > 0), now, keys)
    before = before.withColumn(SIGN, F.lit(-1))
    if runs:
        before = before.unionByName(feed.filter(F.col(SIGN) < 0))
    signed = before.unionByName(now.select(before.columns)).withColumn(RUN, F.lit(load).cast("bigint"))
    where_they_are = [False] if about >= lake.bucket_rows else []
    lake.replace_parts(signed, feed_table(table), RUN, [*runs, load], *where_they_are)


def publish_silver(lake: Lake, table: str, rows: DataFrame, about: int) -> None:
    """Replace a silver table whole, with about so many rows. Its feed starts empty: sums of
    the events start over too."""
    name = f"silver.{table}"
    if not TABLES[table].events:
        lake.publish_buckets(rows, name, TABLES[table].keys, about)
        return
    first, *others = layouts(table)
    first.publish(lake, rows, about)
    for layout in others:  # many tasks read the new files, with few rows each: they are balanced
        layout.publish(lake, lake.read(name))
    lake.drop(feed_table(table))


def merge_silver(lake: Lake, table: str, batch: DataFrame, since: int, load: int) -> None:
    """Upsert a batch of cleaned rows, one per key, of the bronze loads after `since`, up to
    which silver is complete, and up to `load`. An empty batch leaves everything alone.
    Doing it again after a failure, also with more rows, ends the same."""
    name = f"silver.{table}"
    if not lake.exists(name):
        batch = batch.persist()
        publish_silver(lake, table, batch, batch.count())
        batch.unpersist()
        return
    held = batch.persist()
    about = held.count()
    # Each step of a merge reads the batch: a small one in few tasks.
    batch = held.coalesce(lake.spark.sparkContext.defaultParallelism) if about < lake.bucket_rows else held
    if about:
        if TABLES[table].events:
            for layout in layouts(table):
                if not lake.exists(layout.table):
                    layout.publish(lake, lake.read(name))
            for layout in layouts(table):
                layout.merge(lake, batch, since, load, about)
        else:
            lake.merge_buckets(batch, name, TABLES[table].keys)
    held.unpersist()


# --- dimensions -------------------------------------------------------------------------


def current_table(dimension: str) -> str:
    return f"gold.{dimension}__current"


def closed_table(dimension: str) -> str:
    return f"gold.{dimension}__closed"


def publish_dimension(lake: Lake, name: str, rows: DataFrame, load: int, about: int) -> None:
    """Replace a dimension whole, with about so many rows, as the load of that number. Type 2
    rows are all current ones: history starts over."""
    spec = DIMENSIONS[name]
    if not spec.tracked:
        lake.publish_buckets(rows, f"gold.{name}", [spec.natural_key], about)
        return
    lake.publish_buckets(rows, current_table(name), [spec.natural_key], about)
    lake.publish(lake.read(current_table(name)).limit(0), closed_table(name), RUN, F.lit(load).cast("bigint"))
    _show_versions(lake, name, load)


def _show_versions(lake: Lake, name: str, load: int) -> None:
    """The view of a type 2 dimension after a load; what later loads close is not seen yet."""
    columns = ", ".join(dimension_columns(DIMENSIONS[name]))
    current, closed = lake.live(current_table(name)), lake.live(closed_table(name))
    lake.unite(
        f"gold.{name}",
        f"SELECT {columns} FROM {current} UNION ALL SELECT {columns} FROM {closed} WHERE {RUN} <= {load}",
    )


def merge_dimension(lake: Lake, name: str, batch: DataFrame, run_ts: str | datetime, load: int) -> None:
    """Merge source rows, at most one per natural key, into a stored dimension, as the load of
    that number.

    Closed versions are written first and shown last, so a reader, or a failure in between,
    meets no version twice. Doing it again after a failure ends the same, also with more rows:
    what the load has closed stays in its partition unless it is still a current version.
    """
    spec = DIMENSIONS[name]
    if not spec.tracked:
        dim = lake.read(f"gold.{name}")
        rows = batch.select(spec.natural_key, *spec.attributes)
        rows = numbered_type1(dim, rows, spec.natural_key, spec.surrogate_key).persist()
        lake.merge_buckets(rows, f"gold.{name}", [spec.natural_key])
        rows.unpersist()
        return
    if not lake.exists(current_table(name)):  # written by other means
        _split_versions(lake, name, load - 1)
    # A current version has the highest surrogate key of its natural key, so the highest of all.
    current = lake.read(current_table(name))
    opened = opened_versions(current, batch, spec, run_ts, current.agg(F.max(spec.surrogate_key))).persist()
    written = lake.stored(closed_table(name)).filter(F.col(RUN) == load).drop(RUN)
    before = written.join(current.select(spec.surrogate_key), spec.surrogate_key, "left_anti")
    if not opened.isEmpty():
        closed = closed_versions(current, opened, spec, run_ts)
        lake.put_part(closed.unionByName(before), closed_table(name), RUN, load)
        lake.merge_buckets(opened, current_table(name), [spec.natural_key])
    opened.unpersist()
    _show_versions(lake, name, load)


def _split_versions(lake: Lake, name: str, load: int) -> None:
    """Store a dimension that lies in one table as current and closed versions."""
    whole, spec = lake.read(f"gold.{name}"), DIMENSIONS[name]
    lake.publish_buckets(whole.filter("is_current"), current_table(name), [spec.natural_key], whole.count())
    lake.publish(whole.filter("not is_current"), closed_table(name), RUN, F.lit(load).cast("bigint"))
