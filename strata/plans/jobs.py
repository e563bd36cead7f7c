"""Full load, incremental load and backfill over stored tables.

Order: bronze tables, silver tables, dimensions (items after content and warehouses),
facts. Every step writes its data before its mark, and running it again changes nothing: a
bronze load is a partition with a number of its own, the next after the last load that ended,
so that a retry replaces it and nothing else does; upserts and recomputed keys replace what
they find. A table that fails keeps its mark, while those that succeeded move on.

Later layers take in the bronze loads that they have not seen. A row without any time cannot
be found by a watermark: it is loaded when it is new or differs from its last landed version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.calendar import date_dimension, month_dimension
from strata.operators.clean import rows_of_keys
from strata.operators.upsert import replace_window
from strata.plans.dimensions import DRIVING_TABLE, dimension_batch, dimension_full
from strata.plans.facts import (
    FACT_SOURCES,
    GRAIN,
    STATES,
    calendar_only,
    fact_of_state,
    fact_state,
    fact_states,
    fact_split,
    new_natural_keys,
    of_affected,
    placed_items,
)
from strata.plans.silver import silver_full
from strata.plans.stored import (
    RETURNS,
    SIGN,
    changes_between,
    merge_dimension,
    merge_silver,
    publish_dimension,
    publish_silver,
)
from strata.functions import month_key
from strata.sources.directory import months_by
from strata.sources.extract import (
    changed_since,
    event_date_column,
    in_window,
    is_changed,
    snapshot_difference,
    timestamp,
    undated,
    window_extract,
    with_lineage,
)
from strata.sources.staging import stage, stage_rows
from strata.sources.tables import MONTH, RUN, Lake, observed
from strata.sources.watermarks import (
    CONTROL,
    NEVER,
    Mark,
    advanced,
    control_table,
    newest_update,
    stored_marks,
)
from strata.specs import DIMENSIONS, FIRST_DAY, LAST_DAY, LOOKED_UP_BY, TABLES

Source = Callable[[str], DataFrame]
Marks = dict[str, Mark]

# Items look up content and warehouses, so they come after them.
DIMENSION_WAVES = (
    ("dim_customer", "dim_content", "dim_subscription_plan", "dim_warehouse"),
    ("dim_inventory",),
)

@dataclass(frozen=True)
class Settings:
    source_system: str
    #: count only completed payments, or payments without a status; else all payments. The
    #: partial sums are of one kind: after a change, load the facts in full
    settled_only: bool = True
    #: a new address makes a new customer version
    include_child_changes: bool = False
    first_day: str = FIRST_DAY
    last_day: str = LAST_DAY
    #: refresh facts also for customers, titles and items that arrive after their events
    late_keys: bool = True
    #: affected keys up to this number, which is counted first, are broadcast to the event
    #: scans (about 32 bytes each); above it, events are aggregated first and joined by key
    broadcast_keys: int = 1_000_000
    #: tables loaded at the same time
    parallel: int = 4
    #: the operational tables to load, and the dimensions and facts to build from them
    tables: tuple[str, ...] = tuple(TABLES)
    gold: tuple[str, ...] = (*DIMENSIONS, *FACT_SOURCES)


def _each(lake: Lake, names: Iterable[str], load: Callable[[str], Marks], settings: Settings) -> None:
    """Load each table and advance the marks of those that succeed; then raise what failed."""
    with ThreadPoolExecutor(settings.parallel) as pool:
        running = [pool.submit(load, name) for name in names]
    marks: Marks = {}
    for done in running:
        if done.exception() is None:
            marks |= done.result()
    if marks:
        lake.publish(advanced(control_table(lake.spark, lake), marks), CONTROL)
    for done in running:
        done.result()


def _events_first(settings: Settings) -> list[str]:
    """The tables to load; those of events, which take longest, do not begin when others end."""
    return sorted(settings.tables, key=lambda t: not TABLES[t].events)


def _newest_of(df: DataFrame) -> tuple[DataFrame, Callable[[], datetime]]:
    """The rows, and after they were written once, the newest change among them."""
    seen = Observation()
    newest = F.greatest(F.max("created_at"), F.max("updated_at")).cast("string").alias("newest")
    marked = df.observe(seen, newest)

    def get() -> datetime:
        found = observed(seen).get("newest")
        return datetime.fromisoformat(found) if found else NEVER

    return marked, get


def _fact_month(fact: str) -> Column:
    if "month_key" in GRAIN[fact][0]:
        return F.col("month_key")
    return F.expr("date_key div 100").cast("int")


# --- bronze -----------------------------------------------------------------------------


def bronze_full_load(lake: Lake, source: Source, run_ts: str, settings: Settings) -> None:
    """Every source whole; the next silver load then starts from the beginning too."""
    stored = stored_marks(lake)

    def load(table: str) -> Marks:
        name = f"bronze.{table}"
        last = stored.get(name, Mark()).load
        rows, newest = _newest_of(with_lineage(source(table), run_ts, settings.source_system))
        lake.publish(rows, name, RUN, F.lit(last + 1).cast("bigint"), balanced=False)
        return {name: Mark(newest(), last + 1), f"silver.{table}": Mark(NEVER, last)}

    _each(lake, _events_first(settings), load, settings)


def _undated_changes(lake: Lake, rows: DataFrame, table: str) -> DataFrame:
    """Of rows without times, those that are new or differ from what bronze has of them."""
    if not lake.exists(f"bronze.{table}"):
        return rows
    landed = lake.stored(f"bronze.{table}").filter(undated())
    return snapshot_difference(rows, landed, TABLES[table].keys, RUN)


def bronze_incremental_load(lake: Lake, source: Source, run_ts: str, settings: Settings) -> None:
    """Add the source rows changed since the newest change in bronze, and of those that have
    no times the ones that differ from the last load's. What was loaded before stays."""
    stored = stored_marks(lake)

    def load(table: str) -> Marks:
        name = f"bronze.{table}"
        mark = stored.get(name, Mark())
        run = mark.load + 1
        # The source is read once; bronze is not opened if no row is without times.
        rows = source(table).filter(is_changed(mark.at) | undated()).persist()
        found, without = rows.agg(F.count(F.lit(1)), F.count_if(undated())).first()
        delta = changed_since(rows, mark.at)
        if without:
            delta = delta.unionByName(_undated_changes(lake, rows.filter(undated()), table))
        delta, newest = _newest_of(with_lineage(delta, run_ts, settings.source_system))
        lake.put_part(delta, name, RUN, run, found < lake.bucket_rows)
        rows.unpersist()
        return {name: Mark(max(mark.at, newest()), run)}

    _each(lake, _events_first(settings), load, settings)


def bronze_backfill(
    lake: Lake,
    source: Source,
    run_ts: str,
    start: str,
    end: str,
    settings: Settings,
    replace_all: bool = False,
) -> None:
    """Load the rows of a closed date range again, as a load of its own.

    With `replace_all` the tables then hold that range only. Otherwise its rows replace
    those of the same range in bronze, in the loads that hold some; a table without dates
    is replaced whole.
    """
    stored = stored_marks(lake)

    def load(table: str) -> Marks:
        name = f"bronze.{table}"
        mark = stored.get(name, Mark())
        run = mark.load + 1
        extract, newest = _newest_of(
            with_lineage(window_extract(source(table), start, end), run_ts, settings.source_system)
        )
        own = F.lit(run).cast("bigint")
        column = event_date_column(extract)
        if replace_all or column is None or not lake.exists(name):
            lake.publish(extract, name, RUN, own)
            return {name: Mark(newest(), run)}
        held = lake.stored(name)
        runs = [r[0] for r in held.filter(in_window(column, start, end)).select(RUN).distinct().collect()]
        held = held.filter(F.col(RUN).isin(runs))
        kept = replace_window(held, extract.withColumn(RUN, own), start, end)
        lake.replace_parts(kept, name, RUN, [*runs, run], held.count() < lake.bucket_rows)
        return {name: Mark(max(mark.at, newest()), run)}

    _each(lake, _events_first(settings), load, settings)


# --- silver -----------------------------------------------------------------------------


def silver_full_load(lake: Lake, settings: Settings) -> None:
    stored = stored_marks(lake)

    def load(table: str) -> Marks:
        bronze = lake.read(f"bronze.{table}")
        publish_silver(lake, table, silver_full(table, bronze, reread=True), about=bronze.count())
        newest = stored.get(f"bronze.{table}", Mark())
        return {f"silver.{table}": newest, _whole(table): newest}

    _each(lake, _events_first(settings), load, settings)


def _whole(table: str) -> str:
    """Control name of the load at which a silver table was last made whole."""
    return f"silver.{table}<whole"


def bronze_since(lake: Lake, table: str, mark: Mark) -> DataFrame:
    """The changed rows of the bronze loads after a mark; other loads' files are not opened."""
    unseen = lake.stored(f"bronze.{table}").filter(F.col(RUN) > mark.load).drop(RUN)
    return unseen.filter(is_changed(mark.at) | undated())


def silver_incremental_load(lake: Lake, settings: Settings) -> None:
    """Upsert the bronze rows of the loads that silver has not seen."""
    stored = stored_marks(lake)

    def load(table: str) -> Marks:
        mark = stored.get(f"silver.{table}", Mark())
        newest = stored.get(f"bronze.{table}", mark)
        batch = silver_full(table, bronze_since(lake, table, mark), reread=True)
        merge_silver(lake, table, batch, mark.load, newest.load)
        return {f"silver.{table}": newest}

    _each(lake, _events_first(settings), load, settings)


# --- gold -------------------------------------------------------------------------------


def _silver(lake: Lake, settings: Settings) -> dict[str, DataFrame]:
    """The silver tables; events keep their month, by which the facts skip partitions."""
    read = {t: (lake.stored if TABLES[t].events else lake.read)(f"silver.{t}") for t in settings.tables}
    return read | ({RETURNS: lake.stored(f"silver.{RETURNS}")} if "rental" in settings.tables else {})


def _drivers(dimension: str, settings: Settings) -> list[str]:
    """The silver tables whose changes make a dimension look at its rows again."""
    children = settings.include_child_changes and dimension == "dim_customer"
    return [DRIVING_TABLE[dimension], *(["customer_address"] if children else [])]


def _chosen(names: Iterable[str], settings: Settings) -> list[str]:
    return [n for n in names if n in settings.gold]


def _dims(lake: Lake) -> dict[str, DataFrame]:
    names = [*DIMENSIONS, "dim_date", "dim_month"]
    return {d: lake.read(f"gold.{d}") for d in names if lake.exists(f"gold.{d}")}


def _mark(gold: str, silver: str) -> str:
    """Control name of what a gold table has seen of a silver table.

    One mark per pair: tables reach different times, and one mark for all would pass over
    rows of a table that lags behind.
    """
    return f"gold.{gold}<{silver}"


def _seen(stored: Marks, gold: str, tables: Iterable[str]) -> Marks:
    return {_mark(gold, t): stored.get(f"silver.{t}", Mark()) for t in tables}


def _loaded(dimension: str, run_ts: str, load: int) -> Marks:
    """When a dimension was last brought up to date, and the number of that load. Younger
    dimension rows are new to a fact, and rows without times that were loaded since are new
    to a dimension."""
    return {f"gold.{dimension}": Mark(datetime.fromisoformat(run_ts), load)}


def _dated(rows: DataFrame, loaded: datetime) -> DataFrame:
    """Rows without times that were loaded after a dimension count as updated at their loading."""
    new = undated() & (F.col("load_timestamp") > timestamp(loaded))
    return rows.withColumn("updated_at", F.when(new, F.col("load_timestamp")).otherwise(F.col("updated_at")))


def gold_full_load(lake: Lake, run_ts: str, settings: Settings) -> None:
    lake.publish(date_dimension(lake.spark, settings.first_day, settings.last_day), "gold.dim_date")
    lake.publish(month_dimension(lake.spark, settings.first_day, settings.last_day), "gold.dim_month")
    silver, stored = _silver(lake, settings), stored_marks(lake)

    def dimension(name: str) -> Marks:
        load, about = stored.get(f"gold.{name}", Mark()).load + 1, silver[DRIVING_TABLE[name]].count()
        publish_dimension(lake, name, dimension_full(name, silver, _dims(lake), run_ts), load, about)
        return _seen(stored, name, _drivers(name, settings)) | _loaded(name, run_ts, load)

    for wave in DIMENSION_WAVES:
        _each(lake, _chosen(wave, settings), dimension, settings)
    _each(lake, _chosen(FACT_SOURCES, settings), lambda name: _build_fact(lake, name, silver, stored, run_ts, settings), settings)


def gold_incremental_load(lake: Lake, run_ts: str, settings: Settings) -> None:
    silver, stored = _silver(lake, settings), stored_marks(lake)

    def dimension(name: str) -> Marks:
        drivers, dim = _drivers(name, settings), lake.read(f"gold.{name}")
        marks = [stored.get(_mark(name, t)) for t in drivers]
        since = newest_update(dim) if None in marks else min(m.at for m in marks)
        last = stored.get(f"gold.{name}", Mark())
        read = silver | {t: _dated(silver[t], last.at) for t in drivers}
        if any(not changed_since(read[t], since).isEmpty() for t in drivers):
            batch = dimension_batch(name, read, _dims(lake), since, settings.include_child_changes)
            merge_dimension(lake, name, batch, run_ts, last.load + 1)
        return _seen(stored, name, drivers) | _loaded(name, run_ts, last.load + 1)

    def log(name: str) -> Marks:
        """A fact whose sources were made whole since is built anew."""
        seen = {t: stored.get(_mark(name, t), Mark()) for t in FACT_SOURCES[name]}
        if _logged(name) in stored and all(stored.get(_whole(t), Mark()).load <= seen[t].load for t in seen):
            return _log_changes(lake, name, stored, settings)
        return _build_fact(lake, name, silver, stored, run_ts, settings)

    for wave in DIMENSION_WAVES:
        _each(lake, _chosen(wave, settings), dimension, settings)
    facts = _chosen(FACT_SOURCES, settings)
    _each(lake, facts, log, settings)
    marks = stored_marks(lake)
    _each(lake, facts, lambda name: _refresh_fact(lake, name, silver, marks, run_ts, settings), settings)


# A fact is kept with the partial sums of its events, by month. A load first logs the signed
# sums of the change feeds that it has not seen, in a partition of its own number, and moves
# the marks of the feeds; then it adds the logged sums to the stored ones. A stored row says
# up to which number it has them, so that adding again after a failure changes nothing.

UPTO = "upto"

#: Items are told apart before they move if those looked up are less than this part of them.
FEW_ITEMS = 4


def _sums(fact: str, part: str) -> str:
    return f"gold.{fact}__{part}"


def _log_table(fact: str, part: str) -> str:
    return f"gold.{fact}__{part}_log"


def _logged(fact: str) -> str:
    """Control name of the number of the last logged changes of a fact."""
    return f"gold.{fact}<log"


def _key_month(fact: str, part: str) -> Column:
    bucket = STATES[fact][part][0][1]
    return F.col(bucket) if bucket == "month_key" else month_key(bucket)


def _build_fact(
    lake: Lake, name: str, silver: dict[str, DataFrame], stored: Marks, run_ts: str, settings: Settings
) -> Marks:
    """The partial sums from all events, and the fact from them."""
    number = stored.get(_logged(name), Mark()).load + 1
    upto = F.lit(number).cast("bigint")
    about = sum(silver[t].count() for t in FACT_SOURCES[name])
    held = {}
    for part, sums in fact_states(name, silver, settings.settled_only).items():
        lake.publish(sums.withColumn(UPTO, upto), _sums(name, part), MONTH, _key_month(name, part), about=about)
        held[part] = lake.read(_sums(name, part))
        lake.drop(_log_table(name, part))
    rows = fact_of_state(name, fact_state(name, held, silver.get("inventory_item")), silver, _dims(lake))
    lake.publish(rows, f"gold.{name}", MONTH, _fact_month(name), about=about)
    done = Mark(datetime.fromisoformat(run_ts), number)
    return _seen(stored, name, FACT_SOURCES[name]) | {f"gold.{name}": done, _logged(name): done}


def _log_changes(lake: Lake, name: str, stored: Marks, settings: Settings) -> Marks:
    """Log the signed sums of what the feeds have that the fact has not seen."""
    number = stored.get(_logged(name), Mark()).load + 1
    feeds = {
        t: changes_between(lake, t, stored[_mark(name, t)].load, stored.get(f"silver.{t}", Mark()).load)
        for t in FACT_SOURCES[name]
    }
    for part, sums in fact_states(name, feeds, settings.settled_only).items():
        lake.put_part(sums, _log_table(name, part), RUN, number)
    return _seen(stored, name, FACT_SOURCES[name]) | {_logged(name): Mark(NEVER, number)}


def _add_log(lake: Lake, name: str, part: str, applied: int, number: int) -> DataFrame:
    """Add the logged sums after `applied` to the stored ones; the keys that they are of.

    Stored sums that none are added to stay where they are, up to writing them again. Months
    in which all that is added comes to nothing, as after a load of the same rows, are left.
    """
    keys, measures = STATES[name][part]
    if not lake.exists(_log_table(name, part)):
        return lake.read(_sums(name, part)).select(*keys).limit(0)
    pending = lake.stored(_log_table(name, part)).filter(F.col(RUN) > applied)
    adds = reduce(lambda a, b: a | b, [F.coalesce(F.col(m), F.lit(0)) != 0 for m in measures])
    logged = stage(pending.groupBy(*keys).agg(F.max(adds).alias("_adds")))
    changed, moved = logged.select(*keys), logged.filter("_adds").select(*keys)
    months = [r[0] for r in moved.select(_key_month(name, part)).distinct().collect()]
    if months:
        held = lake.stored(_sums(name, part)).filter(F.col(MONTH).isin(months))
        touched, others = rows_of_keys(held, keys, moved)
        known = touched.select(*keys, UPTO)
        new = pending.filter(adds).join(known, list(keys), "left").filter(F.col(RUN) > F.coalesce(UPTO, F.lit(applied)))
        new = new.select(*keys, *measures, F.lit(number).cast("bigint").alias(UPTO), _key_month(name, part).alias(MONTH))
        every = touched.unionByName(new).groupBy(*keys, MONTH)
        added = every.agg(*[F.sum(m).cast(t).alias(m) for m, t in measures.items()], F.max(UPTO).alias(UPTO))
        lake.replace_parts(others.unionByName(added), _sums(name, part), MONTH, months)
    return changed


def _stored_sums(lake: Lake, name: str, part: str, months: Iterable[int] | None = None) -> DataFrame:
    sums = lake.stored(_sums(name, part))
    return sums if months is None else sums.filter(F.col(MONTH).isin(sorted(months)))


def _late_keys(
    lake: Lake, name: str, silver: dict[str, DataFrame], dims: dict[str, DataFrame], loaded: datetime, held: ExitStack
) -> list[DataFrame]:
    """Keys of events that were there before their customer, title or item.

    They are looked for among the stored sums, in the months that the directories list for
    the new ones; without new ones nothing is opened. What is persisted is let go with `held`.
    """
    def kept(df: DataFrame) -> DataFrame:
        held.callback(df.persist().unpersist)
        return df

    natural, bucket = GRAIN[name][0]
    found = []

    def months(table: str, column: str, keys: DataFrame) -> set[int]:
        return set(months_by(lake, f"silver.{table}", column, keys))

    new = kept(new_natural_keys(name, dims, loaded))
    tables = [*FACT_SOURCES[name], *([RETURNS] if "rental" in FACT_SOURCES[name] else [])]
    if not new.isEmpty():
        listed = set().union(*(months(t, natural, new) for t in tables if natural in LOOKED_UP_BY[t]))
        found.append(_stored_sums(lake, name, "state", listed).join(new, natural, "left_semi").select(natural, bucket))
    if "items" in STATES[name]:
        of_new = silver["inventory_item"].join(new, natural, "left_semi").select("inventory_id", "content_id")
        items = kept(placed_items(silver, loaded).unionByName(of_new).distinct())
        if not items.isEmpty():
            rented = _stored_sums(lake, name, "items", months("rental", "inventory_id", items)).join(items, "inventory_id")
            found.append(rented.select(natural, bucket))
    return found


def _items_of(items: DataFrame, named: DataFrame) -> DataFrame:
    """The items that `named` may have: of few of them, so that no others move to be looked up."""
    if named.count() * FEW_ITEMS > items.count():
        return items
    return rows_of_keys(items, ["inventory_id"], named)[0]


def _months_that_differ(old: DataFrame, new: DataFrame) -> list[int]:
    """The months in which two sets of fact rows are not the same."""
    signed = old.withColumn(SIGN, F.lit(-1)).unionByName(new.withColumn(SIGN, F.lit(1)))
    changed = signed.groupBy(*old.columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)
    return [r[0] for r in changed.select(MONTH).distinct().collect()]


def _refresh_fact(
    lake: Lake, name: str, silver: dict[str, DataFrame], marks: Marks, run_ts: str, settings: Settings
) -> Marks:
    """Add the logged changes to the stored sums and make the rows of their keys anew.

    No event is read but those of the change feeds, whose sums were logged. Only the months
    of the changed keys are read, and those rewritten in which a row made anew is another than
    before; their numbers and the number of keys come to the driver.
    """
    mark, number = marks[f"gold.{name}"], marks[_logged(name)].load
    dims = _dims(lake)
    changed = {part: _add_log(lake, name, part, mark.load, number) for part in STATES[name]}
    keys = list(GRAIN[name][0])
    affected = changed["state"].select(keys)
    if "items" in changed:
        titles = _items_of(silver["inventory_item"], changed["items"]).select("inventory_id", "content_id").dropna()
        affected = affected.unionByName(changed["items"].join(titles, "inventory_id").select(keys))
    with ExitStack() as held_back:
        for late in _late_keys(lake, name, silver, dims, mark.at, held_back) if settings.late_keys else []:
            affected = affected.unionByName(late.select(keys))
        affected = stage_rows(calendar_only(affected.distinct(), dims))
    month = F.col(keys[1]) if keys[1] == "month_key" else month_key(keys[1])
    found = affected.groupBy(month.alias("m")).count().collect()
    if found:
        months = [r["m"] for r in found]
        small = sum(r["count"] for r in found) <= settings.broadcast_keys
        wanted = F.broadcast(affected) if small else affected
        held = lake.stored(f"gold.{name}").filter(F.col(MONTH).isin(months))
        sums = {part: _stored_sums(lake, name, part, months) for part in STATES[name]}
        items = _items_of(silver["inventory_item"], sums["items"]) if "items" in sums else None
        state = fact_state(name, sums, items).join(wanted, keys, "left_semi")
        new = fact_of_state(name, state, *of_affected(name, silver, dims, affected, small))
        new = new.withColumn(MONTH, _fact_month(name)).select(*held.columns).persist()
        kept, old = fact_split(name, held, affected, dims)
        differing = _months_that_differ(old, new)
        if differing:
            here = F.col(MONTH).isin(differing)
            lake.replace_parts(kept.filter(here).unionByName(new.filter(here)), f"gold.{name}", MONTH, differing)
        new.unpersist()
    return {f"gold.{name}": Mark(datetime.fromisoformat(run_ts), number)}


# --- whole loads ------------------------------------------------------------------------


def full_load(lake: Lake, source: Source, run_ts: str, settings: Settings) -> None:
    """Everything from the source again. Keys and version history start over."""
    bronze_full_load(lake, source, run_ts, settings)
    silver_full_load(lake, settings)
    gold_full_load(lake, run_ts, settings)


def incremental_load(lake: Lake, source: Source, run_ts: str, settings: Settings) -> None:
    """What changed since the last load, through all layers."""
    bronze_incremental_load(lake, source, run_ts, settings)
    silver_incremental_load(lake, settings)
    gold_incremental_load(lake, run_ts, settings)


def backfill(
    lake: Lake,
    source: Source,
    run_ts: str,
    start: str,
    end: str,
    settings: Settings,
    replace_all: bool = False,
) -> None:
    """A date range into bronze again, then through silver and gold.

    With `replace_all` the warehouse is built again from that range alone. Otherwise only
    the keys in the range are cleaned again, from all their bronze rows, and merged into
    silver, and the facts of their days and months are recomputed. Dimensions take what
    changed since their last load as always, so their versions and keys stay; rows that the
    source no longer has stay in silver.
    """
    marks = stored_marks(lake)
    known = all(lake.exists(f"silver.{t}") for t in settings.tables)
    bronze_backfill(lake, source, run_ts, start, end, settings, replace_all)
    if replace_all or not known:
        silver_full_load(lake, settings)
        gold_full_load(lake, run_ts, settings)
        return

    def batch(table: str) -> DataFrame:
        bronze = lake.stored(f"bronze.{table}")
        own = marks.get(f"bronze.{table}", Mark()).load + 1
        keys = list(TABLES[table].keys)
        if event_date_column(bronze) is not None:
            bronze = bronze.join(bronze.filter(F.col(RUN) == own).select(*keys).distinct(), keys, "left_semi")
        return silver_full(table, bronze.drop(RUN))

    def merge(table: str) -> Marks:
        loads = [marks.get(f"{layer}.{table}", Mark()).load for layer in ("silver", "bronze")]
        merge_silver(lake, table, batch(table), loads[0], loads[1] + 1)
        return {}

    _each(lake, _events_first(settings), merge, settings)
    silver_incremental_load(lake, settings)
    gold_incremental_load(lake, run_ts, settings)
