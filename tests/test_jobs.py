"""The jobs over stored tables: full, incremental in steps, re-runs and backfill."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs
from strata.plans.facts import FACT_SOURCES, GRAIN, fact_events
from strata.sources.tables import Lake
from strata.sources.watermarks import CONTROL, stored_marks
from strata.specs import DIMENSIONS, TABLES
from tests.warehouse_data import DAY0, rows

SETTINGS = jobs.Settings("test", first_day="2024-01-01", last_day="2024-02-29")
CUTS = [DAY0 + timedelta(days=d) for d in (20, 27, 60)]


@pytest.fixture(scope="module")
def data():
    return rows()


def source_until(spark, data, until: datetime):
    """The operational system at a time: the newest version of each row so far."""
    def source(table: str):
        spec = TABLES[table]
        newest: dict[tuple, dict] = {}
        for r in data[table]:
            key = tuple(r[k] for k in spec.keys)
            if r["updated_at"] < until and (key not in newest or r["updated_at"] > newest[key]["updated_at"]):
                newest[key] = r
        names = [c.split()[0] for c in spec.source_schema.split(", ")]
        return spark.createDataFrame([tuple(r[c] for c in names) for r in newest.values()], spec.source_schema)
    return source


def fact_by_natural_key(lake: Lake, name: str):
    """Fact rows with the natural id in place of surrogate keys that depend on load history."""
    keys, dim, surrogate = GRAIN[name]
    back = lake.read(f"gold.{dim}").select(surrogate, keys[0])
    fact = lake.read(f"gold.{name}").join(back, surrogate).drop(surrogate)
    if "subscription_plan_key" in fact.columns:
        plans = lake.read("gold.dim_subscription_plan").select(
            F.col("plan_key").alias("subscription_plan_key"), "plan_id")
        fact = fact.join(plans, "subscription_plan_key", "left").drop("subscription_plan_key")
    return sorted(fact.select(*sorted(fact.columns)).collect(), key=repr)


def stored(lake: Lake, table: str):
    df = lake.read(table)
    return sorted(df.select(*sorted(df.columns)).collect(), key=repr)


def test_steps_equal_full_load_and_rerun_changes_nothing(spark, data):
    whole, steps = Lake(spark, "whole_"), Lake(spark, "steps_")
    jobs.full_load(whole, source_until(spark, data, CUTS[-1]), "2024-03-01 00:00:00", SETTINGS)
    jobs.full_load(steps, source_until(spark, data, CUTS[0]), "2024-01-21 00:00:00", SETTINGS)
    for i, cut in enumerate(CUTS[1:]):
        jobs.incremental_load(steps, source_until(spark, data, cut), f"2024-02-0{i + 1} 00:00:00", SETTINGS)

    for t in TABLES:
        names = [c for c in TABLES[t].silver_columns if c != "load_timestamp"]
        get = [sorted(lake.read(f"silver.{t}").select(*names).collect(), key=repr) for lake in (whole, steps)]
        if TABLES[t].span is None:  # a row that turns invalid stays in silver in an incremental load
            assert get[0] == get[1], t
    for fact in GRAIN:
        if fact == "fact_inventory_daily_utilisation":
            continue
        assert fact_by_natural_key(whole, fact) == fact_by_natural_key(steps, fact), fact
        assert whole.read(f"gold.{fact}").count() > 20
    utilisation = [
        sorted(lake.read("gold.fact_inventory_daily_utilisation")
               .join(lake.read("gold.dim_inventory").select("inventory_key", "inventory_id"), "inventory_key")
               .select("inventory_id", "date_key", "rental_count", "return_count").collect())
        for lake in (whole, steps)
    ]
    assert utilisation[0] == utilisation[1] and utilisation[0]

    for name, spec in DIMENSIONS.items():
        dim = steps.read(f"gold.{name}")
        keys = [r[0] for r in dim.select(spec.surrogate_key).collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1)), name
        if spec.tracked:
            current = dim.filter("is_current").groupBy(spec.natural_key).count()
            assert current.filter("count > 1").isEmpty(), name
            assert current.count() == whole.read(f"gold.{name}").count(), name
            assert dim.count() > current.count(), name

    tables = [f"silver.{t}" for t in TABLES] + [f"gold.{t}" for t in (*DIMENSIONS, *GRAIN)]
    before = {t: stored(steps, t) for t in tables}
    jobs.incremental_load(steps, source_until(spark, data, CUTS[-1]), "2024-03-05 00:00:00", SETTINGS)
    assert {t: stored(steps, t) for t in tables} == before


def damaged(source, window):
    """The source without some sessions of the window."""
    lost = F.col("created_at").between(*window) & (F.col("stream_id") % 3 != 0)
    return lambda table: source(table).filter(~lost) if table == "streaming_session" else source(table)


def test_backfill(spark, data):
    lake, whole = Lake(spark, "fill_"), Lake(spark, "nofill_")
    src = source_until(spark, data, CUTS[-1])
    window = ("2024-01-10 00:00:00", "2024-01-15 00:00:00")
    jobs.full_load(whole, src, "2024-03-01 00:00:00", SETTINGS)
    jobs.full_load(lake, damaged(source_until(spark, data, CUTS[0]), window), "2024-01-21 00:00:00", SETTINGS)
    jobs.incremental_load(lake, damaged(src, window), "2024-03-01 00:00:00", SETTINGS)
    versions = lake.read("gold.dim_customer").filter("not is_current").count()
    assert versions > 0
    fact = "fact_customer_daily_activity"
    assert fact_by_natural_key(lake, fact) != fact_by_natural_key(whole, fact)

    jobs.backfill(lake, src, "2024-03-02 00:00:00", *window, SETTINGS)
    names = [c for c in TABLES["streaming_session"].silver_columns if c != "load_timestamp"]
    for layer in ("bronze", "silver"):
        rows_of = [sorted(x.read(f"{layer}.streaming_session").select(*names).distinct().collect(), key=repr) for x in (lake, whole)]
        assert rows_of[0] == rows_of[1], layer
    again = lake.read("bronze.streaming_session").filter("load_timestamp > timestamp_ntz '2024-03-01 12:00:00'")
    assert again.count() == lake.read("bronze.streaming_session").filter(F.col("created_at").between(*window)).count() > 0
    assert fact_by_natural_key(lake, fact) == fact_by_natural_key(whole, fact)
    assert lake.read("gold.dim_customer").filter("not is_current").count() == versions
    before = {t: stored(lake, t) for t in ("silver.rental", f"gold.{fact}", "gold.dim_customer")}
    jobs.incremental_load(lake, src, "2024-03-03 00:00:00", SETTINGS)
    assert {t: stored(lake, t) for t in before} == before

    jobs.backfill(lake, src, "2024-03-04 00:00:00", *window, SETTINGS, replace_all=True)
    assert lake.read("bronze.rental").count() == lake.read("bronze.rental").filter(F.col("created_at").between(*window)).count() > 0
    assert lake.read("bronze.country").count() == 0  # created before the window
    assert lake.read("gold.dim_customer").count() == 0


FEW = jobs.Settings("test", tables=("wishlist", "payment"), gold=())


def test_a_failed_source_and_a_retry_leave_bronze_equal_to_the_source(spark, data):
    lake = Lake(spark, "retry_")
    jobs.bronze_full_load(lake, source_until(spark, data, CUTS[0]), "2024-01-21 00:00:00", FEW)
    control = lake.read(CONTROL)
    src = source_until(spark, data, CUTS[-1])

    def failing(table: str):
        if table == "payment":
            raise OSError("source is away")
        return src(table)

    for hour in range(2):
        with pytest.raises(OSError):
            jobs.bronze_incremental_load(lake, failing, f"2024-03-01 0{hour}:00:00", FEW)
    marks = stored_marks(lake)
    assert marks["bronze.wishlist"] > marks["bronze.payment"]
    # A crash between the write and the mark: the next load starts from the old mark again.
    for _ in range(2):
        lake.publish(control, CONTROL)
        jobs.bronze_incremental_load(lake, src, "2024-03-01 03:00:00", FEW)
    for table in FEW.tables:
        keys = list(TABLES[table].keys)
        got = sorted(tuple(r) for r in lake.read(f"bronze.{table}").select(*keys, "updated_at").distinct().collect())
        assert lake.read(f"bronze.{table}").count() == len(got)
        assert {k[0] for k in got} == {r[keys[0]] for r in src(table).collect()}


def test_a_failed_write_keeps_the_rows_and_a_reader_outlives_publishes(spark):
    lake = Lake(spark, "safe_")
    lake.publish(spark.range(5), "silver.t")
    reader = lake.read("silver.t")
    with pytest.raises(Exception, match="broken"):
        lake.publish(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")), "silver.t")
    assert lake.read("silver.t").count() == 5
    for n in (6, 7, 8, 9):
        lake.publish(spark.range(n), "silver.t")
    assert reader.count() == 5 and lake.read("silver.t").count() == 9
    lake.keep_hours = 0
    lake.publish(lake.read("silver.t").union(spark.range(1)), "silver.t")
    lake.publish(spark.range(2), "silver.t")
    assert len(spark.sql("SHOW TABLES IN safe_silver LIKE 't__v*'").collect()) == 1
    assert lake.read("silver.t").count() == 2


def test_hourly_loads_skip_partitions(spark, data):
    lake = Lake(spark, "prune_")
    src = source_until(spark, data, CUTS[-1])
    jobs.full_load(lake, src, "2024-03-01 00:00:00", SETTINGS)

    def filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "PartitionFilters: [" in line and "PartitionFilters: []" not in line]

    since = stored_marks(lake)["silver.rental"]
    assert filters(jobs.bronze_since(lake, "rental", since))
    assert jobs.bronze_since(lake, "rental", since).count() == 0
    silver = jobs._silver(lake, SETTINGS)
    for fact in GRAIN:
        events = fact_events(fact, silver, months=[202401])
        returns = fact != "fact_content_monthly_performance"
        assert len(filters(events)) == len(FACT_SOURCES[fact]) + returns, fact
