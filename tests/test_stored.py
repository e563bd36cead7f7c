"""Returns by their own month, rows without times, and directories of keys."""

from __future__ import annotations

import re
from contextlib import ExitStack
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs
from strata.plans.stored import layouts, merge_silver
from strata.sources.directory import AT, by_table, keys_table
from strata.sources.extract import snapshot_difference
from strata.sources.tables import MONTH, RUN, Lake
from strata.sources.watermarks import NEVER, stored_marks
from strata.specs import TABLES
from tests.test_jobs import fact_by_natural_key
from tests.warehouse_data import rows

FACT = "fact_inventory_daily_utilisation"
SMALL = jobs.Settings(
    "test", first_day="2024-01-01", last_day="2024-12-31", tables=("rental", "inventory_item", "content", "warehouse", "city"),
    gold=("dim_content", "dim_warehouse", "dim_inventory", FACT),
)


def table(spark, name, given):
    columns = [c.split()[0] for c in TABLES[name].source_schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in given], TABLES[name].source_schema)


def rental(i, item, rented, returned, updated):
    return {"rental_id": i, "customer_id": i % 4, "inventory_id": item, "rental_date": rented, "due_date": rented, "return_date": returned,
            "rental_fee": None, "late_fee": None, "status": "out", "created_at": datetime(2024, 1, 1), "updated_at": updated}


@pytest.fixture(scope="module")
def small():
    """One version of each row but for rentals."""
    given = rows()
    return {t: list({tuple(r[k] for k in TABLES[t].keys): r for r in given[t]}.values()) for t in SMALL.tables if t != "rental"}


def day(month, d=10):
    return datetime(2024, month, d)


FIRST = [
    rental(1, 1, day(5), day(3), day(6)),  # back before it was rented, says the source
    rental(2, 1, day(5), day(5, 20), day(6)),
    rental(3, 2, day(5), day(8), day(6)),
    rental(4, 3, day(2), None, day(6)),
    rental(5, 4, day(7), day(7), day(6)),
    rental(6, 5, None, day(4), day(6)),
]


@pytest.mark.parametrize(
    "later",
    [
        [rental(7, 1, day(3), None, day(9))],  # the return of rental 1 lies in an affected month
        [rental(7, 2, day(8), day(1), day(9))],
        [rental(4, 3, day(2), day(1), day(9)), rental(8, 9, day(9), day(9), day(9))],
        [rental(7, 5, day(4), day(12), day(9)), rental(9, 1, day(3), day(3), day(9))],
    ],
)
def test_returns_before_in_and_after_the_month_of_the_rental(spark, small, later, request):
    name = f"r{abs(hash(request.node.name)) % 10**8}_"
    steps, whole = Lake(spark, f"s{name}"), Lake(spark, f"w{name}")
    newest = list({r["rental_id"]: r for r in FIRST + later}.values())

    def source(rentals):
        return lambda t: table(spark, t, rentals if t == "rental" else small[t])

    jobs.full_load(steps, source(FIRST), "2024-09-01 00:00:00", SMALL)
    jobs.incremental_load(steps, source(newest), "2024-09-11 00:00:00", SMALL)
    jobs.full_load(whole, source(newest), "2024-09-11 00:00:00", SMALL)
    assert fact_by_natural_key(steps, FACT) == fact_by_natural_key(whole, FACT)
    for t in ("silver.rental", "silver.rental_return"):
        of = [sorted(map(tuple, lake.stored(t).drop("load_timestamp").collect()), key=repr) for lake in (steps, whole)]
        assert of[0] == of[1]
    returned = steps.stored("silver.rental_return")
    assert returned.filter(F.col(MONTH) != F.date_format("return_date", "yyyyMM").cast("int")).isEmpty()


def test_a_withdrawn_return_leaves_its_layout(spark):
    lake = Lake(spark, "withdrawn_")
    stamped = "load_timestamp", "source_system"
    get = lambda given: table(spark, "rental", given).withColumns({c: F.lit(None).cast("timestamp_ntz" if c == stamped[0] else "string") for c in stamped})
    merge_silver(lake, "rental", get(FIRST), -1, 0)
    merge_silver(lake, "rental", get([rental(3, 2, day(5), None, day(7)), rental(1, 1, day(5), day(11), day(7))]), 0, 1)
    found = {r["rental_id"]: r[MONTH] for r in lake.stored("silver.rental_return").collect()}
    assert found == {1: 202411, 2: 202405, 5: 202407, 6: 202404}


# --- rows without times -----------------------------------------------------------------

WISHES = jobs.Settings("test", tables=("wishlist", "city"), gold=())


def wish(i, title, at=None, added=day(2)):
    return {"wishlist_id": i, "customer_id": 1, "content_id": title, "added_date": added, "created_at": at, "updated_at": at}


def test_rows_without_times_stay_and_changes_are_picked_up(spark):
    lake = Lake(spark, "undated_")
    loads = [
        [wish(1, 10), wish(2, 20), wish(3, 30, day(3))],
        [wish(1, 11), wish(2, 20), wish(3, 30, day(3)), wish(4, None)],
        [wish(1, 10), wish(2, 20), wish(3, 31, day(4)), wish(4, 40), wish(5, 50)],
        [wish(1, 10), wish(2, 20), wish(3, 31, day(4)), wish(4, 40), wish(5, 50)],
    ]
    city = [{"city_id": 1, "country_id": 1, "city_name": n, "created_at": None, "updated_at": None} for n in ("a", "b", "b", "b")]
    landed = []
    for i, given in enumerate(loads):
        source = lambda t, given=given, i=i: table(spark, t, given if t == "wishlist" else [city[i]])
        at = f"2024-06-0{i + 1} 00:00:00"
        if i:
            jobs.bronze_incremental_load(lake, source, at, WISHES)
            jobs.silver_incremental_load(lake, WISHES)
        else:
            jobs.bronze_full_load(lake, source, at, WISHES)
            jobs.silver_full_load(lake, WISHES)
        held = lake.stored("bronze.wishlist")
        landed.append(sorted((r["wishlist_id"], r["content_id"] or 0, r[RUN]) for r in held.collect()))
        silver = sorted((r["wishlist_id"], r["content_id"]) for r in lake.read("silver.wishlist").collect())
        assert silver == sorted((r["wishlist_id"], r["content_id"]) for r in given)
        assert [r["city_name"] for r in lake.read("silver.city").collect()] == [city[i]["city_name"]]
    assert landed[0] == [(1, 10, 0), (2, 20, 0), (3, 30, 0)]
    assert landed[1] == sorted(landed[0] + [(1, 11, 1), (4, 0, 1)])
    assert landed[2] == sorted(landed[1] + [(1, 10, 2), (3, 31, 2), (4, 40, 2), (5, 50, 2)])
    assert landed[3] == landed[2]
    marks = stored_marks(lake)
    assert marks["bronze.city"].at == NEVER and marks["bronze.city"].load == 3

    jobs.bronze_backfill(lake, source, "2024-06-05 00:00:00", "2024-03-01 00:00:00", "2024-04-30 00:00:00", WISHES)
    after = sorted((r["wishlist_id"], r["content_id"] or 0) for r in lake.read("bronze.wishlist").collect())
    assert after == sorted([x[:2] for x in landed[2] if x[0] != 3 or x[1] == 31])
    # A retry of a load replaces its own partition and no other.
    jobs.bronze_incremental_load(lake, source, "2024-06-06 00:00:00", WISHES)
    assert sorted((r["wishlist_id"], r["content_id"] or 0) for r in lake.read("bronze.wishlist").collect()) == after


def test_snapshot_difference(spark):
    schema = "k bigint, a string, b string"
    landed = spark.createDataFrame([(1, "x", None, 0), (1, "y", None, 1), (2, "x", None, 0), (3, None, "x", 0), (None, "n", None, 0)], schema + ", part bigint")
    now = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "x", None), (4, None, None), (None, "n", None)], schema)
    got = sorted(map(tuple, snapshot_difference(now, landed, ["k"], "part").collect()))
    assert got == [(1, "x", None), (3, "x", None), (4, None, None)]
    assert snapshot_difference(now, landed.limit(0), ["k"], "part").count() == 5


def test_dimensions_take_rows_without_times(spark, small):
    lake = Lake(spark, "undated_dims_")

    def source(title):
        def get(t):
            given = [dict(r) for r in small[t]] if t != "rental" else FIRST
            if t == "content":
                for r in given:
                    r |= {"created_at": None, "updated_at": None}
                    if r["content_id"] == 1:
                        r["title"] = title
            return table(spark, t, given)
        return get

    jobs.full_load(lake, source("one"), "2024-09-01 00:00:00", SMALL)
    for hour, title in enumerate(("one", "two", "two"), 1):
        jobs.incremental_load(lake, source(title), f"2024-09-01 0{hour}:00:00", SMALL)
    found = lake.read("gold.dim_content").filter("content_id = 1").orderBy("effective_to").collect()
    assert [(r["title"], r["is_current"]) for r in found] == [("one", False), ("two", True)]
    assert found[1]["effective_from"].isoformat() == "2024-09-01"
    assert lake.read("gold.dim_content").count() == len(small["content"]) + 1


# --- directories ------------------------------------------------------------------------


def opened_months(df):
    """The months that the scans of month tables are limited to."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [set(re.findall(r"\b20\d{4}\b", line)) for line in re.findall(r"PartitionFilters: \[[^\]]*part_month[^\]]*\]", plan)]


def test_merges_read_listed_months_only(spark, monkeypatch):
    lake = Lake(spark, "listed_")
    given = [wish(i, i % 7, day(1), day(i % 9 + 1)) for i in range(200)]
    stamps = {"load_timestamp": F.lit(None).cast("timestamp_ntz"), "source_system": F.lit("x")}
    merge_silver(lake, "wishlist", table(spark, "wishlist", given).withColumns(stamps), -1, 0)
    read = []
    monkeypatch.setattr(Lake, "replace_parts", lambda self, df, t, part, values, real=Lake.replace_parts: (t.endswith("__changes") or read.append((t, sorted(values))), real(self, df, t, part, values))[1])
    moved = [wish(4, 99, day(2), day(12)), wish(1000, 3, day(2), day(3))]  # wish 4 lay in May
    merge_silver(lake, "wishlist", table(spark, "wishlist", moved).withColumns(stamps), 0, 1)
    assert ("silver.wishlist", [202403, 202405, 202412]) in read
    assert lake.read("silver.wishlist").count() == 201
    assert lake.read("silver.wishlist").filter("wishlist_id = 4").first()["content_id"] == 99
    read.clear()
    merge_silver(lake, "wishlist", table(spark, "wishlist", [wish(5, 5, day(3), day(6))]).withColumns(stamps), 1, 2)
    assert read == [("silver.wishlist", [202406])]  # known key, known month: the directories stay
    read.clear()
    merge_silver(lake, "wishlist", table(spark, "wishlist", []).withColumns(stamps), 2, 3)
    assert read == []
    rows_of = lake.stored("silver.wishlist")
    for directory, entry, of in ((keys_table, ["wishlist_id", AT], ["wishlist_id", MONTH]), (lambda t: by_table(t, "content_id"), ["content_id", MONTH], ["content_id", MONTH])):
        listed = {tuple(r) for r in lake.stored(directory("silver.wishlist")).select(*entry).collect()}
        assert {tuple(r) for r in rows_of.select(*of).collect()} <= listed


def test_rows_added_before_a_failure_are_there_once(spark, monkeypatch):
    """New keys are added as further files; a load that failed behind any of them is made again."""
    stamps = {"load_timestamp": F.lit(None).cast("timestamp_ntz"), "source_system": F.lit("x")}
    wishes = lambda *given: table(spark, "wishlist", list(given)).withColumns(stamps)
    name, new = "silver.wishlist", [wish(7, 8, day(2), day(3)), wish(8, 9, day(2), day(4))]
    for n, failing in enumerate((keys_table(name), by_table(name, "content_id"), name)):
        lake = Lake(spark, f"added{n}_")
        merge_silver(lake, "wishlist", wishes(wish(1, 1, day(1), day(3))), -1, 0)

        def then_fail(self, rows, t, *rest, write=Lake.add_rows, failing=failing):
            write(self, rows, t, *rest)
            if t == failing:
                raise OSError("lost")

        with monkeypatch.context() as patched:
            patched.setattr(Lake, "add_rows", then_fail)
            with pytest.raises(OSError):
                merge_silver(lake, "wishlist", wishes(*new), 0, 1)
        merge_silver(lake, "wishlist", wishes(*new), 0, 1)
        assert sorted(r["wishlist_id"] for r in lake.read(name).collect()) == [1, 7, 8], failing
        assert sorted(tuple(r) for r in lake.stored(keys_table(name)).select("wishlist_id", AT).collect()) == [(1, 202403), (7, 202403), (8, 202404)]
        assert sorted((r["wishlist_id"], r["_sign"]) for r in lake.stored(f"{name}__changes").collect()) == [(7, 1), (8, 1)], failing


def test_late_keys_open_listed_months_or_nothing(spark, small):
    lake = Lake(spark, "late_")
    source = lambda t: table(spark, t, FIRST if t == "rental" else small[t])
    jobs.full_load(lake, source, "2024-09-01 00:00:00", SMALL)
    silver, dims, held = jobs._silver(lake, SMALL), jobs._dims(lake), ExitStack()
    assert jobs._late_keys(lake, FACT, silver, dims, datetime(2024, 9, 1), held) == []
    new = {**dims, "dim_inventory": dims["dim_inventory"].filter("inventory_id = 1")}
    (late,) = jobs._late_keys(lake, FACT, silver, new, datetime(2024, 8, 31), held)
    assert opened_months(late) == [{"202403", "202405"}]
    assert sorted(str(r["activity_date"]) for r in late.collect()) == ["2024-03-10", "2024-05-10", "2024-05-20"]
    held.close()


# --- change feeds and partial sums ------------------------------------------------------


def changes(lake):
    return sorted((r[RUN], r["rental_id"], r["inventory_id"], r["_sign"]) for r in lake.stored("silver.rental__changes").collect())


def test_moved_events_correct_themselves_and_no_history_is_read(spark, small, monkeypatch):
    steps, whole = Lake(spark, "moved_"), Lake(spark, "unmoved_")
    moves = [rental(2, 5, day(6), day(5, 20), day(9)), rental(3, 2, day(5), None, day(9)), rental(5, 4, None, None, day(9)), rental(9, 7, day(1), day(1), day(9))]
    newest = list({r["rental_id"]: r for r in FIRST + moves}.values())
    source = lambda rentals: lambda t: table(spark, t, rentals if t == "rental" else small[t])
    jobs.full_load(steps, source(FIRST), "2024-09-01 00:00:00", SMALL)
    jobs.bronze_incremental_load(steps, source(newest), "2024-09-11 00:00:00", SMALL)
    jobs.silver_incremental_load(steps, SMALL)
    assert [c[1:] for c in changes(steps)] == sorted([(2, 1, -1), (2, 5, 1), (3, 2, -1), (3, 2, 1), (5, 4, -1), (5, 4, 1), (9, 7, 1)])
    written = []
    monkeypatch.setattr(Lake, "replace_parts", lambda self, df, t, part, values, real=Lake.replace_parts: (written.append((t, df)), real(self, df, t, part, values))[1])
    jobs.gold_incremental_load(steps, "2024-09-11 00:00:00", SMALL)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for t, df in written if FACT in t]
    assert len(plans) == 2 and not any(re.search(r"silver\.rental(__v|_return)", p) for p in plans)
    jobs.full_load(whole, source(newest), "2024-09-11 00:00:00", SMALL)
    assert fact_by_natural_key(steps, FACT) == fact_by_natural_key(whole, FACT)


def test_changes_are_added_once_whatever_fails(spark, small, monkeypatch):
    """A failure after each write of a load, and then a later load with more changes."""
    whole = Lake(spark, "once_whole_")
    second = [rental(2, 5, day(6), day(5, 20), day(9)), rental(9, 7, day(1), day(1), day(9))]
    third = [rental(2, 6, day(6), None, day(10)), rental(9, 7, day(2), day(1), day(10)), rental(10, 1, day(5), day(3), day(10))]
    at = [FIRST, list({r["rental_id"]: r for r in FIRST + second}.values()), list({r["rental_id"]: r for r in FIRST + second + third}.values())]
    source = lambda n: lambda t: table(spark, t, at[n] if t == "rental" else small[t])
    jobs.full_load(whole, source(2), "2024-09-13 00:00:00", SMALL)
    want = fact_by_natural_key(whole, FACT)
    for failing in ("silver.rental__changes", "silver.rental", "silver.rental_return", f"gold.{FACT}__state_log", f"gold.{FACT}__state", f"gold.{FACT}"):
        lake = Lake(spark, f"once{failing.replace('.', '_')}_")
        jobs.full_load(lake, source(0), "2024-09-01 00:00:00", SMALL)

        def then_fail(write, failing=failing):
            def written(self, df, t, *rest):
                write(self, df, t, *rest)
                if t == failing:
                    raise OSError("lost")
            return written

        with monkeypatch.context() as patched:
            for method in ("replace_parts", "put_part"):  # the first log of a fact makes its table
                patched.setattr(Lake, method, then_fail(getattr(Lake, method)))
            with pytest.raises(OSError):
                jobs.incremental_load(lake, source(1), "2024-09-12 00:00:00", SMALL)
        jobs.incremental_load(lake, source(2), "2024-09-13 00:00:00", SMALL)
        assert fact_by_natural_key(lake, FACT) == want, failing


def test_months_that_a_load_does_not_change_are_not_rewritten(spark, small, monkeypatch):
    """A backfill of the same rows leaves sums and facts alone, one of a moved rental its other months."""
    lake, whole, window = Lake(spark, "alone_", bucket_rows=len(FIRST)), Lake(spark, "alone_whole_"), ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    moved = [rental(4, 3, day(3), None, day(6)) if r["rental_id"] == 4 else r for r in FIRST]
    source = lambda rentals: lambda t: table(spark, t, rentals if t == "rental" else small[t])
    files = lambda t: {f for f in lake.stored(t).inputFiles()}
    jobs.full_load(lake, source(FIRST), "2024-09-01 00:00:00", SMALL)
    stored = [f"gold.{FACT}", f"gold.{FACT}__state"]
    before, put = {t: files(t) for t in stored}, []
    with monkeypatch.context() as patched:
        patched.setattr(Lake, "replace_parts", lambda self, df, t, *rest, real=Lake.replace_parts: (put.append((t, rest)), real(self, df, t, *rest))[1])
        jobs.backfill(lake, source(FIRST), "2024-09-02 00:00:00", *window, SMALL)
    assert {t: files(t) for t in stored} == before
    assert [rest[2] for t, rest in put if t == "bronze.rental"] == [False]  # a large load does not move
    again = lake.read("silver.rental").filter("load_timestamp > timestamp_ntz '2024-09-01 12:00:00'")
    assert again.count() == len(FIRST)

    jobs.backfill(lake, source(moved), "2024-09-03 00:00:00", *window, SMALL)
    for t in stored:
        assert {f for f in files(t) ^ before[t] if not re.search("=20240[23]/", f)} == set() and files(t) != before[t]
    jobs.full_load(whole, source(moved), "2024-09-03 00:00:00", SMALL)
    assert fact_by_natural_key(lake, FACT) == fact_by_natural_key(whole, FACT)


def test_layouts():
    assert [x.table for x in layouts("rental")] == ["silver.rental", "silver.rental_return"]
    assert [x.table for x in layouts("payment")] == ["silver.payment"]


def test_a_load_reads_its_source_once(spark):
    lake, read = Lake(spark, "once_"), spark.sparkContext.accumulator(0)
    settings = jobs.Settings("test", tables=("wishlist",), gold=())

    def seen(_):
        read.add(1)
        return True

    def source(name):
        return table(spark, name, [wish(1, 10, day(2)), wish(2, 20)]).filter(F.udf(seen, "boolean")("wishlist_id"))

    jobs.bronze_full_load(lake, source, "2024-06-01 00:00:00", settings)
    assert read.value == 2
    jobs.bronze_incremental_load(lake, source, "2024-06-02 00:00:00", settings)
    assert read.value == 3  # the row without times, once; the other is no change
    assert lake.read("bronze.wishlist").count() == 2
