"""Calendars, type 2 merges and point-in-time lookups on edge rows and against brute force."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strata.operators.calendar import date_dimension, month_dimension
from strata.operators.keys import with_surrogate_key
from strata.operators.scd2 import initial_versions, merge_versions
from strata.operators import timeline
from strata.operators.timeline import at_day, interval_timeline, version_timeline
from strata.plans.dimensions import dimension_batch, latest_address
from strata.sources.staging import stage
from strata.specs import DIMENSIONS

SPEC = DIMENSIONS["dim_content"]
SOURCE = ("content_id bigint, title string, release_date date, duration_minutes int, language string, "
          "age_rating string, created_at timestamp_ntz, updated_at timestamp_ntz")
END = date(9999, 12, 31)


def test_calendar(spark):
    days = {r["date_key"]: r for r in date_dimension(spark).collect()}
    assert len(days) == 5844
    assert days[20200229]["day_name"] == "Saturday"
    sunday = days[20210103]
    assert (sunday["day_name"], sunday["week_number"], sunday["year_number"]) == ("Sunday", 53, 2021)
    assert days[20351231]["quarter_number"] == 4 and 20360101 not in days
    months = [r["month_key"] for r in month_dimension(spark).orderBy("month_key").collect()]
    assert (len(months), months[0], months[-1]) == (192, 202001, 203512)


def content(spark, *rows):
    return spark.createDataFrame(
        [(i, title, release, minutes, lang, "PG", created, updated) for i, title, release, minutes, lang, created, updated in rows],
        SOURCE)


def first_load(spark, *rows):
    numbered = with_surrogate_key(content(spark, *rows), "content_key", ["content_id"])
    return stage(initial_versions(numbered, SPEC, "2024-01-02 00:00:00"))


def versions(dim, key):
    found = dim.filter(F.col("content_id") == key).orderBy("content_key").collect()
    return [(r["title"], r["effective_from"], r["effective_to"], r["is_current"]) for r in found]


def t(*a):
    return datetime(*a)


def test_type2(spark):
    c = t(2024, 1, 1)
    dim = first_load(
        spark,
        (1, "same", date(2023, 5, 5), 1, "en", c, c),
        (2, "a", None, 1, "en", c, c),
        (3, None, None, 1, "en", None, c),
        (4, "d", None, 1, "en", c, c),
        (5, "e", None, 1, "en", c, c),
    )
    assert versions(dim, 1) == [("same", date(2023, 5, 5), END, True)]
    assert versions(dim, 2) == [("a", date(2024, 1, 1), END, True)]
    assert versions(dim, 3) == [(None, date(2020, 1, 1), END, True)]

    batch = content(
        spark,
        (1, "same", date(2024, 6, 6), 1, "en", c, t(2024, 2, 1)),  # only an untracked column differs
        (2, None, None, 1, "en", c, t(2024, 2, 1)),  # value to NULL
        (3, "c", None, 1, "en", c, t(2024, 2, 1, 8)),  # NULL to value
        (4, "dd", None, 1, "en", t(2024, 2, 3), None),  # never updated
        (6, "f", None, 1, "en", c, t(2024, 2, 1)),  # new
    )
    merged = stage(merge_versions(dim, batch, SPEC, "2024-02-02 00:00:00"))
    assert versions(merged, 1) == [("same", date(2023, 5, 5), END, True)]
    feb, jan31 = date(2024, 2, 1), date(2024, 1, 31)
    assert versions(merged, 2) == [("a", date(2024, 1, 1), jan31, False), (None, feb, END, True)]
    assert versions(merged, 3) == [(None, date(2020, 1, 1), jan31, False), ("c", feb, END, True)]
    assert versions(merged, 4)[1] == ("dd", date(2024, 2, 3), END, True)
    assert versions(merged, 5) == [("e", date(2024, 1, 1), END, True)]
    assert versions(merged, 6) == [("f", feb, END, True)]
    keys = sorted(r[0] for r in merged.select("content_key").collect())
    assert keys == list(range(1, 10))
    assert merged.filter("not is_current and updated_at = timestamp_ntz '2024-02-02 00:00:00'").count() == 3

    again = merge_versions(merged, batch, SPEC, "2024-02-03 00:00:00")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)

    # a second change on the same day: the version in between is inverted and answers for no day
    late = content(spark, (2, "z", None, 1, "en", c, t(2024, 2, 1, 9)))
    twice = stage(merge_versions(merged, late, SPEC, "2024-02-04 00:00:00"))
    assert versions(twice, 2)[1] == (None, feb, jan31, False)
    look = spark.createDataFrame([(2, date(2024, 2, 1)), (2, jan31), (2, date(2020, 1, 1))], "content_id bigint, d date")
    found = at_day(look, version_timeline(twice, "content_id", "content_key", ["title"]), "content_id", F.col("d"))
    assert {r["d"]: r["title"] for r in found.collect()} == {date(2024, 2, 1): "z", jan31: "a", date(2020, 1, 1): "z"}


def test_new_versions_are_found_by_anti_join(spark):
    dim = first_load(spark, (1, "a", None, 1, "en", None, None))
    plan = merge_versions(dim, content(spark, (1, "b", None, 1, "en", None, None)), SPEC, "2024-01-02 00:00:00")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_latest_address(spark):
    schema = "address_id bigint, customer_id bigint, city_id bigint, updated_at timestamp_ntz"
    df = spark.createDataFrame([
        (1, 1, 10, t(2024, 1, 1)), (2, 1, 20, t(2024, 1, 1)), (3, 1, 30, None),
        (4, 2, 40, None), (5, 2, 50, None), (6, 3, 60, t(2024, 1, 1)),
    ], schema)
    assert {r[0]: r[1] for r in latest_address(df).collect()} == {1: 20, 2: 50, 3: 60}


@pytest.mark.parametrize("children", [False, True])
def test_address_change_makes_a_customer_change_on_request(spark, children):
    stamps = "created_at timestamp_ntz, updated_at timestamp_ntz"
    old, new = t(2024, 1, 1), t(2024, 3, 1)
    spec = DIMENSIONS["dim_customer"]
    own = [a for a in spec.attributes if a not in ("city", "country")]
    silver = {
        "customer": spark.createDataFrame([(1, *[None] * len(own), old, old), (2, *[None] * len(own), old, old)],
                                          "customer_id bigint, " + ", ".join(f"{a} string" for a in own) + ", " + stamps),
        "customer_address": spark.createDataFrame([(1, 1, 1, old, new), (2, 2, 1, old, old)],
                                                  "address_id bigint, customer_id bigint, city_id bigint, " + stamps),
        "city": spark.createDataFrame([(1, 1, "c")], "city_id bigint, country_id bigint, city_name string"),
        "country": spark.createDataFrame([(1, "l")], "country_id bigint, country_name string"),
    }
    batch = dimension_batch("dim_customer", silver, {}, t(2024, 2, 1), include_child_changes=children).collect()
    assert [(r["customer_id"], r["updated_at"], r["city"]) for r in batch] == ([(1, new, "c")] if children else [])


# --- timelines against brute force ------------------------------------------------------


def random_intervals(seed, sizes):
    rng = random.Random(seed)
    rows, sk = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            sk += 1
            start = date(2024, 1, 1) + timedelta(days=rng.randint(0, 90))
            end = start + timedelta(days=rng.randint(-4, rng.choice([3, 40])))
            rows.append((
                k, sk, None if rng.random() < 0.05 else start,
                rng.choice([end, end, end, END, None]), rng.random() < 0.2,
            ))
    return rows


DAYS = [date(2023, 12, 20) + timedelta(days=i) for i in range(140)]
SIZES = [1] * 20 + [2] * 20 + [3, 5, 9, 17] * 5 + [20, 32, 33, 64, 150, 400]


@pytest.mark.parametrize("seed", [1, 2])
def test_lookups_equal_brute_force(spark, seed):
    rows = random_intervals(seed, SIZES)
    dim = spark.createDataFrame(rows, "k bigint, sk bigint, effective_from date, effective_to date, is_current boolean")
    keys = range(len(SIZES) + 3)  # three keys the dimension does not know
    facts = spark.createDataFrame([(k, d) for k in keys for d in DAYS], "k bigint, d date")
    by_key = {k: [r for r in rows if r[0] == k] for k in keys}

    def holds(r, d):
        return r[2] is not None and r[3] is not None and r[2] <= d <= r[3]

    want = {(k, d): max(by_key[k], key=lambda r: (holds(r, d), r[4], r[1]))[1] for k in keys if by_key[k] for d in DAYS}
    got = at_day(facts, version_timeline(dim, "k", "sk"), "k", F.col("d")).collect()
    assert len(got) == len(want) and {(r["k"], r["d"]): r["sk"] for r in got} == want

    def active(r, d):
        return r[2] is not None and r[2] <= d and (r[3] is None or d <= r[3])

    want = {}
    for k in keys:
        for d in DAYS:
            found = [r for r in by_key[k] if active(r, d)]
            want[k, d] = max(found, key=lambda r: (r[2], r[1]))[1] if found else None
    timeline = interval_timeline(dim, "k", "effective_from", "effective_to", ["effective_from", "sk"], ["sk"])
    got = at_day(facts, timeline, "k", F.col("d"), "left").collect()
    assert len(got) == len(want) and {(r["k"], r["d"]): r["sk"] for r in got} == want


@pytest.mark.parametrize("few_keys", [True, False])
def test_versions_move_at_most_once_by_key(spark, monkeypatch, few_keys):
    """Lone versions stay where they are; with many keys of several, each row moves once."""
    schema = "k bigint, sk bigint, effective_from date, effective_to date, is_current boolean"
    lone = random_intervals(3, [1] * 30)
    plan = version_timeline(stage(spark.createDataFrame(lone, schema)), "k", "sk")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = random_intervals(4, [1] * 10 + [2, 5, 30])
    monkeypatch.setattr(timeline, "_BROADCAST", 1_000_000 if few_keys else 0)
    monkeypatch.setattr(timeline, "_TASK_ROWS", 1)
    found = version_timeline(stage(spark.createDataFrame(rows, schema)), "k", "sk")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(k" in plan
    versions = {k: [r for r in rows if r[0] == k] for k in range(13)}

    def rank(r, d):
        return r[2] is not None and r[3] is not None and r[2] <= d <= r[3], r[4], r[1]

    facts = spark.createDataFrame([(k, d) for k in versions for d in DAYS], "k bigint, d date")
    got = {(r["k"], r["d"]): r["sk"] for r in at_day(facts, found, "k", F.col("d")).collect()}
    assert got == {(k, d): max(versions[k], key=lambda r: rank(r, d))[1] for k in versions for d in DAYS}


def test_timeline_has_no_gap_and_no_overlap(spark):
    rows = random_intervals(5, [3, 40, 80])
    dim = spark.createDataFrame(rows, "k bigint, sk bigint, effective_from date, effective_to date, is_current boolean")
    found = version_timeline(dim, "k", "sk").orderBy("k", "valid_from").collect()
    for k in range(3):
        ranges = [(r["valid_from"], r["valid_to"]) for r in found if r["k"] == k]
        assert ranges[0][0] == -719162 and ranges[-1][1] == 2932896
        assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
