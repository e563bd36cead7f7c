"""Column functions, dedup, spans and whole-table cleaning on edge rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import (
    date_key, lower_text, month_key, month_start, non_negative, title_text, trimmed_text, upper_text, within,
)
from strata.operators.clean import clean, latest_of_repeated, latest_version, newest_first, rows_of_keys
from strata.operators.measures import average
from strata.plans.silver import silver_incremental
from strata.specs import TABLES


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_text(spark):
    raw = ["  a b ", "", "   ", None, "a\tb", "\ta ", "ÉTÉ-x"]
    assert column(spark, raw, "string", trimmed_text) == ["a b", None, None, None, "a\tb", "\ta", "ÉTÉ-x"]
    assert column(spark, [" ab ", "  ", None], "string", upper_text) == ["AB", None, None]
    assert column(spark, [" AB@C ", "", None], "string", lower_text) == ["ab@c", None, None]


def test_title_starts_a_word_after_anything_but_letters_and_digits(spark):
    raw = ["o'brien-SMITH tv2go  x_y", "smart-tv 4k", " éva ÖZ", "", "  ", None, "a\tb", "'q"]
    want = ["O'Brien-Smith Tv2go  X_Y", "Smart-Tv 4k", "Éva Öz", None, None, None, "A\tB", "'Q"]
    assert column(spark, raw, "string", title_text) == want


def test_values(spark):
    money = [Decimal("-0.01"), Decimal("0.00"), Decimal("0.01"), None]
    assert column(spark, money, "decimal(10,2)", non_negative) == [None, Decimal("0.00"), Decimal("0.01"), None]
    rate = lambda x: within(x, 1, 5)
    assert column(spark, [0, 1, 5, 6, None], "int", rate) == [None, 1, 5, None, None]
    share = lambda x: within(x, 0, 100)
    values = [Decimal(v) for v in ("-1", "0", "100", "100.01")]
    assert column(spark, values, "decimal(5,2)", share) == [None, Decimal(0), Decimal(100), None]


def test_periods(spark):
    edge = [datetime(2024, 2, 29, 23, 59, 59), datetime(2024, 3, 1), None]
    assert column(spark, edge, "timestamp_ntz", lambda x: date_key(F.to_date(x))) == [20240229, 20240301, None]
    assert column(spark, edge, "timestamp_ntz", month_key) == [202402, 202403, None]
    starts = column(spark, [202002, 203512], "int", month_start)
    assert [str(d) for d in starts] == ["2020-02-01", "2035-12-01"]


def test_average_rounds_once(spark):
    # mean 1.004996: rounding to 4 decimals first would give 1.01
    df = spark.createDataFrame([("a", 251249, 250000), ("b", 2345, 1000), ("c", 0, 0), ("d", -2345, 1000)],
                               "k string, s bigint, n bigint")
    got = {r["k"]: r["m"] for r in df.filter("n > 0").groupBy("k").agg(average("s", "n").alias("m")).collect()}
    assert got == {"a": Decimal("1.00"), "b": Decimal("2.35"), "d": Decimal("-2.35")}
    none = spark.createDataFrame([("a", None, None)], "k string, s bigint, n bigint")
    assert none.groupBy("k").agg(average("s", "n")).first()[1] is None


def rows(spark, table, values):
    spec = TABLES[table]
    schema = spec.source_schema + ", load_timestamp timestamp_ntz, source_system string"
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple({"source_system": "s", **v}.get(n) for n in names) for v in values], schema)


T = [datetime(2024, 1, d) for d in range(1, 10)]


def test_latest_version_order(spark):
    df = rows(spark, "genre", [
        dict(genre_id=1, genre_name="old", updated_at=T[0], load_timestamp=T[5]),
        dict(genre_id=1, genre_name="new", updated_at=T[1], load_timestamp=T[0]),
        dict(genre_id=2, genre_name="early load", updated_at=T[1], load_timestamp=T[0]),
        dict(genre_id=2, genre_name="late load", updated_at=T[1], load_timestamp=T[1]),
        dict(genre_id=3, genre_name="no date", updated_at=None, load_timestamp=T[3]),
        dict(genre_id=3, genre_name="dated", updated_at=T[0], load_timestamp=T[0]),
        dict(genre_id=4, genre_name="only", updated_at=None, load_timestamp=T[0]),
        dict(genre_id=None, genre_name="no key", updated_at=T[0], load_timestamp=T[0]),
    ])
    got = {r["genre_id"]: r["genre_name"] for r in clean(df, TABLES["genre"]).collect()}
    assert got == {1: "New", 2: "Late Load", 3: "Dated", 4: "Only"}


def test_composite_key_needs_both_parts(spark):
    df = rows(spark, "content_artist", [
        dict(content_id=1, artist_id=None, role="x", updated_at=T[0], load_timestamp=T[0]),
        dict(content_id=None, artist_id=1, role="x", updated_at=T[0], load_timestamp=T[0]),
        dict(content_id=1, artist_id=1, role=" lead ", updated_at=T[0], load_timestamp=T[0]),
        dict(content_id=1, artist_id=1, role=" extra ", updated_at=T[1], load_timestamp=T[0]),
    ])
    assert [(r[0], r[1], r["role"]) for r in clean(df, TABLES["content_artist"]).collect()] == [(1, 1, "Extra")]


def ticket(i, opened, closed, updated, **more):
    return dict(ticket_id=i, opened_date=opened, closed_date=closed, updated_at=updated, created_at=updated,
                load_timestamp=T[0], **more)


def test_span_is_checked_after_the_dedup(spark):
    values = [
        ticket(1, T[1], T[0], T[0]),
        ticket(2, T[1], T[1], T[0]),
        ticket(3, None, T[0], T[0]),
        ticket(4, T[1], None, T[0]),
        ticket(5, None, None, T[0]),
        ticket(6, T[0], T[1], T[0], status="first"),
        ticket(6, T[3], T[1], T[4], status="inverted"),
    ]
    spec = TABLES["support_ticket"]
    full = clean(rows(spark, "support_ticket", values), spec)
    assert sorted(r[0] for r in full.collect()) == [2, 3, 4, 5]
    before = clean(rows(spark, "support_ticket", values[:-1]), spec)
    after = silver_incremental("support_ticket", before, rows(spark, "support_ticket", values), T[3])
    assert {r["ticket_id"]: r["status"] for r in after.collect() if r[0] == 6} == {6: "FIRST"}


def test_dedup_limits_rows_before_the_shuffle(spark):
    df = rows(spark, "genre", [dict(genre_id=1, updated_at=T[0], load_timestamp=T[0])])
    plan = latest_version(df, ["genre_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("table", list(TABLES))
def test_every_rule_names_a_column(table):
    spec = TABLES[table]
    assert set(spec.rules) | set(spec.keys) | set(spec.span or ()) <= set(spec.business_columns)


def test_whole_rows_of_lone_keys_do_not_move(spark):
    """Only keys that repeat, null ones among them, are ranked; the rows are those of the ranking."""
    given = [
        dict(genre_id=k, genre_name=n, updated_at=T[t], load_timestamp=T[0])
        for k, n, t in [(1, "lone", 0), (2, "old", 0), (2, "new", 2), (None, "old", 0), (None, "new", 1), (3, "lone", 1)]
    ]
    df = rows(spark, "genre", given)

    def found(df, **how):
        return sorted((r["genre_id"] or 0, r["genre_name"]) for r in latest_version(df, ["genre_id"], **how).collect())

    assert found(df, reread=True) == found(df) == [(0, "new"), (1, "lone"), (2, "new"), (3, "lone")]
    lone = latest_version(df.filter("genre_id in (1, 3)"), ["genre_id"], reread=True)
    plan = lone._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert [r[0] for r in lone.select("genre_name").collect()] == ["lone", "lone"]


def test_many_repeated_keys_are_all_ranked(spark, monkeypatch):
    monkeypatch.setattr("strata.operators.clean.FEW_REPEATED", 1)
    given = [dict(genre_id=k, updated_at=T[t], load_timestamp=T[0]) for k in (1, 2) for t in (0, 1)]
    latest = latest_version(rows(spark, "genre", given), ["genre_id"], reread=True)
    assert "Window" in latest._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in latest.select("genre_id", "updated_at").collect()) == [(1, T[1]), (2, T[1])]


def test_of_many_repeated_keys_only_marked_rows_are_ranked(spark, monkeypatch):
    """The same rows as by ranking all, and rows of lone keys stay where they are."""
    monkeypatch.setattr("strata.operators.clean.FEW_REPEATED", 1)
    given = [dict(genre_id=k, genre_name=str(t), updated_at=T[t], load_timestamp=T[0]) for k in range(400) for t in range(1 + k % 5 // 4)]
    df = rows(spark, "genre", given)

    def found(latest):
        return sorted((r["genre_id"], r["genre_name"]) for r in latest.collect())

    latest = latest_version(df, ["genre_id"], reread=True)
    assert found(latest) == found(latest_version(df, ["genre_id"])) == [(k, str(k % 5 // 4)) for k in range(400)]
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "bitmap_construct_agg" in plan


@pytest.mark.parametrize("few, many", [(100, 100), (1, 100), (1, 2)])
def test_rows_of_keys_are_told_apart_without_moving(spark, monkeypatch, few, many):
    """All rows of the wanted keys are on one side, each row is on one of them, whatever
    integer type the wanted keys have."""
    monkeypatch.setattr("strata.operators.clean.FEW_REPEATED", few)
    monkeypatch.setattr("strata.operators.clean.MANY_REPEATED", many)
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 2).alias("part"), F.lit("v").alias("v"))
    df = df.unionByName(df)
    wanted = spark.createDataFrame([(i, i % 2) for i in (3, 3, 8, 390, 401)], "k int, part bigint")
    touched, others = rows_of_keys(df, ["k", "part"], wanted)
    left, right = ([r["k"] for r in side.collect()] for side in (touched, others))
    assert sorted(left + right) == sorted([*range(400)] * 2)
    assert {3, 8, 390} <= set(left) and not set(left) & set(right)
    if many > 2:
        assert len(left) < 80
        plan = others._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_ranked_rows_are_kept_apart_from_lone_ones(spark):
    """Only the rows that were ranked go to `kept`."""
    given = [dict(genre_id=k, genre_name=str(t), updated_at=T[t], load_timestamp=T[0]) for k, t in [(1, 0), (2, 0), (2, 1)]]
    seen = []

    def kept(ranked):
        seen.append([(r["genre_id"], r["genre_name"]) for r in ranked.collect()])
        return ranked

    latest = latest_of_repeated(rows(spark, "genre", given), ["genre_id"], newest_first(), kept)
    assert sorted((r["genre_id"], r["genre_name"]) for r in latest.collect()) == [(1, "0"), (2, "1")]
    assert seen == [[(2, "1")]]
