"""Seeds, watermarks, windows, upserts, streaming bronze and intermediate tables."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.operators.keys import with_surrogate_key
from strata.operators.upsert import replace_window, upsert, upsert_type1
from strata.plans.facts import in_months
from strata.sources.extract import (
    changed_since, event_date_column, high_water_mark, read_seed, window_extract, with_lineage,
)
from strata.sources.staging import stage, stage_rows
from strata.sources.tables import MONTH, Lake, month_of
from strata.sources.watermarks import NEVER, newest_update
from strata.specs import SEED_TABLES, TABLES
from strata.streaming.ingest import bronze_stream, silver_upsert

T = [datetime(2024, 1, d) for d in range(1, 20)]
STAMPED = "id bigint, created_at timestamp_ntz, updated_at timestamp_ntz"


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_changed_is_strictly_after_the_watermark(spark):
    df = spark.createDataFrame(
        [(1, T[3], T[3]), (2, T[4], None), (3, T[0], T[4]), (4, None, None), (5, T[0], T[1])], STAMPED)
    assert ids(changed_since(df, T[3])) == [2, 3]


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, T[3], None), (2, None, T[2])], STAMPED)
    assert high_water_mark(df).first()[0] == T[3]
    assert high_water_mark(df.filter("id = 2")).first()[0] == T[2]
    assert high_water_mark(df.filter("id > 9")).first()[0] == NEVER
    assert newest_update(df) == T[2]
    assert newest_update(df.drop("updated_at")) == newest_update(df.filter("id = 1")) == NEVER


def test_changed_rows_are_filtered_in_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, T[3], T[3])], STAMPED).write.parquet(str(tmp_path / "t"))
    plan = changed_since(spark.read.parquet(str(tmp_path / "t")), T[0])._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [Or(GreaterThan(created_at" in plan.toString()


def test_window_is_closed_and_rows_without_date_stay(spark):
    df = spark.createDataFrame([(i, T[i], None) for i in range(6)] + [(9, None, T[3])], STAMPED)
    extract = window_extract(df, T[1], T[3])
    assert ids(extract) == [1, 2, 3]
    again = replace_window(df, extract.filter("id <> 2"), T[1], T[3])
    assert ids(again) == [0, 1, 3, 4, 5, 9]


def test_event_date_column(spark):
    df = spark.createDataFrame([], "review_date timestamp_ntz, start_time timestamp_ntz, id int")
    assert event_date_column(df) == "start_time"
    plain = spark.createDataFrame([(1,)], "id bigint")
    assert event_date_column(plain) is None
    assert ids(window_extract(plain, T[0], T[1])) == [1]
    assert ids(replace_window(plain, spark.createDataFrame([(2,)], "id bigint"), T[0], T[1])) == [2]


def test_upsert(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "a int, b int, v string")
    batch = spark.createDataFrame([(1, 2, "B"), (3, 3, "D")], "a int, b int, v string")
    once = upsert(target, batch, ["a", "b"])
    want = [(1, 1, "a"), (1, 2, "B"), (2, 1, "c"), (3, 3, "D")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, upsert(once, batch, ["a", "b"]).collect())) == want
    assert upsert(target, batch.limit(0), ["a", "b"]).count() == 3
    assert upsert(target.limit(0), batch, ["a", "b"]).count() == 2


def test_type1_keeps_keys(spark):
    dim = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k bigint, id bigint, name string")
    batch = spark.createDataFrame([(20, "B"), (30, None), (40, "d")], "id bigint, name string")
    got = {r["id"]: (r["k"], r["name"]) for r in upsert_type1(dim, batch, "id", "k").collect()}
    assert got[10] == (1, "a") and got[20] == (2, "B")
    assert {got[30][0], got[40][0]} == {3, 4}


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 64).alias("id"))
    got = {r["id"]: r["k"] for r in with_surrogate_key(df, "k", ["id"]).collect()}
    assert sorted(got.values()) == list(range(1, 5001))
    moved = with_surrogate_key(df.repartition(3), "k", ["id"])
    assert {r["id"]: r["k"] for r in moved.collect()} == got
    after = with_surrogate_key(df, "k", ["id"], start=spark.range(8).agg(F.max("id")))
    assert {r["id"]: r["k"] - 7 for r in after.collect()} == got
    empty = with_surrogate_key(df, "k", ["id"], start=spark.range(0).agg(F.max("id")))
    assert empty.agg(F.min("k")).first()[0] == 1


def test_in_months_merges_neighbours(spark):
    df = spark.createDataFrame([(datetime(2023, 12, 31),), (datetime(2024, 1, 31, 23, 59),), (datetime(2024, 4, 1),)],
                               "t timestamp_ntz")
    condition = in_months(F.col("t"), [202401, 202312, 202403])
    assert str(condition).count(">=") == 2
    assert df.filter(condition).count() == 2
    assert df.filter(in_months(F.col("t"), [])).count() == 0


@pytest.mark.parametrize("table", SEED_TABLES)
def test_seed_files(spark, tmp_path, table):
    """A seed file with a header, of any column types, reads with the table's schema."""
    names = [c.split() for c in TABLES[table].source_schema.split(", ")]
    text = {"string": "x y", "timestamp_ntz": "2023-05-01 20:12:43", "decimal(10,2)": "4.99"}
    header = ",".join(n for n, _ in names)
    (tmp_path / f"{table}.csv").write_text(header + "\n" + ",".join(text.get(t, "7") for _, t in names) + "\n")
    row = read_seed(spark, str(tmp_path), table).first()
    assert row["updated_at"] == datetime(2023, 5, 1, 20, 12, 43)
    assert row[TABLES[table].keys[0]] == 7


def lookups(spark, *values):
    return spark.createDataFrame(list(values), TABLES["wishlist"].source_schema)


def test_month_tables(spark):
    lake = Lake(spark, "mt_")
    first = with_lineage(lookups(spark, (1, 1, 1, T[0], T[0], T[0]), (2, 1, 1, T[0], datetime(2024, 2, 5), T[0]),
                                 (3, 1, 1, T[0], None, T[0])), T[0], "s")
    lake.publish(first, "silver.wishlist", MONTH, month_of("created_at"))
    # row 2 moves to another month and leaves its old one empty; row 3 gets a date
    batch = with_lineage(lookups(spark, (2, 2, 2, T[0], T[1], T[2]), (3, 2, 2, T[0], datetime(2024, 3, 5), T[2]),
                                 (4, 2, 2, T[0], T[1], T[2])), T[0], "s")
    placed = batch.withColumn(MONTH, month_of("created_at"))
    lake.merge(placed, "silver.wishlist", ["wishlist_id"], [202402, 0])
    got = {r["wishlist_id"]: r["customer_id"] for r in lake.read("silver.wishlist").collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2}
    assert lake.read("silver.wishlist").count() == 4
    lake.merge(placed.limit(0), "silver.wishlist", ["wishlist_id"], [])
    assert lake.read("silver.wishlist").count() == 4
    # one partition replaced, the others as they were; a partition without rows goes
    lake.replace_parts(batch.filter("wishlist_id = 4").withColumn(MONTH, F.lit(202401)), "silver.wishlist", MONTH, [202401, 202403])
    assert ids(lake.read("silver.wishlist"), "wishlist_id") == [4]


def test_new_rows_are_added_and_leave_files_alone(spark, monkeypatch):
    """A month that gets new keys only is not written again, until it lies in many small files."""
    monkeypatch.setattr("strata.sources.tables.FILES", 3)
    lake = Lake(spark, "nr_")

    def batch(i):
        given = with_lineage(lookups(spark, (i, i, 1, T[0], T[1], T[0])), T[0], "s")
        return given.withColumn(MONTH, month_of("added_date"))

    lake.publish(batch(0).drop(MONTH), "silver.wishlist", MONTH, month_of("added_date"))
    files = []
    for i in range(1, 6):
        lake.merge(batch(i), "silver.wishlist", ["wishlist_id"], [])
        files.append(set(lake.stored("silver.wishlist").inputFiles()))
        assert ids(lake.read("silver.wishlist"), "wishlist_id") == list(range(i + 1))
    assert files[0] < files[1] < files[2] and len(files[2]) == 4
    assert not files[2] & files[3] and len(files[3]) == 1
    assert files[3] < files[4]
    lake.merge(batch(2), "silver.wishlist", ["wishlist_id"], [202401])  # made again after a failure
    assert ids(lake.read("silver.wishlist"), "wishlist_id") == list(range(6))


def test_rows_of_large_tables_are_written_where_they_are(spark, monkeypatch):
    """A large table is written by as many tasks as it has rows for, without moving its rows."""
    monkeypatch.setattr("strata.sources.tables.TASK_ROWS", 100)
    rows = spark.range(0, 1200, 1, 24).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.lit(202401)).otherwise(202402).alias("m"))
    few = Lake(spark, "lw_", bucket_rows=1_000_000)
    large = Lake(spark, "lw_", bucket_rows=300)
    for lake, tasks in ((few, range(1, 3)), (large, range(12, 13))):
        lake.publish(rows, "gold.t", MONTH, F.col("m"), about=1200)
        files = [f for f in lake.stored("gold.t").inputFiles() if "202401" in f]
        assert len(files) in tasks
        # rows replaced by themselves, and one month that loses its rows
        again = lake.stored("gold.t").filter("m = 202401")
        lake.replace_parts(again, "gold.t", MONTH, [202401, 202402], about=1200)
        assert ids(lake.read("gold.t"), "k") == [*range(0, 1200, 3)]
    large.publish_buckets(rows.drop("m"), "gold.b", ["k"], 1200)
    assert large.buckets("gold.b") == 4 and ids(large.read("gold.b"), "k") == [*range(1200)]
    monkeypatch.setattr("strata.sources.tables.MOST_BUCKETS", 2)
    large.publish_buckets(rows.drop("m"), "gold.b", ["k"], 1200)
    assert len(large.read("gold.b").inputFiles()) == 4  # one each, so that they do not get too small


def test_large_partitions_are_replaced_where_the_rows_are(spark, monkeypatch):
    """How many rows they have is counted if it is not said."""
    monkeypatch.setattr("strata.sources.tables.TASK_ROWS", 50)
    lake = Lake(spark, "lp_", bucket_rows=100)
    lake.publish(spark.range(0, 800, 1, 24).withColumn("v", F.lit(1)), "gold.t", MONTH, F.col("id") % 2)
    lake.replace_parts(spark.range(0, 800, 1, 24).filter("id % 2 = 1").select("id", F.lit(2).alias("v"), F.lit(1).alias(MONTH)), "gold.t", MONTH, [1])
    assert len(lake.stored("gold.t").filter(F.col(MONTH) == 1).inputFiles()) == 8
    assert sorted(tuple(r) for r in lake.read("gold.t").collect()) == [(i, 1 + i % 2) for i in range(800)]


def test_joins_of_small_partitions_sort_none(spark, monkeypatch):
    Lake(spark, "hj_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = spark.range(1000).join(spark.range(500, 1500).withColumnRenamed("id", "k"), F.col("id") == F.col("k"))
        assert len(both.collect()) == 500
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan.partition("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_tables_can_read_themselves(spark):
    lake = Lake(spark, "st_")
    lake.publish(spark.range(3), "gold.numbers")
    for _ in range(3):
        lake.publish(lake.read("gold.numbers").withColumn("id", F.col("id") + 1), "gold.numbers")
    assert ids(lake.read("gold.numbers")) == [3, 4, 5]


def test_bronze_stream_takes_each_file_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for day in (1, 2):
        lookups(spark, (day, 1, 1, T[day], T[day], T[day])).write.mode("append").parquet(landing)
        for _ in range(2):  # the second run finds nothing new
            bronze_stream(spark, "wishlist", landing, target, checkpoint, "s").awaitTermination()
        assert ids(spark.read.parquet(target), "wishlist_id") == list(range(1, day + 1))
    assert {r["source_system"] for r in spark.read.parquet(target).collect()} == {"s"}
    assert Path(checkpoint).exists()


def test_silver_upsert_keeps_newer_rows(spark):
    lake = Lake(spark, "su_")
    start = with_lineage(lookups(spark, (1, 1, 1, T[0], T[0], T[5]), (2, 1, 1, T[0], T[0], T[5])), T[0], "s")
    empty = Lake(spark, "su0_")
    silver_upsert(empty, "wishlist")(start, 0)
    assert empty.read("silver.wishlist").count() == 2
    lake.publish(start, "silver.wishlist", MONTH, month_of("added_date"))
    batch = with_lineage(lookups(spark, (1, 7, 1, T[0], T[0], T[4]), (2, 8, 1, T[0], T[0], T[6]),
                                 (3, 9, 1, T[0], T[0], T[1])), T[1], "s")
    for epoch in (0, 0):
        silver_upsert(lake, "wishlist")(batch, epoch)
        got = {r["wishlist_id"]: r["customer_id"] for r in lake.read("silver.wishlist").collect()}
        assert got == {1: 1, 2: 8, 3: 9}


def test_stage(spark):
    df = spark.range(5).withColumn("d", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert stage(df).dtypes == df.dtypes and sorted(stage(df).collect()) == sorted(df.collect())


def test_rows_of_tables_are_written_small(spark):
    """Whole versions, rewritten partitions and staged rows have the codec of table rows."""
    def codecs(df):
        return {Path(f).name.split(".", 1)[1] for f in df.inputFiles()}

    lake, rows = Lake(spark, "cd_"), spark.range(10).withColumn("n", F.col("id") % 2)
    lake.publish(rows, "bronze.whole")
    lake.put_part(rows, "bronze.parts", MONTH, 1)
    lake.put_part(rows, "bronze.parts", MONTH, 2)
    lake.replace_parts(rows.withColumn(MONTH, F.lit(1)), "bronze.parts", MONTH, [1])
    for df in (lake.read("bronze.whole"), lake.stored("bronze.parts"), stage_rows(rows)):
        assert codecs(df) and all("zstd" in c for c in codecs(df))
