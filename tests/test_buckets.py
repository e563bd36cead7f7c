"""Tables in buckets of keys, and type 2 dimensions with their history apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators.scd2 import merge_versions
from strata.operators.upsert import upsert_type1
from strata.plans.stored import closed_table, current_table, merge_dimension, publish_dimension
from strata.sources.tables import BUCKET, RUN, Lake, bucket_of
from strata.specs import DIMENSIONS

PLANS = DIMENSIONS["dim_subscription_plan"]


def files(df):
    return set(df.inputFiles())


def ordered(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_a_batch_of_one_key_rewrites_one_bucket(spark):
    lake = Lake(spark, "buckets_", bucket_rows=8)
    rows = spark.range(60).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    lake.publish_buckets(rows, "silver.t", ["k"], rows.count())
    assert lake.buckets("silver.t") == 8 and lake.read("silver.t").columns == ["k", "v"]
    before, at = files(lake.stored("silver.t")), lake.live("silver.t")
    # The same bucket for a key of another integer type.
    lake.merge_buckets(spark.sql("SELECT 7 AS k, 'new' AS v"), "silver.t", ["k"])
    after = files(lake.stored("silver.t"))
    touched = {f.split(f"{BUCKET}=")[1].split("/")[0] for f in before ^ after}
    assert len(touched) == 1 and lake.live("silver.t") == at
    assert ordered(lake.read("silver.t")) == sorted(((i, "new" if i == 7 else "old") for i in range(60)), key=repr)
    assert lake.stored("silver.t").filter(F.col(BUCKET) != bucket_of(["k"], 8)).isEmpty()

    lake.merge_buckets(rows.limit(0), "silver.t", ["k"])
    assert files(lake.stored("silver.t")) == after
    # Twice as many rows as the buckets are for: as many buckets as they ask for.
    more = spark.range(40, 400).select(F.col("id").alias("k"), F.lit("more").alias("v"))
    lake.merge_buckets(more, "silver.t", ["k"])
    assert lake.buckets("silver.t") > 8
    assert lake.read("silver.t").groupBy("v").count().collect() and lake.read("silver.t").count() == 400
    assert lake.stored("silver.t").filter(F.col(BUCKET) != bucket_of(["k"], lake.buckets("silver.t"))).isEmpty()


def test_a_small_table_is_replaced_whole(spark):
    lake = Lake(spark, "onebucket_")
    lake.publish_buckets(spark.sql("SELECT 1 AS k, 'a' AS v"), "silver.t", ["k"], 1)
    at = lake.live("silver.t")
    lake.merge_buckets(spark.sql("SELECT * FROM VALUES (1, 'b'), (2, 'c') AS t(k, v)"), "silver.t", ["k"])
    assert lake.buckets("silver.t") == 1 and lake.live("silver.t") != at
    assert ordered(lake.stored("silver.t")) == [(1, "b"), (2, "c")]


def plans(spark, given, at):
    rows = spark.createDataFrame(given, "plan_id bigint, plan_name string")
    others = [F.lit(None).cast("string").alias(c) for c in PLANS.attributes if c != "plan_name"]
    times = [F.lit(at).cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at")]
    return rows.select("plan_id", "plan_name", *others, *times)


def first_versions(spark, given):
    return merge_versions(_no_versions(spark), plans(spark, given, "2024-01-01 00:00:00"), PLANS, "2024-01-02 00:00:00")


def _no_versions(spark):
    names = ", ".join(f"{c} string" for c in PLANS.attributes)
    validity = "effective_from date, effective_to date, created_at timestamp_ntz, updated_at timestamp_ntz, is_current boolean"
    return spark.createDataFrame([], f"{PLANS.surrogate_key} bigint, plan_id bigint, {names}, {validity}")


BATCHES = [
    [(1, "a"), (5, "changed"), (31, "new")],
    [(5, "again"), (2, "x"), (31, "new")],
    [(40, None), (2, None)],
]


def test_a_load_writes_changed_keys_only_and_leaves_history_alone(spark):
    lake, name = Lake(spark, "history_", bucket_rows=4), "dim_subscription_plan"
    want = first_versions(spark, [(i, "a") for i in range(30)])
    publish_dimension(lake, name, want, 0, 30)
    assert lake.buckets(current_table(name)) == 8
    for load, given in enumerate(BATCHES, start=1):
        batch, at = plans(spark, given, f"2024-0{load + 1}-01 00:00:00"), f"2024-0{load + 1}-02 00:00:00"
        want = merge_versions(want, batch, PLANS, at)
        history, current = files(lake.stored(closed_table(name))), files(lake.stored(current_table(name)))
        merge_dimension(lake, name, batch, at, load)
        assert history <= files(lake.stored(closed_table(name)))
        assert len(current - files(lake.stored(current_table(name)))) <= len(given)
        assert ordered(lake.read(f"gold.{name}")) == ordered(want)
    assert {r[0] for r in lake.stored(closed_table(name)).select(RUN).distinct().collect()} == {1, 2, 3}


@pytest.mark.parametrize("failing", [closed_table, current_table])
def test_a_load_that_failed_is_made_again(spark, monkeypatch, failing):
    name = "dim_subscription_plan"
    lake = Lake(spark, f"again_{failing.__name__}_", bucket_rows=4)
    start = first_versions(spark, [(i, "a") for i in range(30)])
    publish_dimension(lake, name, start, 0, 30)
    first, second = ([(1, "b"), (2, "b"), (50, "b")], "2024-02-01 00:00:00"), ([(2, "c"), (3, "c"), (1, "b")], "2024-03-01 00:00:00")
    merge_dimension(lake, name, plans(spark, [(9, "z")], "2024-01-20 00:00:00"), "2024-01-21 00:00:00", 1)
    shown = ordered(lake.read(f"gold.{name}"))

    def then_fail(write):
        def written(self, df, table, *rest):
            write(self, df, table, *rest)
            if table == failing(name):
                raise OSError("lost")
        return written

    with monkeypatch.context() as patched:
        patched.setattr(Lake, "replace_parts", then_fail(Lake.replace_parts))
        patched.setattr(Lake, "put_part", then_fail(Lake.put_part))
        with pytest.raises(OSError):
            merge_dimension(lake, name, plans(spark, *first), "2024-02-02 00:00:00", 2)
    left = ordered(lake.read(f"gold.{name}"))
    assert left == shown if failing is closed_table else len({r for r in left}) == len(left)
    # The load is made again, with the changes since.
    for given, at in (first, second):
        merge_dimension(lake, name, plans(spark, given, at), "2024-02-02 00:00:00", 2)
    want = merge_versions(start, plans(spark, [(9, "z")], "2024-01-20 00:00:00"), PLANS, "2024-01-21 00:00:00")
    for given, at in (first, second):
        want = merge_versions(want, plans(spark, given, at), PLANS, "2024-02-02 00:00:00")
    assert ordered(lake.read(f"gold.{name}")) == ordered(want)


def test_a_dimension_in_one_table_is_split_by_its_first_load(spark):
    lake, name = Lake(spark, "oneway_"), "dim_subscription_plan"
    start = first_versions(spark, [(1, "a"), (2, "a")])
    start = merge_versions(start, plans(spark, [(1, "b")], "2024-02-01 00:00:00"), PLANS, "2024-02-02 00:00:00")
    lake.publish(start, f"gold.{name}")
    batch = plans(spark, [(2, "b")], "2024-03-01 00:00:00")
    merge_dimension(lake, name, batch, "2024-03-02 00:00:00", 4)
    assert ordered(lake.read(f"gold.{name}")) == ordered(merge_versions(start, batch, PLANS, "2024-03-02 00:00:00"))
    assert lake.stored(closed_table(name)).count() == 2


def test_type1_rows_keep_their_keys_in_buckets(spark):
    lake, spec = Lake(spark, "typeone_", bucket_rows=4), DIMENSIONS["dim_warehouse"]
    values = [F.lit("x").alias(c) for c in spec.attributes]
    start = spark.range(1, 21).select(F.col("id").alias(spec.surrogate_key), (F.col("id") * 3).alias(spec.natural_key), *values)
    publish_dimension(lake, "dim_warehouse", start, 0, 20)
    new = [F.lit("y").alias(c) for c in spec.attributes]
    batch = spark.createDataFrame([(6,), (100,)], f"{spec.natural_key} bigint").select(spec.natural_key, *new)
    merge_dimension(lake, "dim_warehouse", batch, "2024-03-02 00:00:00", 1)
    want = upsert_type1(start, batch, spec.natural_key, spec.surrogate_key)
    assert ordered(lake.read("gold.dim_warehouse")) == ordered(want)
    assert lake.buckets("gold.dim_warehouse") == 8
