"""What a chain of filters removes, in whatever order they are applied.

One id table is stored for each filter: the documents that fail it. The documents' ids are
then split filter by filter, by a left-semi and a left-anti join with the filter's table, so
that each ends in the cell of exactly the filters that it fails; the last of the left-anti
branches holds the survivors of all. All these tables are bucketed and sorted by id, so the
joins merge them bucket by bucket without a shuffle. What any prefix of any order leaves,
removes or finds removed already is a sum of whole cells: there are 2 ** filters of them a
part, so n! orders cost no more joins than one.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.staging import shared_folder, stage

_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "[A-Z]"
_SIGNS = "[#$%&*|]"
#: Ids in a bucket of the id tables; there are as many buckets as cores at least.
BUCKET_ROWS = 8 << 20

ID = "id"


def words(text: Column) -> Column:
    return F.filter(F.split(text, _GAP, -1), lambda w: w != "")


def rules(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides."""
    n, distinct = F.size(words(text)), F.size(F.array_distinct(words(text)))
    return {
        "A": n < 100,
        "B": 100 * distinct < 80 * n,
        "C": 100 * F.regexp_count(text, F.lit(_UPPER)) > 10 * F.char_length(text),
        "D": text.rlike(_SIGNS),
    }


class IdTables:
    """Bucketed tables of ids below the shared folder."""

    def __init__(self, spark: SparkSession, n_ids: int):
        self.spark = spark
        self.buckets = max(spark.sparkContext.defaultParallelism, math.ceil(n_ids / BUCKET_ROWS))
        self.base = f"filter_audit_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.base} LOCATION '{shared_folder(spark).rstrip('/')}/{self.base}'")

    def store(self, df: DataFrame, name: str, dealt: bool = False) -> DataFrame:
        """`dealt` rows come from such tables, so that a task holds few buckets."""
        rows = df if dealt else df.repartition(self.buckets, ID)
        rows.write.bucketBy(self.buckets, ID).sortBy(ID).saveAsTable(f"{self.base}.{name}")
        return self.spark.table(f"{self.base}.{name}")

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.base} CASCADE")


def failing(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """A row per document: id, part, good, toxic, and a column for each filter, true if it fails.

    The rows are numbered once, in a written table, so that every later step sees the same ids.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(
        F.monotonically_increasing_id().alias(ID),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("t"),
        F.xxhash64(F.lit(1), text).alias("u"),
        *[fails.alias(name) for name, fails in rules(text).items()],
    )
    seen = stage(read)
    repeated = seen.groupBy("t", "u").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = repeated.where("first < last").drop("last")
    marked = labels.where("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg(*[F.coalesce(F.max(F.expr(f"{c} = 1")), F.lit(False)).cast("int").alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    whole = seen.join(repeated, ["t", "u"], "left").join(marked, "doc_id", "left")
    copy = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False)).alias("E")
    label = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    return stage(whole.select(ID, "part", *label, "A", "B", "C", "D", copy))


def cells(failed: DataFrame, filters: Sequence[str]) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents fail exactly the filters of the mask.

    Bit i of the mask is filter i. At most 2 ** filters rows for each part.
    """
    tables = IdTables(failed.sparkSession, failed.count())
    stored = {f: tables.store(failed.where(F.col(f)).select(ID), f"fails_{i}") for i, f in enumerate(filters)}
    split = tables.store(failed.select(ID, "part", "good", "toxic", F.lit(0).alias("mask")), "split_0")
    for i, f in enumerate(filters):
        removed = split.join(stored[f], ID, "left_semi").withColumn("mask", F.col("mask") + (1 << i))
        split = removed.unionByName(split.join(stored[f], ID, "left_anti"))
        if i + 1 < len(filters):
            split = tables.store(split, f"split_{i + 1}", dealt=True)
    out = stage(split.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))
    tables.drop()
    return out


def orders(filters: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of those before) for each step of each order."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            out.append(("".join(filters[j] for j in order), step, 1 << i, before))
            before |= 1 << i
    return out


def _sum(where: Column, what: Column) -> Column:
    return F.coalesce(F.sum(F.when(where, what)), F.lit(0)).cast("long")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The effect of each step of all orders of the five filters, for each value of `part`.

    Filters A to D are those of `rules`: short, repetitive, capitals, signs. E is for copies
    of a text with a smaller doc_id. Returns part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley, which is the filter's removed at any
    step summed over all orders. A part without failures has its rows, with zeros.

    Each row is a document of its own. A null text is an empty one, and a null part the empty
    string. A document without a doc_id is no copy of another and makes none; rows that share
    a doc_id and a text are no copies of each other. A label counts if any row of its doc_id
    in `labels` has it. Equal texts are told by 128 bits of hashes. Empty tables give no
    rows. Other columns are not read.
    """
    filters = "ABCDE"
    found = cells(failing(docs, labels, part), list(filters))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(bit).alias("bit"), F.lit(b).alias("before")) for o, s, bit, b in orders(filters)])
    # Each cell meets the steps within its row; cells are at most 32 a part.
    each = found.select("*", F.explode(steps).alias("at")).select("*", "at.*")
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    removed = fails & ~earlier
    return each.groupBy("part", "filter_order", "step").agg(
        _sum(~fails & ~earlier, F.col("n")).alias("kept"),
        _sum(removed, F.col("n")).alias("removed"),
        _sum(fails & earlier, F.col("n")).alias("redundant"),
        _sum(mask == bit, F.col("n")).alias("unique_fails"),
        _sum(removed, F.col("good")).alias("good_lost"),
        _sum(removed, F.col("toxic")).alias("toxic_lost"),
        # A filter removes a document in those orders in which it comes first among those the document fails.
        _sum(fails, F.col("n") * F.expr(f"{math.factorial(len(filters))} div greatest(bit_count(mask), 1)")).alias("shapley"),
    )
