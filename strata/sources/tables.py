"""Stored tables of the three layers, as plain parquet tables of the session's catalog.

A table is a view over its live version. A load that replaces a table writes a new version
and then moves the view: a write that fails leaves the old rows in place, and a reader goes
on with the version it began with until that is dropped, `keep_hours` after its writing.

Large tables are partitioned, bronze by load and silver events and facts by month. Their
loads rewrite the partitions they touch within the live version, by dynamic partition
overwrite, whose files appear only when all of them are written.

Tables without events are partitioned by a bucket of their keys. The number of buckets, a
power of two, follows the number of rows and doubles when the touched ones have grown to
twice `bucket_rows`; a table of one bucket is replaced whole.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from collections.abc import Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions import month_key
from strata.operators.upsert import upsert
from strata.sources.staging import CODEC

MONTH = "part_month"
NO_MONTH = 0  # partition of rows without a date
RUN = "part_run"
BUCKET = "part_bucket"

LAYERS = ("bronze", "silver", "gold")

#: Files of a partition that rows may be added to without a look at its size; with more of
#: them, one for so many rows is enough.
FILES, FILE_ROWS = 16, 50_000

#: A table of this many times `bucket_rows` is written by the tasks that have its rows, one for
#: so many rows or more, unless it lies in more than so many buckets: files would be too small.
LARGE, TASK_ROWS, MOST_BUCKETS = 4, 4_000_000, 256

#: Shuffled bytes of a partition up to which a join keeps one side of it in memory.
HASHED = "64m"


def month_of(at: str) -> Column:
    return F.coalesce(month_key(at), F.lit(NO_MONTH))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row, the same whatever integer type its keys have."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def observed(seen: Observation) -> dict:
    """What an observation saw; nothing if Spark knew that there are no rows and skipped it."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


class Lake:
    """The tables of one warehouse; `prefix` keeps several apart in one catalog.

    They lie in the catalog's warehouse folder, or below `folder`.
    """

    def __init__(
        self, spark: SparkSession, prefix: str = "", folder: str | None = None, keep_hours: float = 24, bucket_rows: int = 1_000_000
    ):
        self.spark, self.prefix, self.keep_hours, self.bucket_rows = spark, prefix, keep_hours, bucket_rows
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Shuffle files go when their query ends, not when the driver's memory is next cleared.
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        # Joins whose shuffled partitions are all small (AQE sees them) hash one side, sorting none.
        spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED)
        for layer in LAYERS:
            at = f" LOCATION '{folder}/{prefix}{layer}'" if folder else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}{at}")

    def name(self, table: str) -> str:
        """Full name of `layer.table`."""
        return f"{self.prefix}{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.stored(table).drop(MONTH, RUN, BUCKET)

    def stored(self, table: str) -> DataFrame:
        """The rows with their partition column, by which readers can skip partitions."""
        return self.spark.table(self.name(table))

    def live(self, table: str) -> str:
        """The table that holds the live version."""
        return f"{self.name(table)}__{self._properties(table)['version']}"

    def _properties(self, table: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def buckets(self, table: str) -> int:
        """The number of buckets that a table lies in."""
        return int(self._properties(table).get("buckets", 1))

    def publish(
        self,
        df: DataFrame,
        table: str,
        part: str | None = None,
        by: Column | None = None,
        buckets: int = 1,
        balanced: bool = True,
        about: int = 0,
    ) -> None:
        """Replace a table whole, partitioned by the column `part` if it is given. `df` may
        read the table itself. Rows of one partition that come from large tasks need not be
        `balanced`: each task then writes a file, and no row moves. Nor do they if a table of
        `about` so many rows is large."""
        view = self.name(table)
        version = f"v{time.time_ns() // 1_000_000}_{uuid.uuid4().hex[:6]}"
        if part is None:
            df.write.option("compression", CODEC).saveAsTable(f"{view}__{version}")
        else:
            rows = df.withColumn(part, by)
            rows = self._placed(rows, part, about) if balanced else rows
            rows.write.option("compression", CODEC).partitionBy(part).saveAsTable(f"{view}__{version}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('version' = '{version}', 'buckets' = '{buckets}') "
            f"AS SELECT * FROM {view}__{version}"
        )
        self._drop_old(table, version)

    def publish_buckets(self, df: DataFrame, table: str, keys: Sequence[str], about: int) -> None:
        """Replace a table whole, in as many buckets of its keys as `about` so many rows ask for."""
        buckets = 1 << max(0, -(-about // self.bucket_rows) - 1).bit_length()
        if buckets == 1:
            self.publish(df, table)
        else:
            about = about if buckets <= MOST_BUCKETS else 0
            self.publish(df, table, BUCKET, bucket_of(keys, buckets), buckets, about=about)

    def _placed(self, rows: DataFrame, part: str, about: int) -> DataFrame:
        """Rows for writing: of a large table as they lie, by few enough tasks that each has
        rows for a file in every partition; else few files per partition."""
        if about < LARGE * self.bucket_rows:
            return _balanced(rows, part)
        return rows.coalesce(max(self.spark.sparkContext.defaultParallelism, about // TASK_ROWS))

    def unite(self, table: str, query: str) -> None:
        """Make a view over other tables, in place of the table if it is one."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS {query}")

    def _drop_old(self, table: str, live: str) -> None:
        """Drop versions that are not live and older than readers may be."""
        layer, name = table.split(".")
        oldest = time.time() * 1000 - self.keep_hours * 3_600_000
        for row in self.spark.sql(f"SHOW TABLES IN {self.prefix}{layer} LIKE '{name}__v*'").collect():
            version = row["tableName"].rpartition("__")[2]
            if version != live and int(version[1:].partition("_")[0]) < oldest:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}{layer}.{row['tableName']}")

    def drop(self, table: str) -> None:
        """Take a table away, if it is there; readers go on as with `publish`."""
        if self.exists(table):
            self.spark.sql(f"DROP VIEW {self.name(table)}")
            self._drop_old(table, "")

    def put_part(self, df: DataFrame, table: str, part: str, value: int, balanced: bool = True) -> None:
        """Make `df` the content of one numbered partition; the first one makes the table."""
        number = F.lit(value).cast("bigint")
        if self.exists(table):
            self.replace_parts(df.withColumn(part, number), table, part, [value], *([] if balanced else [False]))
        else:
            self.publish(df, table, part, number, balanced=balanced)

    def replace_parts(
        self, df: DataFrame, table: str, part: str, values: Sequence[object], balanced: bool = True, about: int = 0
    ) -> None:
        """Make `df`, of about so many rows, the content of the given partitions; it may read
        them and lies inside them. Without a number it counts as large if they are.

        Which partitions got rows is observed during the write; the others are dropped.
        """
        written, live, stored = Observation(), self.live(table), self.stored(table)
        if balanced and not about:
            about = stored.filter(F.col(part).isin(list(values))).count()
        rows = df.select(*stored.columns).observe(written, F.collect_set(part).alias("parts"))
        rows = self._placed(rows, part, about) if balanced else rows
        rows.write.option("compression", CODEC).mode("overwrite").insertInto(live)
        for value in set(values) - set(observed(written).get("parts") or []):
            self.spark.sql(f"ALTER TABLE {live} DROP IF EXISTS PARTITION ({part} = {value!r})")
        self.spark.catalog.refreshTable(self.name(table))

    def add_rows(self, rows: DataFrame, table: str, part: str, values: Sequence[int]) -> None:
        """Add rows that lie in the given partitions, as further files of them.

        Partitions that have come to lie in many small files are written whole instead. Doing
        it again adds the rows again: the caller knows which are there.
        """
        stored = self.stored(table)
        rows = rows.select(*stored.columns)
        crowded = self._crowded(table, part, values)
        if crowded:
            whole = stored.filter(F.col(part).isin(crowded)).unionByName(rows.filter(F.col(part).isin(crowded)))
            self.replace_parts(whole, table, part, crowded)
            rows = rows.filter(~F.col(part).isin(crowded))
        if len(crowded) < len(values):
            _balanced(rows, part).write.option("compression", CODEC).mode("append").insertInto(self.live(table))
            self.spark.catalog.refreshTable(self.name(table))

    def _crowded(self, table: str, part: str, values: Sequence[int]) -> list[int]:
        """Those of the partitions that lie in more files than their rows need."""
        def files(df: DataFrame) -> Counter[int]:
            named = (unquote(f).rpartition("/")[0].rpartition("/")[2] for f in df.inputFiles())
            return Counter(int(n.removeprefix(f"{part}=")) for n in named)

        held = self.stored(table)
        found = {v: n for v, n in files(held.filter(F.col(part).isin(list(values)))).items() if n > FILES}
        counted = held.filter(F.col(part).isin(list(found))).groupBy(part).count().collect() if found else []
        return sorted(v for v, rows in counted if found[v] > FILES + rows // FILE_ROWS)

    def merge(
        self, rows: DataFrame, table: str, keys: Sequence[str], held: Sequence[int], gone: DataFrame | None = None
    ) -> None:
        """Upsert rows (one per key, with their month) into a month table.

        `held` are the months that hold older rows of the keys; only those and the months of
        the rows are read and rewritten. If there are none, the rows are added. Rows of the
        keys of `gone` go also if `rows` has no row for them.
        """
        found = [r[0] for r in rows.select(MONTH).distinct().collect()]
        if not held:
            if found:
                self.add_rows(rows, table, MONTH, found)
            return
        months = sorted({*held, *found})
        replaced = (rows if gone is None else gone).select(*keys)
        stored, others = self.stored(table), sorted({*months}.difference(held))
        kept = stored.filter(F.col(MONTH).isin(others))
        older = stored.filter(F.col(MONTH).isin(list(held)))
        kept = kept.unionByName(older.join(replaced, list(keys), "left_anti").select(kept.columns))
        self.replace_parts(kept.unionByName(rows), table, MONTH, months)


    def merge_buckets(self, rows: DataFrame, table: str, keys: Sequence[str]) -> None:
        """Upsert rows, one per key, into a table in buckets: those of the rows are rewritten.

        `rows` is read several times. The table is made anew when it has outgrown its buckets.
        """
        buckets = self.buckets(table)
        rows = rows.withColumn(BUCKET, bucket_of(keys, buckets))
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        if not touched:
            return
        held = self.stored(table)
        if buckets > 1:
            held = held.filter(F.col(BUCKET).isin(touched))
        about = (held.count() + rows.count()) * buckets // len(touched)
        if buckets == 1 or about > 2 * buckets * self.bucket_rows:
            self.publish_buckets(upsert(self.read(table), rows, keys), table, keys, about)
        else:
            self.replace_parts(upsert(held, rows, keys), table, BUCKET, touched)


def _balanced(df: DataFrame, part: str) -> DataFrame:
    """Few files per partition, and one that holds much of the rows split over tasks (AQE)."""
    return df.hint("rebalance", F.col(part))
