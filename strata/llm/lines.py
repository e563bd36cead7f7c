"""Line dedup: lines found in many documents go from all of them.

Line keys are kept as levelled sorted runs: bucketed tables of (key, documents), sorted
within their buckets. Documents come in batches. A batch counts its own keys, merge-anti-joins
the runs, so that keys already known to be common are not counted again, and adds what is
left as a run of its own. A level that is full is compacted into one run of the next level,
whose sums may make more keys common. Runs are joined bucket by bucket and never shuffled.

Keys are compared by 128 bits of hashes. Everything is DataFrame operations.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.blocks import carried
from strata.sources.staging import shared_folder, stage

#: White space that is stripped from both ends of a line.
_GAPS = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Runs of a level before they are compacted into one of the next.
FAN = 4
#: Line keys of a batch, and the least number of batches.
BATCH_KEYS = 1 << 32
LEAST_BATCHES = 4
#: Keys that may hold more than the 200,000th part of all lines; so there are no more of them.
HOT_KEYS = 200_000

_KEY = ["h", "g"]
_TEXT = ["t", "u"]


def _hashes(value: Column, first: str, second: str) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(value).alias(first), F.xxhash64(F.lit(1), value).alias(second)]


def _lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; the built-in does that for texts of one byte a character."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_keys(text: Column, min_chars: int) -> Column:
    """A hash pair for each line, null for a line whose key has fewer code points."""
    stripped = F.transform(F.split(_lower_ascii(text), "\n", -1), lambda line: F.btrim(line, F.lit(_GAPS)))
    return F.transform(stripped, lambda key: F.when(F.char_length(key) >= min_chars, F.struct(*_hashes(key, *_KEY))))


class LineRuns:
    """Counts of keys in levelled sorted runs, each a bucketed table below the shared folder.

    Rows are (h, g, n, m): a key, and the documents and different texts that it was counted
    in. Rows that are common already lie in a partition of their own, the only one that a
    new batch reads. Once a key is common its counts are no longer added up.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fan: int = FAN, buckets: int | None = None):
        self.spark, self.min_docs, self.fan = spark, min_docs, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.base = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self._made = 0
        spark.sql(f"CREATE DATABASE {self.base} LOCATION '{shared_folder(spark).rstrip('/')}/{self.base}'")

    def _write(self, counts: DataFrame) -> str:
        name = f"{self.base}.run_{self._made}"
        self._made += 1
        marked = counts.select(*_KEY, "n", "m", (F.col("n") >= self.min_docs).alias("common"))
        marked.write.partitionBy("common").bucketBy(self.buckets, *_KEY).sortBy(*_KEY).saveAsTable(name)
        return name

    def _merged(self, runs: Sequence[str]) -> DataFrame:
        every = reduce(DataFrame.unionByName, [self.spark.table(r) for r in runs])
        return every.groupBy(*_KEY).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))

    def live(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, counts: DataFrame) -> None:
        """Add a batch: (h, g, n, m), one row per key."""
        for run in self.live():
            counts = counts.join(self.spark.table(run).where("common").select(*_KEY), _KEY, "left_anti")
        self.levels[0].append(self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fan:
            full = self.levels[level]
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self._merged(full)))
            self.levels[level] = []
            for run in full:
                self.spark.sql(f"DROP TABLE {run}")
            level += 1

    def common(self) -> DataFrame:
        """The keys of at least `min_docs` documents: (h, g, m), written outside the runs."""
        return stage(self._merged(self.live()).where(F.col("n") >= self.min_docs).select(*_KEY, "m"))

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE {self.base} CASCADE")


def _batches(texts: DataFrame, least: int, keys: int) -> tuple[int, list[DataFrame]]:
    """The number of all lines, and the texts by ranges of their hash, which the scan can skip to."""
    lines = texts.agg(F.sum(F.size("keys"))).first()[0] or 0
    n = max(least, math.ceil(lines / keys))
    cuts = [-(2**63) + (i << 64) // n for i in range(n)] + [2**63]
    return lines, [texts.where(F.col("t").between(a, b - 1)) for a, b in zip(cuts, cuts[1:])]


def _dropped(texts: DataFrame, common: DataFrame, lines: int) -> DataFrame:
    """(t, u, left): the numbers of the lines that stay, for texts that lose some.

    A key that a good part of the lines holds would make one join task large. There are few
    such keys, at most HOT_KEYS by their counts, so these are broadcast.
    """
    each = texts.select(*_TEXT, F.size("keys").alias("size"), F.posexplode("keys").alias("line", "key"))
    each = each.where("key is not null").select(*_TEXT, "size", "line", "key.h", "key.g")
    is_hot = F.col("m") * HOT_KEYS >= lines
    hot, rest = common.where(is_hot).select(*_KEY), common.where(~is_hot).select(*_KEY)
    gone = each.join(F.broadcast(hot), _KEY, "left_semi").unionByName(each.join(rest, _KEY, "left_semi"))
    stay = F.array_except(F.sequence(F.lit(0), F.max("size") - 1), F.collect_list("line"))
    return gone.groupBy(*_TEXT).agg(stay.alias("left"))


def without_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    carry: Sequence[str] = (),
    fan: int = FAN,
    least_batches: int = LEAST_BATCHES,
    batch_keys: int = BATCH_KEYS,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept), and the columns `carry` in one, `carried`.

    A text is split at line feeds. The key of a line is the line without white space (space
    and the control characters 9 to 13) at both ends, A-Z in lower case. Lines whose key has
    at least `min_chars` code points and is found in at least `min_docs` documents go from
    every document; the others stay as they are, joined by line feeds.

    Each row is a document of its own, whatever its doc_id, and a key counts once in it. So
    rows that repeat a doc_id or a whole text count each, and a null doc_id is as good as
    another. A null or empty text is one empty line. A document that loses all lines keeps
    the empty text. An empty table gives no rows. Other columns are not read.

    Equal texts are counted and judged once. `min_docs` and `min_chars` are at least 1.
    """
    if min_docs < 1 or min_chars < 1:
        raise ValueError("min_docs and min_chars are at least 1")
    more = [carried(carry)] if carry else []
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select(*_hashes(text, *_TEXT), line_keys(text, min_chars).alias("keys"))
    texts = stage(hashed.groupBy(*_TEXT).agg(F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys")).sortWithinPartitions(*_TEXT))
    lines, batches = _batches(texts, least_batches, batch_keys)
    runs = LineRuns(docs.sparkSession, min_docs, fan)
    for batch in batches:
        each = batch.select("copies", F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
        runs.add(each.groupBy("key.h", "key.g").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("m")))
    common = runs.common()
    runs.drop()
    # The lines are split off below the join, so that each text is split once.
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_hashes(text, *_TEXT), F.split(text, "\n", -1).alias("lines"), *more)
    left = F.when(F.col("left").isNull(), F.col("lines")).otherwise(F.transform("left", lambda i: F.get("lines", i)))
    return whole.join(_dropped(texts, common, lines), _TEXT, "left").select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.coalesce("left", F.sequence(F.lit(1), F.size("lines"))))).cast("long").alias("n_dropped"),
        F.array_join(left, "\n").alias("kept"),
        *(["carried"] if carry else []),
    )
