"""Point-in-time lookups by disjoint timelines.

A lookup asks, per key and day, for the best of the intervals that contain the day.
Joining days to all intervals of a key and taking the best afterwards makes
days x intervals rows per key, which a hot key turns into one huge group. Here the
intervals alone are first cut into a timeline: per key, disjoint day ranges, each with
its one answer. The lookup is then an equi join with a range condition that finds at
most one row per fact row, so nothing is aggregated afterwards.

The keys are counted first, and those with several intervals written, so that the intervals
themselves move at most once. They are read twice or more: give a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import day
from strata.sources.staging import stage

# Days since 1970-01-01 of 0001-01-01 and of the day after 9999-12-31.
_FIRST, _AFTER_LAST = -719162, 2932897

# A key with at most this many intervals is cut inside one row, others by blocks. Both ways
# give the same ranges; the first spares a small key the joins of the second.
_FEW = 32


# Keys up to this number are broadcast to the intervals (a few tens of bytes each).
_BROADCAST = 1_000_000
# Intervals that a task gathers by key: the number of tasks follows the intervals.
_TASK_ROWS = 500_000


@dataclass(frozen=True)
class _Counted:
    """Written keys with their number of intervals `n`, and how many rows and crowded keys they are."""

    keys: DataFrame
    found: int
    crowded: int
    rows: int


def _count_keys(intervals: DataFrame, key: str, over: int) -> _Counted:
    """The keys with more than so many intervals."""
    counted = intervals.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > over)
    keys = stage(counted)
    found, crowded, rows = keys.agg(F.count(F.lit(1)), F.count_if(F.col("n") > _FEW), F.sum("n")).first()
    return _Counted(keys, found, crowded, rows or 0)


def _named(keys: DataFrame, key: str, found: int) -> DataFrame:
    names = keys.select(key)
    return F.broadcast(names) if found <= _BROADCAST else names


def _timeline(
    intervals: DataFrame, key: str, counted: _Counted, answer: Sequence[str], fallback: bool
) -> DataFrame:
    """Cut intervals (key, lo, hi, best) into disjoint ranges with the greatest `best` of each.

    `lo` is the first day and `hi` the day after the last one, as day numbers; an interval
    that is empty or open contains no day. Days without an interval have the greatest
    `best` of the whole key if `fallback` is set, else no range. `best` is a struct that
    starts with the ranking fields and holds the `answer` fields.

    `counted` names at least the keys with many intervals. All others are gathered, a bounded
    number of rows each, and cut by array functions; the crowded ones never are.
    """
    many, few = [], intervals
    if counted.crowded:
        crowded = _named(counted.keys.filter(F.col("n") > _FEW), key, counted.crowded)
        many = [_cut_by_blocks(intervals.join(crowded, key, "left_semi"), key, answer, fallback)]
        few = intervals.join(crowded, key, "left_anti")
    tasks = counted.rows // _TASK_ROWS
    if tasks > int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        few = few.repartition(tasks, key)
    return (
        reduce(DataFrame.unionByName, many, _cut_in_row(few, key, answer, fallback))
        .filter("best is not null")
        .select(key, "valid_from", "valid_to", *[F.col(f"best.{c}").alias(c) for c in answer])
    )


def _cut_in_row(intervals: DataFrame, key: str, answer: Sequence[str], fallback: bool) -> DataFrame:
    """Timelines of keys with a bounded number of intervals, each inside one row."""
    rest = "array_max(transform(v, x -> x.best))" if fallback else "null"
    changes = " or ".join(f"not (p.best.{c} <=> pieces[i - 1].best.{c})" for c in answer)
    return (
        intervals.groupBy(key)
        .agg(F.collect_list(F.struct("lo", "hi", "best")).alias("v"))
        .select(
            key,
            "v",
            F.expr("filter(v, x -> x.lo < x.hi)").alias("held"),
        )
        .select(
            key,
            "held",
            F.expr(rest).alias("rest"),
            F.expr(
                f"array_sort(array_distinct(concat(array({_FIRST}),"
                " flatten(transform(held, x -> array(x.lo, x.hi))))))"
            ).alias("days"),
        )
        .select(
            key,
            F.expr(
                f"transform(filter(days, d -> d < {_AFTER_LAST}), d -> struct(d as lo, coalesce(array_max(transform("
                "filter(held, x -> x.lo <= d and d < x.hi), x -> x.best)), rest) as best))"
            ).alias("pieces"),
        )
        .select(key, F.expr(f"filter(pieces, (p, i) -> i = 0 or {changes})").alias("ranges"))
        .select(
            key,
            F.expr(
                "inline(transform(ranges, (r, i) -> struct(r.lo as valid_from,"
                f" coalesce(get(ranges, i + 1).lo, {_AFTER_LAST}) - 1 as valid_to, r.best as best)))"
            ),
        )
    )


def _blocks() -> str:
    """SQL: the largest aligned power-of-two blocks that make up positions a .. b-1.

    A block is (level, block) and stands for the 2^level positions from block * 2^level.
    There are at most two per level, so about 2 * log2(b - a) in all.
    """
    lo, hi = "((a + shiftleft(1, j) - 1) div shiftleft(1, j))", "(b div shiftleft(1, j))"
    return f"""flatten(transform(sequence(0, int(floor(log2(b - a)))), j -> filter(array(
        if({lo} < {hi} and {lo} % 2 = 1, struct(j as level, int({lo}) as block), null),
        if({lo} < {hi} and {hi} % 2 = 1, struct(j as level, int({hi} - 1) as block), null)
    ), x -> x is not null)))"""


def _cut_by_blocks(intervals: DataFrame, key: str, answer: Sequence[str], fallback: bool) -> DataFrame:
    """Timelines of keys with any number of intervals, without gathering them.

    The distinct day boundaries of a key, numbered in order, cut its days into pieces; the
    calendar bounds them however many intervals there are. An interval stands for a few
    power-of-two blocks of pieces, of each block only the best interval counts, and each
    piece looks at the blocks above it. Intervals are aggregated wherever they meet, so no
    task sorts or holds all those of a crowded key.
    """
    spans = intervals.filter("lo < hi").groupBy(key, "lo", "hi").agg(F.max("best").alias("best"))
    rests = intervals.groupBy(key).agg(F.max("best").alias("rest"))
    ends = F.explode(F.array(F.lit(_FIRST), F.lit(_AFTER_LAST))).alias("edge")
    edges = spans.select(key, F.explode(F.array("lo", "hi")).alias("edge")).unionByName(rests.select(key, ends))
    in_key = Window.partitionBy(key)
    ranked = edges.distinct().withColumn("pos", F.row_number().over(in_key.orderBy("edge")))

    first = ranked.select(key, F.col("edge").alias("lo"), F.col("pos").alias("a"))
    last = ranked.select(key, F.col("edge").alias("hi"), F.col("pos").alias("b"))
    blocks = (
        spans.join(first, [key, "lo"])
        .join(last, [key, "hi"])
        .select(key, "best", F.expr(f"inline({_blocks()})"))
        .groupBy(key, "level", "block")
        .agg(F.max("best").alias("best"))
    )
    tops = blocks.groupBy(key).agg(F.max("level").alias("top"))
    above = "inline(transform(sequence(0, coalesce(top, 0)), j -> struct(j as level, int(pos div shiftleft(1, j)) as block)))"
    resolved = (
        ranked.filter(f"edge < {_AFTER_LAST}")
        .join(tops, key, "left")
        .select(key, F.col("edge").alias("lo"), F.expr(above))
        .join(blocks, [key, "level", "block"], "left")
        .groupBy(key, "lo")
        .agg(F.max("best").alias("best"))
    )
    if fallback:
        resolved = resolved.join(rests, key).select(key, "lo", F.coalesce("best", "rest").alias("best"))

    # Neighbours with the same answer become one range.
    by_day = in_key.orderBy("lo")
    before = F.struct(F.lag("best").over(by_day).alias("best"))
    same = F.row_number().over(by_day) > 1
    for c in answer:
        same = same & F.col(f"best.{c}").eqNullSafe(before["best"][c])
    return (
        resolved.withColumn("_same", same)
        .filter("not _same")
        .select(
            key,
            F.col("lo").alias("valid_from"),
            (F.lead("lo", 1, _AFTER_LAST).over(by_day) - 1).alias("valid_to"),
            "best",
        )
    )


def version_timeline(
    dim: DataFrame, natural_key: str, surrogate_key: str, carried: Sequence[str] = ()
) -> DataFrame:
    """Which version of each natural key answers for which days.

    The version valid on the day; if none, the current one; if none, the one with the
    highest surrogate key. Among several, current first, then the highest key. An
    inverted version, or one with an open bound, only takes part as a fallback.
    Columns: natural key, valid_from, valid_to (day numbers), surrogate key, `carried`.
    """
    answer = [surrogate_key, *carried]
    dim = dim.filter(F.col(natural_key).isNotNull())

    # A lone version answers for every day, valid or not, and stays where it is. With many
    # keys of several versions all rows are gathered by key, which gives a lone one the same.
    counted = _count_keys(dim, natural_key, 1)
    several, lone = dim, []
    if counted.found <= _BROADCAST:
        names = _named(counted.keys, natural_key, counted.found)
        single = dim.join(names, natural_key, "left_anti") if counted.found else dim
        bounds = [F.lit(_FIRST).alias("valid_from"), F.lit(_AFTER_LAST - 1).alias("valid_to")]
        lone = [single.select(natural_key, *bounds, *answer)]
        if not counted.found:
            return lone[0]
        several = dim.join(names, natural_key, "left_semi")
    intervals = several.select(
        natural_key,
        F.unix_date("effective_from").alias("lo"),
        (F.unix_date("effective_to") + 1).alias("hi"),
        F.struct("is_current", *answer).alias("best"),
    )
    return reduce(DataFrame.unionByName, lone, _timeline(intervals, natural_key, counted, answer, fallback=True))


def interval_timeline(
    df: DataFrame, key: str, start: str, end: str, order: Sequence[str], answer: Sequence[str]
) -> DataFrame:
    """The active interval of each key and day: the greatest by `order` among those covering it.

    A NULL end is open, a NULL start never matches. Days without an interval are left out.
    """
    df = df.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
    intervals = df.select(
        key,
        F.unix_date(day(start)).alias("lo"),
        F.coalesce(F.unix_date(day(end)) + 1, F.lit(_AFTER_LAST)).alias("hi"),
        F.struct(
            *[F.col(c).alias(f"by_{c}") for c in order], *[F.col(c) for c in answer]
        ).alias("best"),
    )
    return _timeline(intervals, key, _count_keys(df.select(key), key, 1), answer, fallback=False)


def at_day(facts: DataFrame, timeline: DataFrame, key: str, when: Column, how: str = "inner") -> DataFrame:
    """Facts with the timeline's answer for their key and day; at most one match each.

    With `how="inner"` unknown keys drop out, with "left" they get NULL.
    """
    t = timeline.withColumnRenamed(key, "_key")
    d = F.unix_date(day(when))
    matches = (F.col(key) == F.col("_key")) & d.between(F.col("valid_from"), F.col("valid_to"))
    return facts.join(t, matches, how).drop("_key", "valid_from", "valid_to")
