"""Silver cleaning: one valid, normalised row per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.staging import stage
from strata.specs import TableSpec

#: Repeated keys up to this number are broadcast to the rows (a few tens of bytes each).
FEW_REPEATED = 1_000_000
#: More of them, up to this number, are broadcast as a bitmap of their hashes (64 MB at most).
MANY_REPEATED = 128_000_000

# Bits for a repeated key, bits of the largest bitmap, bits in one value of
# `bitmap_construct_agg`, and bytes in one of the pieces that values are broadcast in, as
# numbers of eight bytes.
_KEY_BITS, _MOST_BITS, _VALUE_BITS, _PIECE = 8, 1 << 29, 32768, 64


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each map task to one row per key before the shuffle (WindowGroupLimit),
    so a key that holds much of the table sends one row per task, not all its rows.
    """
    versions = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(versions)).filter("_rank = 1").drop("_rank")


def latest_of_repeated(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    kept: Callable[[DataFrame], DataFrame] = lambda ranked: ranked,
) -> DataFrame:
    """The same rows as `latest_per_key`, of a table that is read twice.

    The keys alone are counted first. A row whose key no other row has stays where it is, so
    that of a table with few repeated keys, whole rows neither move nor are sorted. With
    many, a row also moves if its key shares its bit of a bitmap with a repeated one; with
    more than a bitmap is good for, all rows are ranked. `kept` may write the ranked rows, so
    that the result can be read again without moving any.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counted.filter("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]))
    found = repeated.count()
    if found > MANY_REPEATED:
        return kept(latest_per_key(df, keys, order))
    if found > FEW_REPEATED:
        marked = _with_mark(df, keys, repeated, found)
        ranked = latest_per_key(marked.filter("_marked").drop("_marked"), keys, order)
        return marked.filter("not _marked").drop("_marked").unionByName(kept(ranked))
    if not found:
        return df
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    single = df.join(F.broadcast(repeated), same, "left_anti")
    ranked = latest_per_key(df.join(F.broadcast(repeated), same, "left_semi"), keys, order)
    return single.unionByName(kept(ranked))


def rows_of_keys(df: DataFrame, keys: Sequence[str], wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of the wanted keys, and the others, which have none of them.

    Neither moves: the wanted keys, which are written and counted, are broadcast, many of them
    as a bitmap by which a few other rows count as theirs. With more of them than that is
    good for, all rows may have one. No key is null.
    """
    named = [F.col(k).cast(df.schema[k].dataType).alias(f"_{k}") for k in keys]
    listed = stage(wanted.select(*named).distinct())
    found = listed.count()
    if found > MANY_REPEATED:
        return df, df.limit(0)
    if found > FEW_REPEATED:
        marked = _with_mark(df, keys, listed, found)
        return marked.filter("_marked").drop("_marked"), marked.filter("not _marked").drop("_marked")
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    return df.join(F.broadcast(listed), same, "left_semi"), df.join(F.broadcast(listed), same, "left_anti")


def _with_mark(df: DataFrame, keys: Sequence[str], repeated: DataFrame, found: int) -> DataFrame:
    """The rows with `_marked`: true for each of a repeated key, and for a few of other keys."""
    bits = min(_MOST_BITS, max(_VALUE_BITS, 1 << (found * _KEY_BITS - 1).bit_length()))

    def bit_of(columns: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(bits))

    values = repeated.select(bit_of([f"_{k}" for k in keys]).alias("_bit")).groupBy(
        F.expr(f"_bit div {_VALUE_BITS}").alias("_value")
    )
    pieces = _VALUE_BITS // 8 // _PIECE
    bitmap = values.agg(F.bitmap_construct_agg(F.col("_bit") % _VALUE_BITS).alias("_bits")).select(
        "_value", "_bits", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_n")
    )
    # The bytes of a piece become numbers here, once, and not at each row that looks one up.
    half = "cast(conv(hex(substring(_bits, _n * {0} + i * 8 + {1}, 4)), 16, 10) as bigint)"
    words = f"transform(sequence(0, {_PIECE // 8 - 1}), i -> shiftleft({half.format(_PIECE, 1)}, 32) | {half.format(_PIECE, 5)})"
    bitmap = bitmap.select((F.col("_value") * pieces + F.col("_n")).alias("_at"), F.expr(words).alias("_words"))
    placed = df.withColumn("_bit", bit_of(keys)).join(F.broadcast(bitmap), F.expr(f"_bit div {_PIECE * 8} = _at"), "left")
    # Bit n of a value is bit n % 8 of its byte n div 8, and a number starts with its highest byte.
    word, at = f"get(_words, int(_bit div 64 % {_PIECE // 8}))", "int(56 - _bit % 64 div 8 * 8 + _bit % 8)"
    marked = F.expr(f"coalesce(getbit({word}, {at}) = 1, false)")
    return placed.select(*df.columns, marked.alias("_marked"))


def latest_version(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = (), reread: bool = False
) -> DataFrame:
    """Newest row per key: by update time, then by load time.

    NULL order is written out: a missing update time loses, a missing load time wins.
    `tie_break` names columns that decide between rows equal in both. `reread` says that
    `df` is cheap to read twice.
    """
    latest = latest_of_repeated if reread else latest_per_key
    return latest(df, keys, newest_first(tie_break))


def newest_first(tie_break: Sequence[str] = ()) -> list[Column]:
    order = [F.col("updated_at").desc_nulls_last(), F.col("load_timestamp").desc_nulls_first()]
    return order + [F.col(c).desc_nulls_last() for c in tie_break]


def valid_span(df: DataFrame, start: str, end: str) -> DataFrame:
    """Drop rows whose start lies after their end; a missing bound is valid."""
    s, e = F.col(start), F.col(end)
    return df.filter(s.isNull() | e.isNull() | (s <= e))


def clean(bronze: DataFrame, spec: TableSpec, tie_break: Sequence[str] = (), reread: bool = False) -> DataFrame:
    """Bronze rows to silver rows.

    The rules run after the dedup, on the surviving rows only: no rule changes a key or
    the order of versions. A key whose newest row has an invalid span is dropped whole;
    in an incremental load the row already in silver then stays.
    """
    latest = latest_version(bronze.dropna(subset=list(spec.keys)), spec.keys, tie_break, reread)
    cleaned = latest.select(
        *[
            spec.rules[c](F.col(c)).alias(c) if c in spec.rules else F.col(c)
            for c in spec.silver_columns
        ]
    )
    return valid_span(cleaned, *spec.span) if spec.span else cleaned
