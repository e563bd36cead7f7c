"""Directories: in which months the rows of a key lie.

Event tables are stored by month, so whoever looks for a key would have to scan them all. Two
kinds of small tables say where to look, and only the months they list are opened:

* `<table>__keys`: the month of each row key, in ranges of keys. Keys that grow with time
  leave most ranges alone. An upsert learns from it which months hold older rows of its keys.
* `<table>__by_<column>`: the distinct values of another key (a customer, a title, an item)
  in each month.

They list a key's month before its rows are written, and keep it when a row moves: a listed
month may hold no row of the key, but a month that holds one is listed. Writing a table whole
makes its directories anew. Only range and month numbers come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.tables import MONTH, Lake

#: Row keys in one range: a range is a partition, rewritten when it gets a new key.
RANGE_KEYS = 10_000_000
RANGE = "part_range"
AT = "at_month"


def keys_table(table: str) -> str:
    return f"{table}__keys"


def by_table(table: str, column: str) -> str:
    return f"{table}__by_{column}"


def _range(keys: Sequence[str]) -> Column:
    return F.floor(F.col(keys[0]) / F.lit(RANGE_KEYS)).cast("bigint")


def publish_directories(lake: Lake, table: str, keys: Sequence[str], columns: Sequence[str], about: int = 0) -> None:
    """Make the directories of a stored event table from its rows, about so many."""
    rows = lake.stored(table)
    lake.publish(rows.select(*keys, F.col(MONTH).alias(AT)), keys_table(table), RANGE, _range(keys))
    for c in columns:
        lake.publish(rows.select(c, MONTH).dropna().distinct(), by_table(table, c), MONTH, F.col(MONTH), about=about)


def known_keys(lake: Lake, table: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The entries listed for the keys of `rows`, from the ranges they lie in."""
    ranges = [r[0] for r in rows.select(_range(keys)).distinct().collect()]
    listed = lake.stored(keys_table(table)).filter(F.col(RANGE).isin(ranges))
    return listed.join(rows.select(*keys), list(keys), "left_semi")


def months_of(known: DataFrame) -> list[int]:
    """The months of listed entries."""
    return [r[0] for r in known.select(AT).distinct().collect()]


def list_rows(
    lake: Lake, table: str, rows: DataFrame, keys: Sequence[str], columns: Sequence[str], known: DataFrame
) -> None:
    """List rows that are about to be written; what is listed already, of row keys the entries
    in `known`, is not written again."""
    placed = rows.select(*keys, F.col(MONTH).alias(AT), _range(keys).alias(RANGE))
    _add(lake, keys_table(table), placed, [*keys, AT], RANGE, known)
    for c in columns:
        found = rows.select(c, MONTH).dropna().distinct()
        months = [r[0] for r in found.select(MONTH).distinct().collect()]
        listed = lake.stored(by_table(table, c)).filter(F.col(MONTH).isin(months))
        _add(lake, by_table(table, c), found, [c], MONTH, listed)


def _add(lake: Lake, directory: str, rows: DataFrame, entry: Sequence[str], part: str, listed: DataFrame) -> None:
    """Add the entries that are not listed."""
    missing = rows.join(listed.select(*entry, part), [*entry, part], "left_anti").persist()
    parts = [r[0] for r in missing.select(part).distinct().collect()]
    if parts:
        lake.add_rows(missing, directory, part, parts)
    missing.unpersist()


def months_by(lake: Lake, table: str, column: str, found: DataFrame) -> list[int]:
    """The months listed for the values in `found`, a table with that column."""
    listed = lake.stored(by_table(table, column)).join(found.select(column), column, "left_semi")
    return [r[0] for r in listed.select(MONTH).distinct().collect()]
