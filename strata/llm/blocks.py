"""Documents in blocks, and questions that all blocks ask a range of sorted keys.

Operators that look for repeats keep the texts where they are, in blocks of a few
megabytes, and move only keys. Each block sends its distinct keys, sorted and cut into
ranges, one row per block and range. A range sees the keys of all blocks and answers with
one small array per block in the order the block had sent. A key that a third of the corpus
shares reaches its range once per block, not once per document.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
RANGE_KEYS = 1 << 20
#: Rows of this kind, and of any below 0, are notes of a block to itself; they come back as they are.
NOTE = -1
SENT = "block long, kind long, range long, n long, body binary"


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).head()[0] or 0


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_count(df: DataFrame, n_bytes: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(shuffle_partitions(df), math.ceil(n_bytes / block_bytes), 1)


def block_of(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n))


def range_bits(n_keys: int, per_range: int = RANGE_KEYS) -> int:
    """Bits of the range number: about `per_range` keys fall into each range."""
    return max(0, math.ceil(math.log2(max(1, n_keys / per_range))))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as gaps of the fewest bytes that suit most of them.

    A gap that does not fit is written as the largest number of its width and repeated in
    full behind the others.
    """
    gaps = np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)
    if not len(gaps):
        return b"\x01"
    width = int(min(8, max(1, math.ceil((math.log2(float(np.mean(gaps.astype(np.float64))) + 1) + 2) / 8))))
    if width == 8:
        return b"\x08" + gaps.tobytes()
    top = np.uint64((1 << (8 * width)) - 1)
    short = np.minimum(gaps, top)
    body = short.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return bytes([width]) + body + gaps[short == top].tobytes()


def unpack_sorted(body: bytes, n: int) -> np.ndarray:
    width = body[0]
    if not n:
        return np.zeros(0, np.uint64)
    if width == 8:
        return np.cumsum(np.frombuffer(body, np.uint64, n, 1))
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(body, np.uint8, n * width, 1).reshape(n, width)
    gaps = gaps.reshape(-1).view(np.uint64)
    escaped = gaps == np.uint64((1 << (8 * width)) - 1)
    if escaped.any():
        gaps[escaped] = np.frombuffer(body, np.uint64, int(escaped.sum()), 1 + n * width)
    return np.cumsum(gaps)


def cut_ranges(keys: np.ndarray, bits: int, width: int = 64) -> Iterator[tuple[int, int, int]]:
    """(range, first, last) of the non-empty ranges of ascending keys of `width` bits, by
    their top bits."""
    if not len(keys):
        return
    if not bits:
        yield 0, 0, len(keys)
        return
    numbers = keys >> np.uint64(width - bits)
    firsts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
    for a, b in zip(firsts, np.r_[firsts[1:], len(keys)]):
        yield int(numbers[a]), int(a), int(b)


def quoted(name: str) -> str:
    """A column by its name, whatever signs are in it."""
    return f"`{name.replace('`', '``')}`"


def carried(columns: Sequence[str]) -> Column:
    """Columns that an operator takes along, in one."""
    return F.struct(*[F.col(quoted(c)) for c in columns]).alias("carried")


def in_blocks(docs: DataFrame, n: int, carry: Sequence[str] = ()) -> DataFrame:
    """(block, doc_id, text), dealt into n blocks, and the columns `carry` in one, `carried`.

    Used several times in one query, its exchange is made once and read again.
    """
    more = [carried(carry)] if carry else []
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)
    return read.withColumn("block", block_of(n, "doc_id", "text")).repartition(n, "block")


def in_order(table: pa.Table) -> pa.Table:
    """A block's rows in an order that does not depend on how they came."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def sent_table(rows: list[tuple]) -> pa.Table:
    block, kind, rng, n, body = zip(*rows) if rows else ((),) * 5
    return pa.table(
        {
            "block": pa.array(block, pa.int64()),
            "kind": pa.array(kind, pa.int64()),
            "range": pa.array(rng, pa.int64()),
            "n": pa.array(n, pa.int64()),
            "body": pa.array(body, pa.binary()),
        }
    )


def sent_rows(table: pa.Table, kind: int | None = None) -> list[tuple[int, int, int, int, bytes]]:
    """The rows of a sent table, of one kind if given, in ascending order of range and block."""
    rows = zip(*(table[c].to_pylist() for c in ("block", "kind", "range", "n", "body")))
    return sorted((r for r in rows if kind is None or r[1] == kind), key=lambda r: (r[1], r[2], r[0]))


def answered(sent: DataFrame, answer: Callable[[list[tuple]], list[bytes]]) -> DataFrame:
    """What `answer` says to each row, asked with all rows of a kind and range at once."""

    def one(table: pa.Table) -> pa.Table:
        rows = sent_rows(table)
        if rows[0][1] < 0:
            return sent_table(rows)
        return sent_table([(*r[:4], body) for r, body in zip(rows, answer(rows))])

    return sent.groupBy("kind", "range").applyInArrow(one, SENT)


def repeated_across(rows: list[tuple]) -> list[bytes]:
    """A bit per key: another block sent it too."""
    runs = [unpack_sorted(body, n) for *_, n, body in rows]
    keys = np.sort(np.concatenate(runs))
    twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
    return [np.packbits(member(run, twice)).tobytes() for run in runs]


def order_of(keys: np.ndarray) -> np.ndarray:
    """An order that sorts unsigned 64-bit keys.

    Numpy sorts numbers several times faster than it sorts places by them. So a place takes
    the lowest bits of its key, which mostly differ above them; where they do not, the
    slower sort decides.
    """
    n = len(keys)
    if n < 2:
        return np.arange(n)
    low = np.uint64(n.bit_length())
    up = np.uint64(64 - int(keys.max()).bit_length())
    mask = (np.uint64(1) << low) - np.uint64(1)
    packed = ((keys << up) & ~mask) | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & mask).astype(np.int64)
    ranked = keys[order]
    return np.argsort(keys) if (ranked[1:] < ranked[:-1]).any() else order


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, ascending; a place of each; and for every key which one it is."""
    order = order_of(keys)
    ranked = keys[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]] if len(keys) else np.zeros(0, bool)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return ranked[new], order[new], which


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of `length` that begins at one of `starts`."""
    marks = np.zeros(n + 1, np.int32)
    marks[starts + 1] = 1
    total = np.cumsum(marks, dtype=np.int32)
    out = total[1:] > 0
    if n > length:
        out[length:] = total[length + 1 :] > total[1 : n + 1 - length]
    return out


def member(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which ascending keys are in another ascending array, by binary search."""
    if not len(among):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys


def bits_of(rows: list[tuple]) -> np.ndarray:
    """The answers of a block's ranges, one after another."""
    if not rows:
        return np.zeros(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(r[4], np.uint8), count=r[3]).astype(bool) for r in rows])
