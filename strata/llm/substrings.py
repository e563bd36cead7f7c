"""Removal of word windows that an earlier document has too.

First every block of documents sends a count-min sketch of its windows: SKETCH_ROWS rows of
2 ** `sketch_bits` counters, of which only those above zero move. The sketches are merged by
adding up each counter over all blocks. The estimate of a window is the least of its counters,
never too small. In the second pass only windows with an estimate over one are sent and
grouped exactly, by 96 bits of two independent hashes, with the smallest doc_id of each
block. A window that a third of the corpus shares is one key a block.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from strata.llm import blocks as B
from strata.llm import words as W
from strata.llm.ship import ship

WINDOW = 50
SKETCH_ROWS = 2
_LAST = np.iinfo(np.int64).max
_RESULT = "doc_id long, n_words long, n_removed long, kept string"


class _Block:
    """A block's words and windows, the same whenever it is read."""

    def __init__(self, table: pa.Table, length: int):
        self.table = B.in_order(table)
        self.number = table["block"][0].as_py()
        self.data, self.offsets = W.utf8(self.table["text"])
        self.starts, self.ends, self.hashes, self.bounds = W.hashed(self.data, self.offsets)
        self.firsts, rows = W.windows(self.bounds, length)
        self.length = length
        self.keys = W.run_hashes(self.hashes, self.firsts, self.firsts + length)
        # A null doc_id is larger than every other.
        self.ids = self.table["doc_id"].combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)[rows]

    def cells(self, row: int, width: int) -> np.ndarray:
        return W.mix(self.keys, 100 + row) >> np.uint64(64 - width)

    def estimated(self, answers: list[tuple], width: int) -> np.ndarray:
        """Windows whose least counter, over the rows of the merged sketch, is over one."""
        out = np.ones(len(self.keys), bool)
        for row in range(SKETCH_ROWS):
            _, _, back = B.grouped(self.cells(row, width))
            out &= B.bits_of([r for r in answers if r[1] == row])[back] if len(back) else False
        return out

    def distinct(self, chosen: np.ndarray):
        """Of the chosen windows: the order by key and id, each one's group, groups' first."""
        at = np.flatnonzero(chosen)
        second = W.run_hashes(self.hashes, self.firsts[at], self.firsts[at] + self.length, 1) >> np.uint64(32)
        at_order = np.lexsort((self.ids[at], second, self.keys[at]))
        at, second = at[at_order], second[at_order]
        key = self.keys[at]
        new = np.r_[True, (key[1:] != key[:-1]) | (second[1:] != second[:-1])] if len(at) else np.zeros(0, bool)
        return at, second, np.cumsum(new) - 1, np.flatnonzero(new)


def sketch_bits(n_bytes: int) -> int:
    """Counters in a row of the sketch, as a power of two: two to four for each byte of text.
    A window has a word of a byte and a gap for each of its words at least, usually six bytes."""
    return min(56, max(16, math.ceil(math.log2(n_bytes + 1)) + 1))


def _counters(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending counters and their values; nearly all are one, so the others are listed."""
    more = np.flatnonzero(counts > 1)
    return struct.pack("<I", len(more)) + more.astype("<u4").tobytes() + counts[more].astype("<u4").tobytes() + B.pack_sorted(cells)


def _read_counters(body: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    (more,) = struct.unpack_from("<I", body)
    counts = np.ones(n, np.int64)
    counts[np.frombuffer(body, "<u4", more, 4)] = np.frombuffer(body, "<u4", more, 4 + 4 * more)
    return B.unpack_sorted(body[4 + 8 * more :], n), counts


def _added(rows: list[tuple]) -> list[bytes]:
    """The blocks' counters added up. Per counter sent a bit: its sum is over one."""
    cells, counts = (np.concatenate(x) for x in zip(*(_read_counters(r[4], r[3]) for r in rows)))
    _, _, which = B.grouped(cells)
    total = np.bincount(which, counts)
    return [np.packbits(x).tobytes() for x in np.split(total[which] > 1, np.cumsum([r[3] for r in rows])[:-1])]


def _entries(keys: np.ndarray, second: np.ndarray, ids: np.ndarray) -> bytes:
    known, which = np.unique(ids, return_inverse=True)
    body = B.pack_sorted(keys)
    which = which.astype(np.uint16 if len(known) <= 1 << 16 else np.uint32)
    head = struct.pack("<III", len(body), len(known), which.itemsize)
    return head + body + second.astype("<u4").tobytes() + known.astype("<i8").tobytes() + which.tobytes()


def _read_entries(body: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size, known, width = struct.unpack_from("<III", body)
    keys = B.unpack_sorted(body[12 : 12 + size], n)
    at = 12 + size
    second = np.frombuffer(body, "<u4", n, at)
    ids = np.frombuffer(body, "<i8", known, at + 4 * n)
    return keys, second, ids[np.frombuffer(body, np.uint16 if width == 2 else np.uint32, n, at + 4 * n + 8 * known)]


def _smaller_elsewhere(rows: list[tuple]) -> list[bytes]:
    """A bit per entry: another block has the window in a document of smaller doc_id."""
    keys, second, ids = (np.concatenate(x) for x in zip(*(_read_entries(r[4], r[3]) for r in rows)))
    order = np.lexsort((ids, second, keys))
    new = np.r_[True, (np.diff(keys[order]) != 0) | (second[order][1:] != second[order][:-1])]
    least = np.empty(len(keys), np.int64)
    least[order] = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return [np.packbits(x).tobytes() for x in np.split(least < ids, np.cumsum([r[3] for r in rows])[:-1])]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each row's kept words joined by one space."""
    starts, lengths = starts[keep], ends[keep] - starts[keep] + 1
    total = np.r_[0, np.cumsum(lengths)]
    limits = total[np.r_[0, np.cumsum(keep)][bounds]]
    places = np.arange(total[-1]) + np.repeat(starts - total[:-1], lengths)
    out = data[np.minimum(places, max(0, len(data) - 1))] if len(places) else np.zeros(0, np.uint8)
    out[total[1:] - 1] = 32
    filled = np.diff(limits) > 0
    stay = np.ones(len(out), bool)
    stay[limits[1:][filled] - 1] = False
    limits = limits - np.r_[0, np.cumsum(filled)]
    return pa.Array.from_buffers(
        pa.large_string(), len(limits) - 1, [None, pa.py_buffer(limits.astype(np.int64).tobytes()), pa.py_buffer(out[stay].tobytes())]
    )


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    block_bytes: int = B.BLOCK_BYTES,
    carry: Sequence[str] = (),
    as_it_was: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the text without repeated windows.

    A word goes if a window of `window` words that covers it also starts in a document with
    a smaller doc_id; kept has the words that stay, joined by one space. Null and empty
    texts have no words and an empty kept. Rows with equal doc_ids never remove from each
    other; a null doc_id counts as the largest. Columns other than doc_id and text are not
    read, but for those named in `carry`, which come back in the struct `carried`. With
    `as_it_was`, kept is the text itself, null or not, where no word goes. Texts are taken
    whole; a window never spans two documents.
    """
    ship(docs.sparkSession)
    n_bytes = B.text_bytes(docs)
    width = sketch_bits(n_bytes)
    bits = B.range_bits(n_bytes // 6)
    held = B.in_blocks(docs, B.block_count(docs, n_bytes, block_bytes), carry)
    result = StructType.fromDDL(_RESULT)
    if carry:
        result.add("carried", held.schema["carried"].dataType)

    def sketch(table: pa.Table) -> pa.Table:
        block, rows = _Block(table, window), []
        for row in range(SKETCH_ROWS):
            cells, counts = np.unique(block.cells(row, width), return_counts=True)
            rows += [(block.number, row, r, b - a, _counters(cells[a:b], counts[a:b])) for r, a, b in B.cut_ranges(cells, bits, width)]
        return B.sent_table(rows)

    def ask(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, window)
        chosen = block.estimated(B.sent_rows(answers), width)
        at, second, _, firsts = block.distinct(chosen)
        keys, second, ids = block.keys[at][firsts], second[firsts], block.ids[at][firsts]
        rows = [
            (block.number, 0, r, b - a, _entries(keys[a:b], second[a:b], ids[a:b])) for r, a, b in B.cut_ranges(keys, bits)
        ]
        return B.sent_table([*rows, (block.number, B.NOTE, block.number, len(chosen), np.packbits(chosen).tobytes())])

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        block, rows = _Block(table, window), B.sent_rows(answers)
        chosen = B.bits_of([r for r in rows if r[1] == B.NOTE])
        at, _, group, firsts = block.distinct(chosen)
        ids = block.ids[at]
        gone = at[(ids > ids[firsts][group]) | B.bits_of([r for r in rows if r[1] == 0])[group]]
        keep = ~B.covered(block.firsts[gone], window, len(block.starts))
        counts = np.diff(np.r_[0, np.cumsum(~keep)][block.bounds])
        kept = joined(block.data, block.starts, block.ends, block.bounds, keep).cast(pa.string())
        if as_it_was:
            kept = pc.if_else(pa.array(counts == 0), block.table["text"], pa.chunked_array([kept]))
        out = {"doc_id": block.table["doc_id"], "n_words": np.diff(block.bounds), "n_removed": counts, "kept": kept}
        return pa.table(out | ({"carried": block.table["carried"]} if carry else {}))

    by_block = held.groupBy("block")
    counted = B.answered(by_block.applyInArrow(sketch, B.SENT), _added)
    asked = by_block.cogroup(counted.groupBy("block")).applyInArrow(ask, B.SENT)
    exact = B.answered(asked, _smaller_elsewhere)
    return by_block.cogroup(exact.groupBy("block")).applyInArrow(remove, result)
