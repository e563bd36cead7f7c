"""Removal of byte strings that occur anywhere else, by suffix arrays.

Texts lie in shards. A window of 200 bytes is named by the least hash among its 32-byte
grams, so equal windows have equal names; only windows whose name occurs at two places of
the corpus go on. Each shard builds a suffix array of the bytes those windows cover, by
Larsson-Sadakane refinement, and Kasai's common prefixes cut it into classes of equal
windows. One window of each class goes out, as sorted runs of fingerprints; ranges merge the
runs of all shards pair by pair, each entry finding its place by binary search, and tell each
shard which of its own are elsewhere by searching the merged run.

Copies of a whole text are settled by their digest: one of them stays to be searched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import blocks as B
from strata.llm import words as W
from strata.llm.ship import ship

LENGTH = 200
GRAM = 32
SHARD_BYTES = 4 << 20
_NAME_BITS = 40
_LANES = 16384
_ROWS, _CHOSEN, _LOCAL, _NAMES = -1, -2, -3, -4
_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in ascending order. The first four bytes are sorted as numbers; then each
    round sorts the groups that are still equal by the ranks as far ahead as the sorted
    length reaches, which doubles it, and leaves single suffixes alone."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # Nine bits a byte, so that the end of the text is less than any byte.
    word = np.zeros(n + 4, np.uint64)
    word[:n] = text
    word[:n] += np.uint64(1)
    for step in (1, 2):
        word[:-step] = (word[:-step] << np.uint64(9 * step)) | word[step:]
    key = word[:n]
    sa = B.order_of(key)
    key = key[sa]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[first, n])
    rank = np.full(n + 1, -1, np.int64)
    rank[sa] = np.repeat(first, size)
    open_at, h = np.flatnonzero(np.repeat(size > 1, size)), 4
    ahead_bits = np.uint64((n + 1).bit_length())
    while len(open_at):
        p = sa[open_at]
        own = rank[p]
        group = np.cumsum(np.r_[True, own[1:] != own[:-1]], dtype=np.uint64) - np.uint64(1)
        key = (group << ahead_bits) | (rank[np.minimum(p + h, n)] + 1).astype(np.uint64)
        order = B.order_of(key)
        p, key = p[order], key[order]
        sa[open_at] = p
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(p)])
        rank[p] = np.repeat(open_at[first], size)
        open_at = open_at[np.repeat(size > 1, size)]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, that each suffix shares with the one before it in order.

    Kasai's rule that the length falls by at most one from a suffix to the next of the text,
    followed in many stretches of the text side by side, eight bytes at a time.
    """
    n = len(sa)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    word = np.zeros(n + most + 16, np.uint64)
    word[:n] = text
    for step in (1, 2, 4):
        word[:-step] |= word[step:] << np.uint64(8 * step)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    lanes = max(1, min(_LANES, n // 64))
    length = -(-n // lanes)
    firsts, shared = np.arange(lanes) * length, np.zeros(lanes, np.int64)
    for t in range(length):
        place = firsts + t
        lane = np.flatnonzero((place < n) & (before[np.minimum(place, n - 1)] >= 0))
        p = place[lane]
        j, h = before[p], shared[lane]
        todo = np.arange(len(lane))
        while len(todo):
            diff = word[p[todo] + h[todo]] ^ word[j[todo] + h[todo]]
            low = diff & (~diff + np.uint64(1))
            same = np.where(diff == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3).astype(np.int64)
            h[todo] += same
            todo = todo[(same == 8) & (h[todo] < most)]
        h = np.minimum(np.minimum(h, most), n - np.maximum(p, j))
        shared[:] = 0
        shared[lane] = np.maximum(h - 1, 0)
        out[p] = h
    return out[sa]


def _least_of(values: np.ndarray, width: int, lower: bool = True) -> np.ndarray:
    """Least (or largest) of each run of `width` values; the last ones see what is left."""
    pick = np.minimum if lower else np.maximum
    out, step = values.copy(), 1
    while step < width:
        move = min(step, width - step)
        out[:-move] = pick(out[:-move], out[move:])
        step += move
    return out


def _byte_hashes(data: np.ndarray, first: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of the strings of `length` bytes that begin at the given places."""
    up, down = W._BYTES.upto(len(data) + 1)
    letters = W.mix(W._LETTER, seed) if seed else W._LETTER
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * up[:-1], out=total[1:])
        return W.mix((total[first + length] - total[first]) * down[first], seed)


def _starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """Whether a string of `length` bytes of one row begins at each byte."""
    out = np.zeros(int(offsets[-1]) + 1, np.int64)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    np.add.at(out, offsets[:-1], counts > 0)
    np.add.at(out, offsets[:-1] + counts, -1 * (counts > 0))
    return np.cumsum(out[:-1]) > 0


class _Shard:
    """The rows of a block that are searched, one after another."""

    def __init__(self, table: pa.Table, length: int):
        self.table, self.length = B.in_order(table), length
        self.number = table["block"][0].as_py()
        self.data, self.offsets = W.utf8(self.table["text"])

    def searched(self, of_row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Place, bytes and offsets of stretches of rows; other rows are left out as empty."""
        for a, b in W.parts(self.offsets):
            if of_row[a:b].any():
                base = int(self.offsets[a])
                yield base, self.data[base : int(self.offsets[b])], self.offsets[a : b + 1] - base

    def windows(self, offsets: np.ndarray, of_row: np.ndarray, base: int) -> np.ndarray:
        rows = np.searchsorted(self.offsets, base + offsets[:-1], side="right") - 1
        starts = _starts(offsets, self.length)
        if not of_row[rows].all():
            lengths = np.diff(offsets)
            starts &= np.repeat(of_row[rows], lengths)
        return starts

    def names(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each window's name, and the hash of each place's gram."""
        n = len(data) - GRAM + 1
        grams = np.full(len(data), np.iinfo(np.uint64).max, np.uint64)
        if n > 0:
            grams[:n] = _byte_hashes(data, np.arange(n), GRAM)
        return np.where(starts, _least_of(grams, self.length - GRAM + 1), np.uint64(0)), grams


def _named(shard: _Shard, of_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names of the shard's windows with the number of places that have them."""
    found = [np.zeros(0, np.uint64)]
    for base, data, offsets in shard.searched(of_row):
        starts = shard.windows(offsets, of_row, base)
        names, grams = shard.names(data, starts)
        reach = shard.length - GRAM + 1
        best = _least_of(names[::-1], reach, lower=False)[::-1]
        found.append(grams[(best == grams) & (best > 0)] >> np.uint64(64 - _NAME_BITS))
    return np.unique(np.concatenate(found), return_counts=True)


def _candidates(shard: _Shard, of_row: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """Places of the windows whose name is a repeated one."""
    out = [np.zeros(0, np.int64)]
    for base, data, offsets in shard.searched(of_row):
        starts = shard.windows(offsets, of_row, base)
        names, _ = shard.names(data, starts)
        first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
        hit = B.member(names[first] >> np.uint64(64 - _NAME_BITS), repeated)
        out.append(base + np.flatnonzero(np.repeat(hit, np.diff(np.r_[first, len(names)])) & starts))
    return np.concatenate(out)


def _fingerprints(shard: _Shard, places: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(places), np.uint64)
    for a, b in W.parts(shard.offsets):
        base, end = int(shard.offsets[a]), int(shard.offsets[b])
        i, j = np.searchsorted(places, [base, end])
        if j > i:
            out[i:j] = _byte_hashes(shard.data[base:end], places[i:j] - base, shard.length, seed)
    return out


def _classes(shard: _Shard, places: np.ndarray) -> np.ndarray:
    """Class of each window: equal strings of the shard have equal numbers."""
    cover = B.covered(places, shard.length, len(shard.data))
    text = shard.data[cover]
    sa = suffix_array(text)
    shared = common_prefixes(text, sa, shard.length)
    of_place = np.empty(len(text), np.int64)
    of_place[sa] = np.cumsum(shared < shard.length)
    return of_place[(np.cumsum(cover, dtype=np.int32) - 1)[places]]


def _with_rest(keys: np.ndarray, rest: np.ndarray, width: int) -> bytes:
    """Ascending keys with `width` more bytes of a second hash each."""
    return B.pack_sorted(keys) + rest.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _places(keys: np.ndarray, rest: np.ndarray, run: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Where each pair of (keys, rest) stands or belongs in an ascending run of such pairs, by
    binary search: for the key first, then for the second hash among equal keys."""
    at, end = (np.searchsorted(run[0], keys, side) for side in ("left", "right"))
    todo = np.flatnonzero(end - at > 1)
    last = end.copy()
    while len(todo):
        middle = (at[todo] + last[todo]) // 2
        less = run[1][middle] < rest[todo]
        at[todo[less]], last[todo[~less]] = middle[less] + 1, middle[~less]
        todo = todo[at[todo] < last[todo]]
    # Of a single equal key only the second hash is left to ask.
    one = np.flatnonzero(end - at == 1)
    at[one] += run[1][at[one]] < rest[one]
    return at


def _found(keys: np.ndarray, rest: np.ndarray, run: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of the pairs, and which of them the run has."""
    at = _places(keys, rest, run)
    has = at < len(run[0])
    has[has] = (run[0][at[has]] == keys[has]) & (run[1][at[has]] == rest[has])
    return at, has


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One run of all pairs, and which of them are in several runs: neighbours are merged
    level by level, the shorter one's entries finding their places in the longer one."""
    level = [(keys, rest, np.zeros(len(keys), bool)) for keys, rest in runs]
    while len(level) > 1:
        above = [] if len(level) % 2 == 0 else [level.pop()]
        for a, b in zip(level[::2], level[1::2]):
            long, short = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
            at, has = _found(short[0], short[1], long[:2])
            again = long[2].copy()
            again[at[has]] = True
            above.append(tuple(np.insert(x, at[~has], y[~has]) for x, y in zip((*long[:2], again), short)))
        level = above
    return level[0]


def _elsewhere(rows: list[tuple], width: int) -> list[bytes]:
    """A bit per entry of each sorted run: another shard's run has it too."""
    runs = []
    for *_, n, body in rows:
        keys = B.unpack_sorted(body, n)
        rest = np.zeros((n, 8), np.uint8)
        if width:
            rest[:, :width] = np.frombuffer(body[len(body) - n * width :], np.uint8).reshape(n, width)
        runs.append((keys, rest.reshape(-1).view(np.uint64)))
    *whole, again = _merged(runs)
    out = []
    for keys, rest in runs:
        at, _ = _found(keys, rest, whole)
        out.append(np.packbits(again[at]).tobytes())
    return out


def without_copies(docs: DataFrame, length: int = LENGTH, block_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row, over UTF-8 bytes.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in
    another document or the same; overlaps count, all places are judged on the input, and
    no match spans two documents. kept has the other bytes; n_spans counts the maximal runs
    that went. Null and empty texts have no bytes. Every row is a document of its own, rows
    that repeat a doc_id and rows with a null one too. Columns other than doc_id and text
    are not read. `length` is more than 32. Strings of different shards are compared by
    hashes of 64 bits and more, as many as keep the chance of any false match below one in
    a thousand; those of one shard by their bytes.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    ship(docs.sparkSession)
    n_bytes = B.text_bytes(docs)
    n_blocks = B.block_count(docs, n_bytes, block_bytes)
    bits = B.range_bits(n_bytes // 5)
    extra = min(8, max(0, math.ceil((2 * math.log2(n_bytes + 1) + 9 - 64) / 8)))
    held = B.in_blocks(docs, n_blocks).withColumn("digest", F.md5("text"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") >= length)
    digests = texts.select(B.block_of(n_blocks, "doc_id", "text").alias("at"), F.md5("text").alias("known"))
    at = digests.groupBy("known", "at").agg(F.count("*").alias("here"))
    copied = at.groupBy("known").agg(F.sum("here").alias("copies"), F.min("at").alias("home")).where("copies > 1")
    copied = at.join(copied, "known").select("at", "known", (F.col("at") == F.col("home")).alias("stays"))

    def name(table: pa.Table, copies: pa.Table) -> pa.Table:
        shard = _Shard(table, length)
        stays = dict(zip(copies["known"].to_pylist(), copies["stays"].to_pylist()))
        # 1: searched; 2: a copy, gone as a whole; 3: a copy that is searched for the others' sake.
        kinds = np.ones(table.num_rows, np.uint8)
        for i, digest in enumerate(shard.table["digest"].to_pylist()):
            if digest in stays:
                kinds[i] = 3 if stays[digest] else 2
                stays[digest] = False
        names, counts = _named(shard, kinds != 2)
        rows = [
            (shard.number, 0, r, b - a, B.pack_sorted(names[a:b]))
            for r, a, b in B.cut_ranges(names, min(bits, _NAME_BITS), _NAME_BITS)
        ]
        local = (shard.number, _LOCAL, shard.number, len(counts), np.packbits(counts > 1).tobytes())
        own = (shard.number, _NAMES, shard.number, len(names), B.pack_sorted(names))
        return B.sent_table([*rows, local, own, (shard.number, _ROWS, shard.number, len(kinds), kinds.tobytes())])

    def search(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard, rows = _Shard(table, length), B.sent_rows(answers)
        note = next(r for r in rows if r[1] == _ROWS)
        kinds = np.frombuffer(note[4], np.uint8)
        names = next(B.unpack_sorted(r[4], r[3]) for r in rows if r[1] == _NAMES)
        repeated = names[B.bits_of([r for r in rows if r[1] == 0]) | B.bits_of([r for r in rows if r[1] == _LOCAL])]
        places = _candidates(shard, kinds != 2, repeated)
        classes = _classes(shard, places)
        counts = np.bincount(classes, minlength=1)
        # One window of each class goes out.
        first = np.empty(len(counts), np.int64)
        first[classes[::-1]] = np.arange(len(classes))[::-1]
        windows = places[np.sort(first[counts > 0])]
        keys_out, one, _ = B.grouped(_fingerprints(shard, windows, 0))
        rest = _fingerprints(shard, windows, 1)[one]
        sent = [
            (shard.number, 0, r, b - a, _with_rest(keys_out[a:b], rest[a:b], extra)) for r, a, b in B.cut_ranges(keys_out, bits)
        ]
        marks = np.zeros(len(shard.data), bool)
        marks[places] = True
        return B.sent_table(
            [
                *sent,
                note,
                (shard.number, _CHOSEN, shard.number, len(marks), np.packbits(marks).tobytes()),
                (shard.number, _LOCAL, shard.number, len(places), np.packbits(counts[classes] > 1).tobytes()),
            ]
        )

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        shard, rows = _Shard(table, length), B.sent_rows(answers)
        kinds = np.frombuffer(next(r for r in rows if r[1] == _ROWS)[4], np.uint8)
        places = np.flatnonzero(B.bits_of([r for r in rows if r[1] == _CHOSEN]))
        _, _, back = B.grouped(_fingerprints(shard, places, 0))
        found = B.bits_of([r for r in rows if r[1] == 0])
        gone = B.bits_of([r for r in rows if r[1] == _LOCAL])
        if len(places):
            gone = gone | found[back]
        lost = B.covered(places[gone], length, len(shard.data))
        lost |= np.repeat(kinds > 1, np.diff(shard.offsets))
        total = np.r_[0, np.cumsum(lost)]
        new = lost.copy()
        new[1:] &= ~lost[:-1]
        edges = shard.offsets[:-1][np.diff(shard.offsets) > 0]
        new[edges] = lost[edges]
        runs = np.r_[0, np.cumsum(new)]
        limits = np.r_[0, np.cumsum(~lost)][shard.offsets]
        kept = pa.Array.from_buffers(
            pa.large_binary(), table.num_rows, [None, pa.py_buffer(limits.astype(np.int64).tobytes()), pa.py_buffer(shard.data[~lost].tobytes())]
        )
        ends = shard.offsets
        return pa.table(
            {
                "doc_id": shard.table["doc_id"],
                "n_bytes": np.diff(ends),
                "n_removed": total[ends[1:]] - total[ends[:-1]],
                "n_spans": runs[ends[1:]] - runs[ends[:-1]],
                "kept": kept.cast(pa.binary()),
            }
        )

    by_block = held.groupBy("block")
    named = B.answered(by_block.cogroup(copied.groupBy("at")).applyInArrow(name, B.SENT), B.repeated_across)
    searched = by_block.cogroup(named.groupBy("block")).applyInArrow(search, B.SENT)
    merged = B.answered(searched, lambda rows: _elsewhere(rows, extra))
    return by_block.cogroup(merged.groupBy("block")).applyInArrow(remove, _RESULT)
