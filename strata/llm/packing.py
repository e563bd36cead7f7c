"""Best-fit packing of documents into token sequences, by parts and then up a tree.

Each part packs its pieces best-fit, longest first. Bins with no room for even the shortest
piece are done. All others are handed up as items of their size and packed best-fit again,
in as many groups as their number asks for, an eighth of the groups before as a rule, and so
on until they meet in one group. Only piece numbers and sizes are moved.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.ship import ship
from strata.llm.tokens import Encoder, tokenizer_json
from strata.sources.staging import stage

PART_ITEMS = 20_000
FAN = 8
_PLACED = "item long, bin long, place long, size long, open boolean"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids with `end_id` behind.

    Documents over the capacity are cut into full pieces; the first may be shorter.
    """
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer_json(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.held_by_worker(source.value), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            text, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for a, b in W.parts(W.utf8(text)[1]):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], encoder.encode(text.slice(a, b - a).to_pylist())):
                    ids += end
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    cuts = [0, *range(first, n + 1, capacity)]
                    rows += [
                        (doc_id, i, s, e - s, zlib.crc32(ids[4 * s : 4 * e]))
                        for i, (s, e) in enumerate(zip(cuts, cuts[1:]))
                    ]
                doc, piece, start, length, crc = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and place of each item, longest first into the fullest bin with room; bins' fill.

    The bins with r tokens of room are a list; one number has a bit for each r in use.
    """
    bins, places = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fill: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i in np.lexsort((np.arange(len(sizes)), -sizes)).tolist():
        size = int(sizes[i])
        fits = used >> size
        if fits:
            room = size + ((fits & -fits).bit_length() - 1)
            target = with_room[room].pop()
            if not with_room[room]:
                used ^= 1 << room
        else:
            room, target = capacity, len(fill)
            fill.append(0)
        bins[i], places[i] = target, fill[target]
        fill[target] += size
        room -= size
        if room:
            with_room[room].append(target)
            used |= 1 << room
    return bins, places, fill


def _round(items: DataFrame, level: int, groups: int, capacity: int, least: int) -> DataFrame:
    """Pack (item, size, part) by part. A row per item: its bin, place, the bin's fill and
    whether the bin is open. A bin's number has its level, part and rank."""

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("item", "ascending")])
        sizes, part = table["size"].to_numpy(), table["part"][0].as_py()
        bins, places, fill = best_fit(sizes, capacity)
        filled = np.array(fill)
        is_open = capacity - filled >= least
        return pa.table(
            {
                "item": table["item"],
                "bin": pa.array((level << 56) + (part << 24) + bins),
                "place": pa.array(places),
                "size": pa.array(filled[bins]),
                "open": pa.array(is_open[bins]),
            }
        )

    parted = items.select("item", "size", F.pmod(F.xxhash64("item"), F.lit(groups)).alias("part"))
    return stage(parted.groupBy("part").applyInArrow(one, _PLACED))


def pack(pieces: DataFrame, capacity: int, part_items: int = PART_ITEMS) -> DataFrame:
    """(item, sequence_id, offset) for rows (item, size); item is unique, 0 < size <= capacity.

    Full items are sequences of their own. A part hands up every bin with room for the
    shortest item, and of those the ones stay that the least of them fits: no other could be
    joined with any. The next round has an eighth of the groups, or more if the bins would
    make a group of more than `part_items`. Rounds end with one group, with bins that do not
    fit each other, or when a round no longer lowers their number.
    The sizes of open bins come to the driver, at most `capacity` numbers.
    """
    full = pieces.where(F.col("size") >= capacity).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("size") < capacity)
    n, least = rest.agg(F.count("*"), F.min("size")).head()
    if not n:
        return full
    groups, level = max(1, math.ceil(n / part_items)), 1
    placed = [_round(rest, level, groups, capacity, least)]
    before = n
    while groups > 1:
        handed = placed[-1].where("open").select(F.col("bin").alias("item"), "size").distinct()
        sizes = {r["size"]: r["count"] for r in handed.groupBy("size").count().collect()}
        least = min(sizes, default=capacity)
        bins = sum(count for size, count in sizes.items() if size + least <= capacity)
        if bins < 2 or bins >= before:
            break
        groups, level, before = max(math.ceil(groups / FAN), math.ceil(bins / part_items)), level + 1, bins
        placed.append(_round(handed.where(F.col("size") + least <= capacity), level, groups, capacity, least))
    # From the top: where each bin of a level ends up; a bin that was not handed up stays.
    final = placed[-1].select("item", "bin", "place")
    for lower in reversed(placed[:-1]):
        above = final.select(F.col("item").alias("bin"), F.col("bin").alias("top"), F.col("place").alias("above"))
        final = lower.join(above, "bin", "left").select(
            "item", F.coalesce("top", "bin").alias("bin"), (F.col("place") + F.coalesce("above", F.lit(0))).alias("place")
        )
    return full.unionByName(final.select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset")))


def packed(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), a row per piece.

    Null texts are empty and make a piece of the end id alone. Rows with equal doc_ids are
    packed each for itself; null doc_ids stay null. An empty table gives no rows. Columns
    other than doc_id and text are not read.
    """
    cut = stage(pieces(docs, tokenizer, end_id, capacity).withColumn("item", F.monotonically_increasing_id()))
    where = pack(cut.select("item", F.col("length").alias("size")), capacity)
    return cut.join(where, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
