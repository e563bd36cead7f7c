"""Near duplicates among vectors of a label, by a pigeonhole over subspaces.

For unit vectors a cosine of at least t means a squared distance of at most 2 - 2t. After a
random rotation the dimensions are cut into blocks, each with a share of that budget in
proportion to its dimensions: a pair within the whole budget is within the share of at
least one block. Each block is a range join: vectors go to the grid cell of their first
coordinates in the block and, as guests, to the next cells up within reach. Two vectors that
are near in every coordinate meet in the cell of the higher ones, where in no coordinate both
are guests. A cell with many vectors is split by one more coordinate of the block, as long as
there are some. The union of the pairs within a share is verified on the vectors themselves,
in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import topk
from strata.llm.graph import components
from strata.llm.ship import ship
from strata.llm.words import mix
from strata.sources.staging import stage

BLOCK_DIMS = 8
#: Coordinates that make a cell at first; a cell of more rows takes further ones.
GRID = 2
CELL_ROWS = 2048
TILE_ROWS = 4096
BUCKET_ROWS = 1 << 16
_SLACK = 1e-4
_CELLS = "cell long, guest int, cls long, y binary, reach double"


@lru_cache(maxsize=16)
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    return np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))[0]


def subspaces(dim: int, block_dims: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    """Blocks of about `block_dims` dimensions, as first and last."""
    cuts = np.linspace(0, dim, max(1, round(dim / block_dims)) + 1).astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; large components are scaled first, so squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _cut(key: np.ndarray, guest: np.ndarray, y: np.ndarray, reach: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells cut by coordinate i: the rows, with repeats, their new cells, and in which
    coordinates they are guests there."""
    width = 2 * reach
    at = np.floor(y[:, i] / width)
    near = np.flatnonzero(y[:, i] - at * width >= width - reach)
    rows = np.r_[np.arange(len(key)), near]
    cell = np.r_[at, at[near] + 1].astype(np.int64).view(np.uint64)
    return rows, mix(key[rows] ^ cell, i), np.r_[guest, guest[near] | (1 << i)]


def _batch(key: np.ndarray, guest: np.ndarray, cls: np.ndarray, y: np.ndarray, reach: np.ndarray) -> pa.RecordBatch:
    bodies = pa.py_buffer(np.ascontiguousarray(y, np.float32))
    ends = pa.py_buffer((np.arange(len(y) + 1) * 4 * y.shape[1]).astype(np.int32))
    arrays = [
        pa.array(key.view(np.int64)),
        pa.array(guest.astype(np.int32)),
        pa.array(cls),
        pa.Array.from_buffers(pa.binary(), len(y), [None, ends, bodies]),
        pa.array(reach),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["cell", "guest", "cls", "y", "reach"])


def _cells(label: np.ndarray, cls: np.ndarray, vectors: np.ndarray, least: float) -> Iterator[pa.RecordBatch]:
    dim = vectors.shape[1]
    turned = unit(vectors) @ rotation(dim)
    budget = max(0.0, 2 - 2 * least)
    for number, (a, b) in enumerate(subspaces(dim)):
        # As they are stored, so that later cuts see the same coordinates.
        y = turned[:, a:b].astype(np.float32).astype(float)
        reach = np.full(len(y), math.sqrt(budget * (b - a) / dim) + _SLACK)
        rows, key, guest = np.arange(len(y)), mix(label.astype(np.uint64), 1000 * dim + number), np.zeros(len(y), np.int64)
        for i in range(min(GRID, b - a)):
            taken, key, guest = _cut(key, guest, y[rows], reach[rows], i)
            rows = rows[taken]
        yield _batch(key, guest, cls[rows], y[rows], reach[rows])


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each length, and their coordinates."""
    sizes = np.asarray(pc.binary_length(column)) // 4
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(column.take(pa.array(at)).to_pylist()), np.float32).reshape(len(at), size).astype(float)


def _finer(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
    """The rows of crowded cells in cells that coordinate i cuts, if they have it."""
    for at, y in _by_length(batch.column("y")):
        part = batch.take(pa.array(at))
        if y.shape[1] <= i:
            yield part
            continue
        key, guest, cls, reach = (part.column(c).to_numpy() for c in ("cell", "guest", "cls", "reach"))
        rows, key, guest = _cut(key.view(np.uint64), guest, y, reach, i)
        yield _batch(key, guest, cls[rows], y[rows], reach[rows])


def _counted(placed: DataFrame) -> DataFrame:
    """(cell, n, dims) of the cells in which two vectors can meet: not all are guests in one coordinate."""
    counts = placed.groupBy("cell").agg(F.count("*").alias("n"), F.bit_and("guest").alias("guests"), F.max(F.octet_length("y") / 4).alias("dims"))
    return stage(counts.where("n > 1 and guests = 0").drop("guests"))


def _split(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows in cells of at most CELL_ROWS rows, if their block has coordinates enough to
    cut by, and the cells in which vectors can meet."""
    i, cells = GRID, _counted(placed)
    while True:
        crowded = cells.where((F.col("n") > CELL_ROWS) & (F.col("dims") > i)).select("cell")
        if crowded.isEmpty():
            return placed, cells
        cut = placed.join(crowded, "cell").select(placed.columns).mapInArrow(lambda x, i=i: (out for b in x for out in _finer(b, i)), _CELLS)
        rest = placed.join(cells.join(crowded, "cell", "left_anti"), "cell", "left_semi")
        placed = stage(rest.unionByName(cut))
        i, cells = i + 1, _counted(placed)


def _pairs_within(y: np.ndarray, guest: np.ndarray, cls: np.ndarray, tile: np.ndarray, i: int, j: int, reach: float) -> np.ndarray:
    """Pairs of tiles i and j within reach, smaller class first, if no coordinate has both as guests."""
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    out = []
    square = (y * y).sum(axis=1)
    for mask in np.unique(guest[left]):
        among = right[guest[right] & mask == 0]
        mine = left[guest[left] == mask] if len(among) else left[:0]
        for a in range(0, len(mine), 512):
            rows = mine[a : a + 512]
            distance = square[rows][:, None] + square[among][None, :] - 2 * (y[rows] @ y[among].T)
            r, c = np.nonzero(distance <= reach * reach)
            p, q = rows[r], among[c]
            swap = cls[p] > cls[q]
            p, q = np.where(swap, q, p), np.where(swap, p, q)
            good = (cls[p] < cls[q]) & ((i != j) | ~swap)
            out.append(np.stack([cls[p[good]], cls[q[good]]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _in_bucket(table: pa.Table) -> pa.Table:
    """Pairs within reach in every (cell, i, j) of a bucket."""
    table = table.sort_by([("cell", "ascending"), ("i", "ascending"), ("j", "ascending")])
    keys = [table[c].to_numpy() for c in ("cell", "i", "j")]
    guest, cls, tile, reach = (table[c].to_numpy() for c in ("guest", "cls", "tile", "reach"))
    bodies = table["y"].to_pylist()
    new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]
    firsts = np.flatnonzero(new)
    found = [np.zeros((0, 2), np.int64)]
    for a, b in zip(firsts, np.r_[firsts[1:], len(cls)]):
        if b - a > 1 and len({len(x) for x in bodies[a:b]}) == 1:
            y = np.frombuffer(b"".join(bodies[a:b]), np.float32).reshape(b - a, -1).astype(float)
            i, j = int(keys[1][a]), int(keys[2][a])
            found.append(_pairs_within(y, guest[a:b], cls[a:b], tile[a:b], i, j, float(reach[a])))
    pairs = np.concatenate(found)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _cosines(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.asarray(pc.list_value_length(batch.column("v")))
        keep = np.zeros(batch.num_rows, bool)
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            part = batch.take(pa.array(at))
            left, right = (unit(topk.matrix(pa.chunked_array([part.column(c)]), dim).astype(float)) for c in ("v", "w"))
            keep[at] = np.einsum("ij,ij->i", left, right) >= least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def links(classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b), a < b, of classes (cls, label, v) of one label with cosine >= least.

    A cell with more rows than a tile holds is cut into tiles, and each pair of tiles is
    work of its own, so no task holds a crowded cell.
    """
    spark = classes.sparkSession
    ship(spark)
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch.column("v")))
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                vectors = topk.matrix(pa.chunked_array([part.column("v")]), dim).astype(float)
                yield from _cells(part.column("label").to_numpy(), part.column("cls").to_numpy(), vectors, least)

    placed = stage(classes.select("label", "cls", "v").mapInArrow(cells, _CELLS))
    placed, crowd = _split(placed)
    crowd = crowd.select("cell", "n", F.ceil(F.col("n") / TILE_ROWS).alias("tiles"))
    # A row meets every tile of its cell.
    total = crowd.agg(F.sum(F.col("n") * F.col("tiles"))).head()[0] or 0
    tiles = placed.join(crowd.select("cell", "tiles"), "cell").withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")))
    dealt = tiles.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))).select(
        "cell", "guest", "cls", "y", "reach", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")
    )
    buckets = F.lit(max(1, math.ceil(total / BUCKET_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    near = dealt.groupBy(F.pmod(F.xxhash64("cell", "i", "j"), buckets).alias("bucket")).applyInArrow(_in_bucket, "a long, b long")
    left = classes.select(F.col("cls").alias("a"), "v", "label")
    right = classes.select(F.col("cls").alias("b"), F.col("v").alias("w"), F.col("label").alias("same"))
    candidates = near.distinct().join(left, "a").join(right, "b").where("label = same")
    return candidates.select("a", "b", "v", "w").mapInArrow(lambda x: _cosines(x, least), "a long, b long")


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Rows link if their labels are equal and the cosine is at least `least`; component_id is
    the smallest vec_id reachable by links. Equal vectors of a label are one class, which
    is searched once. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows without a label, link with nothing and keep their own vec_id; a
    null vec_id links with nothing and has no component. Rows that repeat a vec_id count
    as rows of their own. Vectors of different lengths never link.
    """
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"), F.col("label").cast("long").alias("label"))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & topk.usable("v") & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    taking = read.where(usable)
    classes = stage(
        taking.groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("cls", F.monotonically_increasing_id())
    )
    linked = stage(links(classes, least))
    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("cls").alias("b"), "copies")
    partners = both.join(copies, "b").groupBy(F.col("a").alias("cls")).agg(F.sum("copies").alias("partners"))
    grouped = components(linked).withColumnRenamed("node", "cls")
    known = (
        classes.join(partners, "cls", "left")
        .join(grouped, "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(smallest, "component").select(
        "label", "v", (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"), "component_id"
    )
    found = taking.join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = read.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
