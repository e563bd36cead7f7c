"""Vector codes: parts of vectors as the numbers of their nearest codebook entries.

The codebooks are refined by Lloyd rounds over two trees. The parts of a block of vectors
lie in a tree of boxes, built once and stored with the block; a codebook's entries lie in
another. A round starts with the pair of the roots and opens both nodes of each pair. A
pair goes when another entry node is surely nearer to all of the data node: the least
distance of the pair exceeds the greatest of another pair of the data node. A data node
with one entry left is assigned whole, and its cached sums are added to the entry's. The
leaves that stay uncertain compare their parts with the entries that are left. All numbers
are integers, so nothing depends on rounding or on how vectors are dealt.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship
from strata.llm.topk import matrix, usable
from strata.sources.staging import stage

#: Numbers in a block of vectors, which is one row of a table; blocks in a file.
BLOCK_NUMBERS = 1 << 20
FILE_BLOCKS = 16
#: Parts in a leaf of the data tree, at most.
LEAF = 16
#: Labels that may hold more than the 100,000th part of all vectors; so there are no more of them.
HOT_LABELS = 100_000
_SUMS = "part int, entry int, n long, sums array<long>"


class Tree:
    """Boxes over points of integers: level l cuts the points, in tree order, into 2 ** l
    runs of nearly equal length, each run at the median of its widest dimension.

    `points` are in tree order and `place` says where they were. A leaf holds `leaf` points
    at most; leaves of one point can be empty. `ordered` points are in tree order already.
    """

    def __init__(self, points: np.ndarray, leaf: int, place: np.ndarray | None = None, ordered: bool = False):
        n = len(points)
        self.depth = max(0, math.ceil(math.log2(n / leaf))) if n else 0
        self.bounds = [(np.arange((1 << level) + 1) * n) >> level for level in range(self.depth + 1)]
        place = np.arange(n) if place is None else place
        if not ordered:
            for bounds in self.bounds[:-1]:
                points, order = self._cut(points, bounds)
                place = place[order]
        self.points, self.place = points, place
        starts = [b[:-1] for b in self.bounds]
        self.low = [np.minimum.reduceat(points, s, axis=0) for s in starts] if n else []
        self.high = [np.maximum.reduceat(points, s, axis=0) for s in starts] if n else []

    def named(self, leaves: np.ndarray) -> np.ndarray:
        """Where the points of one-point leaves were."""
        return self.place[self.bounds[self.depth][leaves]]

    @staticmethod
    def _cut(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every run sorted along its widest dimension."""
        starts, sizes = bounds[:-1], np.diff(bounds)
        low = np.minimum.reduceat(points, starts, axis=0)
        widest = np.argmax(np.maximum.reduceat(points, starts, axis=0) - low, axis=1)
        node = np.repeat(np.arange(len(sizes)), sizes)
        values = points[np.arange(len(points)), widest[node]]
        order = np.lexsort((values, node))
        return points[order], order


def _far(d_low: np.ndarray, d_high: np.ndarray, e_low: np.ndarray, e_high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest squared distance between the points of two boxes, by rows."""
    apart = np.maximum(np.maximum(e_low - d_high, d_low - e_high), 0)
    reach = np.maximum(e_high - d_low, d_high - e_low)
    return (apart * apart).sum(axis=1), (reach * reach).sum(axis=1)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    gap = points - entries
    return (gap * gap).sum(axis=-1)


def _opened(node: np.ndarray, level: int, depth: int) -> tuple[np.ndarray, int]:
    """The children of nodes, two of each; leaves stay."""
    return (np.stack([2 * node, 2 * node + 1], axis=1), level + 1) if level < depth else (node[:, None], level)


def nearest(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """The nearest entry of each point in tree order, ties to the lower index; the nodes that
    were assigned whole, as first point, end and entry; and how many distances were computed.
    """
    n = len(tree.points)
    entries, lowest = np.unique(codebook, axis=0, return_index=True)  # of equal entries the lowest wins
    book = Tree(entries, 1, lowest)
    out, whole, work = np.full(n, -1, np.int64), [], 0
    data, entry = np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    d_level = e_level = 0
    while len(data):
        least, most = _far(tree.low[d_level][data], tree.high[d_level][data], book.low[e_level][entry], book.high[e_level][entry])
        firsts = np.flatnonzero(np.r_[True, data[1:] != data[:-1]])
        counts = np.diff(np.r_[firsts, len(data)])
        stay = least <= np.repeat(np.minimum.reduceat(most, firsts), counts)
        data, entry = data[stay], entry[stay]
        firsts = np.flatnonzero(np.r_[True, data[1:] != data[:-1]])
        counts = np.diff(np.r_[firsts, len(data)])
        if e_level == book.depth:
            alone = counts == 1
            nodes, winners = data[firsts[alone]], book.named(entry[firsts[alone]])
            a, b = tree.bounds[d_level][nodes], tree.bounds[d_level][nodes + 1]
            whole.append((a, b, winners))
            out[_runs(a, b)] = np.repeat(winners, b - a)
            open_pairs = np.repeat(~alone, counts)
            data, entry = data[open_pairs], entry[open_pairs]
            if d_level == tree.depth:
                work += _leaves(tree, codebook, data, book.named(entry), out)
                break
        (data_to, d_next), (entry_to, e_next) = _opened(data, d_level, tree.depth), _opened(entry, e_level, book.depth)
        shape = (len(data), data_to.shape[1], entry_to.shape[1])
        data = np.broadcast_to(data_to[:, :, None], shape).reshape(-1)
        entry = np.broadcast_to(entry_to[:, None, :], shape).reshape(-1)
        d_level, e_level = d_next, e_next
        filled = np.flatnonzero(book.bounds[e_level][entry] < book.bounds[e_level][entry + 1])
        order = filled[np.argsort(data[filled], kind="stable")]
        data, entry = data[order], entry[order]
    return out, whole, work


def _runs(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all runs first..end (excluded), one run after another."""
    sizes = end - first
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _leaves(tree: Tree, codebook: np.ndarray, data: np.ndarray, entry: np.ndarray, out: np.ndarray) -> int:
    """Assign the points of uncertain leaves, each among its leaf's entries in ascending order."""
    if not len(data):
        return 0
    order = np.lexsort((entry, data))
    data, entry = data[order], entry[order]
    firsts = np.flatnonzero(np.r_[True, data[1:] != data[:-1]])
    counts = np.diff(np.r_[firsts, len(data)])
    bounds = tree.bounds[tree.depth]
    a, b = bounds[data[firsts]], bounds[data[firsts] + 1]
    at, of = _runs(a, b), np.repeat(np.arange(len(firsts)), b - a)
    best = np.full(len(at), np.iinfo(np.int64).max)
    winner = np.zeros(len(at), np.int64)
    points, work = tree.points[at], 0
    for rank in range(int(counts.max())):
        left = np.flatnonzero(counts[of] > rank)
        mine = entry[firsts[of[left]] + rank]
        found = distances(points[left], codebook[mine])
        work += len(left)
        nearer = found < best[left]
        best[left[nearer]], winner[left[nearer]] = found[nearer], mine[nearer]
    out[at] = winner
    return work


def entry_sums(tree: Tree, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many points each entry has, and their sums: whole nodes by sums kept along the
    tree order, the rest point by point."""
    out, whole, _ = nearest(tree, codebook)
    k, dim = codebook.shape
    n, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    kept = np.concatenate([np.zeros((1, dim), np.int64), np.cumsum(tree.points, axis=0)])
    single = np.ones(len(out), bool)
    for a, b, winners in whole:
        np.add.at(n, winners, b - a)
        np.add.at(sums, winners, kept[b] - kept[a])
        single[_runs(a, b)] = False
    np.add.at(n, out[single], 1)
    np.add.at(sums, out[single], tree.points[single])
    return n, sums


def largest(dim: int) -> int:
    """Components are held to this, so that squared distances of whole vectors fit 62 bits."""
    return math.isqrt(2**62 // dim) // 2


# --- blocks -----------------------------------------------------------------------------


def _block(table: pa.Table, dim: int, parts: int) -> pa.RecordBatch:
    """One row: the ids and labels, and the parts of all vectors in tree order, position by position."""
    vectors, width = matrix(table["v"], dim), dim // parts
    trees = [Tree(vectors[:, p * width : (p + 1) * width], LEAF) for p in range(parts)]
    values = {
        "ids": pa.array([table["vec_id"].to_pylist()], pa.list_(table["vec_id"].type)),
        "labels": pa.array([table["label"].to_pylist()], pa.list_(table["label"].type)),
        "n": pa.array([len(table)], pa.int64()),
        "points": pa.array([b"".join(t.points.astype(_kind(dim)).tobytes() for t in trees)], pa.binary()),
        "places": pa.array([b"".join(t.place.astype(np.int32).tobytes() for t in trees)], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(values)


def _kind(dim: int) -> type:
    return np.int32 if largest(dim) < 2**31 else np.int64


def _trees(points: bytes, places: bytes, n: int, dim: int, parts: int) -> list[Tree]:
    """The trees of a stored block."""
    p = np.frombuffer(points, _kind(dim)).reshape(parts, n, dim // parts).astype(np.int64)
    at = np.frombuffer(places, np.int32).reshape(parts, n)
    return [Tree(p[i], LEAF, at[i], ordered=True) for i in range(parts)]


def blocks(vectors: DataFrame, dim: int, parts: int) -> DataFrame:
    """Rows of (vec_id, label, v) gathered within tasks into blocks with their trees; written once."""
    rows_of_block = max(1, BLOCK_NUMBERS // dim)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    out = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, n long, points binary, places binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while len(batch):
                piece = batch.slice(0, rows_of_block - sum(map(len, held)))
                batch = batch.slice(len(piece))
                held.append(piece)
                if sum(map(len, held)) == rows_of_block:
                    yield _block(pa.Table.from_batches(held), dim, parts)
                    held = []
        if held:
            yield _block(pa.Table.from_batches(held), dim, parts)

    return stage(vectors.mapInArrow(gather, out), maxRecordsPerFile=FILE_BLOCKS)


# --- rounds -----------------------------------------------------------------------------


def refined(stored: DataFrame, codebooks: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """The codebooks after a round. The driver gets one row per part and entry."""
    parts = len(codebooks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part, entry, n, total = [], [], [], []
                for p, tree in enumerate(_trees(row["points"], row["places"], row["n"], dim, parts)):
                    count, added = entry_sums(tree, codebooks[p])
                    used = np.flatnonzero(count)
                    part += [p] * len(used)
                    entry += used.tolist()
                    n += count[used].tolist()
                    total += added[used].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
                    names=["part", "entry", "n", "sums"],
                )

    width = dim // parts
    each = stored.select("n", "points", "places").mapInArrow(sums, _SUMS)
    added = each.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)])
    out = [c.copy() for c in codebooks]
    for row in added.collect():
        out[row["part"]][row["entry"]] = [int(row[f"s{j}"]) // row["n"] for j in range(width)]
    return out


def _coded(stored: DataFrame, codebooks: list[np.ndarray], dim: int) -> DataFrame:
    parts = len(codebooks)
    kinds = {f.name: f.dataType.elementType.simpleString() for f in stored.schema if f.name in ("ids", "labels")}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in ("n", "points", "places")}
                code = np.zeros((row["n"], parts), np.uint8)
                error = np.zeros(row["n"], np.int64)
                for p, tree in enumerate(_trees(row["points"], row["places"], row["n"], dim, parts)):
                    found, *_ = nearest(tree, codebooks[p])
                    code[tree.place, p] = found
                    error[tree.place] += distances(tree.points, codebooks[p][found])
                text = code.tobytes().hex()
                codes = [text[2 * parts * j : 2 * parts * (j + 1)] for j in range(row["n"])]
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return stored.mapInArrow(assign, f"vec_id {kinds['ids']}, label {kinds['labels']}, code string, error long")


def codebook_text(codebooks: list[np.ndarray]) -> str:
    return ",".join(str(x) for c in codebooks for x in c.reshape(-1).tolist())


def compressed(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error, label_error), codebooks) of rows (vec_id, embedding, label).

    Each component x becomes the integer floor(scale * x), vectors are cut into `parts` equal
    parts, and each part has a codebook of up to 256 entries. It starts as that part of the
    vectors of the smallest vec_ids, in ascending order, nulls last and equal ids by their
    components; a smaller table has as many entries as vectors. `rounds` times, every part
    goes to its nearest entry, ties to the lower index, and each entry becomes the
    floor of the mean of its parts; entries without parts stay. A code is two hex digits a
    part; its error is the squared distance; label_error sums errors of a label, nulls
    together.

    Left out: vectors that are null, empty, or hold null or non-finite components; those
    whose length is not a multiple of `parts`; and those of another length than the first by
    vec_id of the rest. Repeated rows are vectors of their own. Components are held to
    +-sqrt(2**62 / length) / 2 after scaling, 2**27 at 64 dimensions, so that errors fit 64
    bits. An empty table gives no rows and no codebooks. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name 1 to 256 entries")
    spark = vectors.sparkSession
    ship(spark)
    kept = vectors.where(usable("embedding") & (F.size("embedding") % parts == 0))
    by_id = F.col("vec_id").asc_nulls_last()
    first = kept.orderBy(by_id, F.size("embedding")).select(F.size("embedding")).first()
    if first is None:
        none = [F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")]
        return kept.where("false").select("vec_id", "label", *none), []
    dim = first[0]
    limit = F.lit(largest(dim))
    held = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(scale * x.cast("double")), limit), -limit))
    kept = kept.where(F.size("embedding") == dim).select("vec_id", "label", held.alias("v"))
    start = kept.orderBy(by_id, "v").limit(entries).collect()
    width = dim // parts
    start = np.array([r["v"] for r in start], np.int64)
    codebooks = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    stored = blocks(kept, dim, parts)
    for _ in range(rounds):
        codebooks = refined(stored, codebooks, dim)
    coded = stage(_coded(stored, codebooks, dim))
    totals = stage(coded.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("error").alias("label_error")))
    return _with_label_errors(coded, totals), codebooks


def _with_label_errors(coded: DataFrame, totals: DataFrame) -> DataFrame:
    """Labels with many vectors are few and broadcast; the others are joined by key."""
    all_rows = totals.agg(F.sum("rows")).first()[0]
    is_hot = F.col("rows") * HOT_LABELS >= all_rows
    totals = totals.select(F.col("label").alias("of"), "label_error", is_hot.alias("hot"))
    same = F.col("label").eqNullSafe(F.col("of"))
    hot, rest = totals.where("hot"), totals.where("not hot")
    some = coded.join(F.broadcast(hot), same, "left")
    out = ["vec_id", "label", "code", "error", "label_error"]
    more = some.where("hot is null").drop("of", "label_error", "hot").join(rest, same)
    return some.where("hot").select(out).unionByName(more.select(out))


def codebooks_sha256(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(codebook_text(codebooks).encode()).hexdigest()
