"""Documents with a Jaccard similarity of word shingles of at least four fifths.

Equal sets are one class. A sketch over all classes gives each shingle a frequency; the
global order is rare ones first. A class is a candidate only if enough of its shingles are
shared, and two classes can link only if they share one in the prefix of the global order.

Similarities are counted with vertical partitions: the classes that prefixes connect are a
family, the pairs of families are dealt into cells, and the order of n-grams by hash is cut
into a few fragments. Each fragment of a cell counts the overlaps of its pairs alone; the
parts are summed per pair. A family whose pairs are more than a cell holds is cut into tiles
by the later class of a pair, and a class with more partners than that by the earlier one
too, so a cell has the classes of its own pairs only.

Which pairs are counted: in each list of a prefix shingle first the four smallest classes
with every later one, then the next 32, and so on; pairs that are already in one component,
or whose sets are too short behind the shared shingle, are left out. So a group of n near copies takes a few n pairs, and no link between two
components is ever missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import blocks as B
from strata.llm import words as W
from strata.llm.graph import components
from strata.llm.ship import ship
from strata.sources.staging import stage

SHINGLE = 5
LEAST = (4, 5)
FRAGMENT = 1 << 20
GROUP_FRAGMENTS = 4
FIRST_PLACES = 4
#: Lists of more classes than this are joined by bands of set sizes, each BAND times the last.
LONG_LIST = 32
BAND = 1.02
_SETS = "doc_id long, n_shingles long, s1 long, s2 long"
_CANDIDATES = "cls long, n long, m long, prefix array<long>, body binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct shingles, ascending. A row of fewer words, but
    not none, has its whole sequence as one."""
    rows, keys = [], []
    for a, b in W.parts(offsets):
        base = int(offsets[a])
        _, _, hashes, bounds = W.hashed(data[base : int(offsets[b])], offsets[a : b + 1] - base, lower=True)
        firsts, row = W.windows(bounds, size)
        counts = np.diff(bounds)
        short = np.flatnonzero((counts > 0) & (counts < size))
        row = np.r_[row, short]
        key = np.r_[W.run_hashes(hashes, firsts, firsts + size), W.run_hashes(hashes, bounds[short], bounds[short + 1])]
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])] if len(row) else np.zeros(0, bool)
        rows.append(row[new] + a)
        keys.append(key[new])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(keys)


def signatures(rows: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each row's set and two sums of mixed hashes that name it."""
    bounds = W.row_bounds(rows, n)
    sums = []
    for seed in (21, 22):
        with np.errstate(over="ignore"):
            total = np.r_[np.uint64(0), np.cumsum(W.mix(keys, seed))]
            sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return np.diff(bounds), sums[0], sums[1]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        for a, b in W.parts(offsets):
            base = int(offsets[a])
            found = shingle_sets(data[base : int(offsets[b])], offsets[a : b + 1] - base)
            n, s1, s2 = (pa.array(x) for x in signatures(*found, b - a))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), n, s1, s2], ["doc_id", "n_shingles", "s1", "s2"])


class _Block:
    def __init__(self, table: pa.Table):
        self.table = B.in_order(table)
        self.number = table["block"][0].as_py()
        self.rows, self.keys = shingle_sets(*W.utf8(self.table["text"]))

    def only(self, of_row: np.ndarray) -> None:
        """Keep the rows that stand for a class."""
        keep = of_row[self.rows] >= 0
        self.rows, self.keys = self.rows[keep], self.keys[keep]

    def cells(self, width: int) -> np.ndarray:
        return W.mix(self.keys, 30) >> np.uint64(64 - width)


def _frequencies(rows: list[tuple]) -> list[bytes]:
    """A byte per cell: how often all blocks have it, as a power of two; 0: once."""
    runs = [B.unpack_sorted(r[4][: -r[3]], r[3]) for r in rows]
    counts = np.concatenate([np.frombuffer(r[4][-r[3] :], np.uint8) for r in rows])
    _, back = np.unique(np.concatenate(runs), return_inverse=True)
    total = np.bincount(back, counts)
    level = np.ceil(np.log2(total)).astype(np.uint8)[back]
    return [x.tobytes() for x in np.split(level, np.cumsum([len(r) for r in runs])[:-1])]


def candidates(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, n, m, prefix, body) of the classes that may have a partner: set size, shared
    shingles, those of them in the prefix, and all of them as ascending hashes.

    classes: (cls, doc_id, s1, s2), the document that stands for each class.
    """
    n_bytes = B.text_bytes(docs)
    n_blocks = B.block_count(docs, n_bytes)
    width, bits = min(56, max(16, math.ceil(math.log2(n_bytes + 1)) + 3)), B.range_bits(n_bytes // 6)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    held = read.select(B.block_of(n_blocks, "doc_id").alias("block"), "doc_id", "text").repartition(n_blocks, "block")
    chosen = classes.select(B.block_of(n_blocks, "doc_id").alias("at"), "cls", F.col("doc_id").alias("id"), "s1", "s2")

    def ask(table: pa.Table, standing: pa.Table) -> pa.Table:
        if not table.num_rows or not standing.num_rows:
            return B.sent_table([])
        block = _Block(table)
        _, s1, s2 = signatures(block.rows, block.keys, table.num_rows)
        named = dict(zip(zip(*(standing[c].to_pylist() for c in ("id", "s1", "s2"))), standing["cls"].to_pylist()))
        of_row = np.array(
            [named.pop(key, -1) for key in zip(block.table["doc_id"].to_pylist(), s1.tolist(), s2.tolist())], np.int64
        )
        block.only(of_row)
        cells, counts = np.unique(block.cells(width), return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        rows = [
            (block.number, 0, r, b - a, B.pack_sorted(cells[a:b]) + counts[a:b].tobytes())
            for r, a, b in B.cut_ranges(cells, bits, width)
        ]
        return B.sent_table([*rows, (block.number, B.NOTE, block.number, len(of_row), of_row.tobytes())])

    def choose(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = B.sent_rows(answers)
        note = [np.frombuffer(r[4], np.int64) for r in rows if r[1] == B.NOTE]
        found: list[tuple] = []
        if table.num_rows and note:
            block, of_row = _Block(table), note[0]
            block.only(of_row)
            _, _, back = B.grouped(block.cells(width))
            level = np.frombuffer(b"".join(r[4] for r in rows if r[1] == 0), np.uint8)[back]
            bounds = W.row_bounds(block.rows, len(of_row))
            n = np.diff(bounds)
            shared = np.r_[0, np.cumsum(level > 0)]
            m = shared[bounds[1:]] - shared[bounds[:-1]]
            for row in np.flatnonzero((n > 0) & (m * LEAST[1] >= n * LEAST[0])).tolist():
                a, b = bounds[row], bounds[row + 1]
                keys, levels = block.keys[a:b], level[a:b]
                first = int(n[row]) - -(-int(n[row]) * LEAST[0] // LEAST[1]) + 1
                prefix = np.lexsort((keys, levels))[:first]
                prefix = keys[prefix[levels[prefix] > 0]].view(np.int64)
                found.append((int(of_row[row]), int(n[row]), int(m[row]), prefix.tolist(), keys[levels > 0].tobytes()))
        columns = list(zip(*found)) if found else [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
        return pa.table({c: pa.array(x, k) for c, x, k in zip(("cls", "n", "m", "prefix", "body"), columns, kinds)})

    by_block = held.groupBy("block")
    levels = B.answered(by_block.cogroup(chosen.groupBy("at")).applyInArrow(ask, B.SENT), _frequencies)
    return by_block.cogroup(levels.groupBy("block")).applyInArrow(choose, _CANDIDATES)


def _overlaps(segments: pa.Table, pairs: pa.Table) -> pa.Table:
    """Shared shingles of each pair in one fragment."""
    a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    out = np.zeros(len(a), np.int64)
    if segments.num_rows and len(a):
        cls = segments["cls"].to_numpy()
        bodies = segments["body"].to_pylist()
        lengths = np.array([len(x) // 8 for x in bodies])
        _, codes = np.unique(np.frombuffer(b"".join(bodies), np.uint64), return_inverse=True)
        order = np.argsort(cls, kind="stable")
        firsts = np.cumsum(lengths) - lengths

        def place(x: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(cls, x, sorter=order), len(cls) - 1)
            return np.where(cls[order[at]] == x, order[at], -1)

        left, right = place(a), place(b)
        mark = np.zeros(int(codes.max(initial=-1)) + 1, bool)
        by_left = np.argsort(left, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(left[by_left]) != 0, True])
        for i, j in zip(cuts[:-1], cuts[1:]):
            one, others = left[by_left[i]], by_left[i:j]
            others = others[right[others] >= 0]
            if one < 0 or not len(others):
                continue
            own = codes[firsts[one] : firsts[one] + lengths[one]]
            mark[own] = True
            sizes = lengths[right[others]]
            at = np.arange(int(sizes.sum())) + np.repeat(firsts[right[others]] - (np.cumsum(sizes) - sizes), sizes)
            total = np.r_[0, np.cumsum(mark[codes[at]])]
            ends = np.cumsum(sizes)
            out[others] = total[ends] - total[ends - sizes]
            mark[own] = False
    return pa.table({"a": a, "na": pairs["na"], "b": b, "nb": pairs["nb"], "shared": out})


def _met(active: DataFrame, first: int, many: int) -> DataFrame:
    """Classes of `many` places from `first` on, and what they meet in their lists.

    Sizes grow along a list, and what is left of both sets must hold the overlap that a link
    asks for. So a class whose rest is too short meets nothing, and in a long list a class
    meets only the bands of sizes that its own size and rest allow.
    """
    part, whole = LEAST

    def band(size: Column) -> Column:
        return F.when(F.col("size") > LONG_LIST, F.floor(F.log(size) / math.log(BAND))).otherwise(F.lit(0).cast("long"))

    most = F.least(F.col("left") * (part + whole) / part - F.col("n"), F.col("n") * whole / part)
    left = active.where(f"place >= {first} and place < {first + many} and left * {part + whole} >= 2 * n * {part}")
    left = left.select(
        "s", F.explode(F.sequence(band(F.col("n")), band(most + 0.5))).alias("band"), F.col("cls").alias("a"),
        F.col("n").alias("na"), F.col("left").alias("la"), F.col("place").alias("p"), F.col("component").alias("ca"),
    )
    right = active.where(f"left * {whole} >= n * {part}").select(
        "s", band(F.col("n")).alias("band"), F.col("cls").alias("b"), F.col("n").alias("nb"), "left", "place", "component"
    )
    return left.join(right, ["s", "band"])


def _in_cells(pairs: DataFrame) -> DataFrame:
    """Pairs (family, a, na, b, nb) and the cell of each."""
    room = FRAGMENT * GROUP_FRAGMENTS
    total = pairs.agg(F.sum(F.col("na") + F.col("nb"))).head()[0] or 0
    # Both tables have at most a row for every cell.
    large = pairs.groupBy("family").agg(F.ceil(F.sum(F.col("na") + F.col("nb")) / room).alias("tiles")).where("tiles > 1")
    wide = pairs.groupBy("b").agg(F.ceil(F.sum("na") / room).alias("parts")).where("parts > 1")
    one = F.lit(1).cast("long")
    tile = F.pmod(F.xxhash64("b"), F.coalesce("tiles", one))
    part = F.pmod(F.xxhash64("a"), F.coalesce("parts", one))
    cell = F.pmod(F.xxhash64("family", tile, part), F.lit(max(1, math.ceil(total / room))))
    return pairs.join(F.broadcast(large), "family", "left").join(F.broadcast(wide), "b", "left").select(cell.alias("cell"), "a", "na", "b", "nb")


def linked_classes(found: DataFrame) -> DataFrame:
    """(node, component) of the candidate classes that link with another."""
    # What is left of a set from a shared shingle on bounds the overlap of a pair that meets there first.
    postings = found.select("cls", "n", "m", F.posexplode("prefix").alias("k", "s")).select("cls", "n", (F.col("m") - F.col("k")).alias("left"), "s")
    lists = postings.groupBy("s").agg(F.count("*").alias("size"), F.min("cls").alias("a")).where("size > 1")
    postings = stage(
        postings.join(lists, "s").withColumn("place", F.row_number().over(Window.partitionBy("s").orderBy("n", "cls")))
    )
    families = stage(components(postings.select("a", F.col("cls").alias("b"))).select(F.col("node").alias("cls"), F.col("component").alias("family")))
    total, most = found.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).head()
    fragments = max(1, min(GROUP_FRAGMENTS, math.ceil(total / FRAGMENT)), math.ceil(most / FRAGMENT))
    limits_at = np.array([(i << 64) // fragments for i in range(1, fragments)], np.uint64)

    def fragment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for cls, body in zip(batch.column("cls").to_pylist(), batch.column("body").to_pylist()):
                keys = np.sort(np.frombuffer(body, np.uint64))
                limits = [0, *np.searchsorted(keys, limits_at).tolist(), len(keys)]
                rows += [(f, cls, keys[p:q].tobytes()) for f, (p, q) in enumerate(zip(limits, limits[1:])) if q > p]
            columns = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.binary())], ["fragment", "cls", "body"]
            )

    segments = stage(
        found.join(families, "cls", "left_semi").select("cls", "body").mapInArrow(fragment, "fragment long, cls long, body binary")
    )
    known, first, many = None, 1, FIRST_PLACES
    while True:
        active = postings.withColumn("component", F.col("cls"))
        if known is not None:
            active = postings.join(known.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
            mixed = active.groupBy("s").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.max("place").alias("last"))
            active = stage(active.join(mixed.where(f"x <> y and last > {first}").select("s"), "s"))
            if active.isEmpty():
                return known
        pairs = (
            _met(active, first, many)
            .where(f"place > p and ca <> component and na * {LEAST[1]} >= nb * {LEAST[0]}")
            .where(f"least(la, left) * {sum(LEAST)} >= (na + nb) * {LEAST[0]}")
            .select("a", "na", "b", "nb")
            .distinct()
        )
        dealt = stage(_in_cells(stage(pairs.join(families.withColumnRenamed("cls", "a"), "a"))))
        used = dealt.select("cell", F.col("a").alias("cls")).unionByName(dealt.select("cell", F.col("b").alias("cls"))).distinct()
        each = dealt.select(
            F.col("cell").alias("c"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fragments - 1).cast("long"))).alias("f"), "a", "na", "b", "nb"
        )
        counted = (
            segments.join(used, "cls")
            .select("cell", "fragment", "cls", "body")
            .groupBy("cell", "fragment")
            .cogroup(each.groupBy("c", "f"))
            .applyInArrow(_overlaps, "a long, na long, b long, nb long, shared long")
            .groupBy("a", "na", "b", "nb")
            .agg(F.sum("shared").alias("shared"))
        )
        new = counted.where(f"shared * {LEAST[1]} >= (na + nb - shared) * {LEAST[0]}").select("a", "b")
        known = components(new, known)
        first, many = first + many, 8 * many


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are lower-cased in A-Z; a set has the distinct five-word shingles, or the whole
    sequence if there are fewer words. Two documents link at a Jaccard similarity of 4/5
    or more, decided in whole numbers on 64-bit shingle hashes; component_id is the
    smallest doc_id reachable by links. Null and empty texts have an empty set and link
    with nothing. Rows that repeat a doc_id are documents of their own. A null doc_id links
    with nothing and has no component. Columns other than doc_id and text are not read.
    """
    ship(docs.sparkSession)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stage(read.mapInArrow(_sets, _SETS))
    named = sets.where("doc_id is not null and n_shingles > 0")
    classes = stage(
        named.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("doc_id")).withColumn("cls", F.monotonically_increasing_id())
    )
    found = stage(candidates(read, classes.select("cls", "doc_id", "s1", "s2")))
    grouped = linked_classes(found).withColumnRenamed("node", "cls")
    known = classes.join(grouped, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = known.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = known.join(smallest, "component").select("n_shingles", "s1", "s2", "component_id")
    linked = named.join(known, ["n_shingles", "s1", "s2"]).select("doc_id", "n_shingles", "component_id")
    alone = sets.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
