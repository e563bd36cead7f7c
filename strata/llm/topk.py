"""Exact top-k search by integer inner product.

Queries and candidates are dealt into tiles of fixed size. Each pair of a query tile and a
candidate tile is one task: a matrix product, of which each query keeps its k best. The
lists of a query are then merged up a tree, a fixed number of tiles at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.ship import ship

QUERY_TILE = 1024
SHARD = 8192
FAN = 32
_ROWS = 256


def usable(vector: str) -> Column:
    """Not null, not empty, and only finite components."""
    each = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & each, F.lit(False))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False).reshape(-1, dim)


def scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products of integers. Doubles hold them if no sum can reach 2**53;
    else Python's integers do, and a product outside 64 bits becomes the nearest end."""
    if not queries.size or not shard.size:
        return np.zeros((len(queries), len(shard)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(shard).max()) * queries.shape[1]
    if largest < 2**53:
        return (queries @ shard.T).astype(np.int64)
    ends = np.iinfo(np.int64)
    exact = np.array([[int(x) for x in q] for q in queries], object) @ np.array([[int(x) for x in c] for c in shard], object).T
    return np.clip(exact, ends.min, ends.max).astype(np.int64)


def _merged_rows(ids: np.ndarray) -> np.ndarray:
    """Where each distinct id begins in ascending ids."""
    return np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])


def best_of_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray, k: int):
    """(query id, id, score) of each query's k best in the shard, ties to the smaller id.

    An id with several rows counts once, with its best score.
    """
    by_query, by_id = np.argsort(query_ids, kind="stable"), np.argsort(ids, kind="stable")
    query_ids, queries, ids, shard = query_ids[by_query], queries[by_query], ids[by_id], shard[by_id]
    firsts = _merged_rows(ids)
    distinct = ids[firsts]
    out = []
    for a in range(0, len(queries), _ROWS):
        found = scores(queries[a : a + _ROWS], shard)
        if len(firsts) < len(ids):
            found = np.maximum.reduceat(found, firsts, axis=1)
        own = query_ids[a : a + _ROWS]
        others = distinct[None, :] != own[:, None]
        ranked = np.where(others, found, np.iinfo(np.int64).min)
        if len(distinct) > k:
            least = np.partition(ranked, len(distinct) - k, axis=1)[:, len(distinct) - k]
            others &= ranked >= least[:, None]
        row, at = np.nonzero(others)
        value = found[row, at]
        order = np.lexsort((distinct[at], -value, row))
        row, at, value = row[order], at[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < k
        out.append((own[row[top]], distinct[at[top]], value[top]))
    return tuple(np.concatenate(x) for x in zip(*out))


def search(queries: DataFrame, candidates: DataFrame, k: int, query_tile: int = QUERY_TILE, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score) for frames of (id long, v array of numbers), whole numbers.

    Rows with a null id or an unusable vector take no part. Vectors meet only those of their
    own length. Rows that repeat an id are one vector with the best of their scores. A row
    never meets its own id. No queries or no candidates: no rows.
    """
    ship(candidates.sparkSession)

    def tiled(df: DataFrame, size: int) -> tuple[DataFrame, int]:
        df = df.select("id", F.col("v").cast("array<double>").alias("v")).where("id is not null").where(usable("v"))
        n = max(1, math.ceil(df.count() / size))
        return df.withColumn("tile", F.pmod(F.monotonically_increasing_id(), F.lit(n))), n

    queries, rows = tiled(queries, query_tile)
    candidates, columns = tiled(candidates, shard)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 3]
        right = right.rename_columns(left.column_names)
        sizes = [np.asarray(pc.list_value_length(t["v"])) for t in (left, right)]
        for dim in np.intersect1d(*sizes).tolist():
            parts = [t.filter(pa.array(s == dim)) for t, s in zip((left, right), sizes)]
            (qi, q), (ci, c) = ((t["id"].to_numpy(), matrix(t["v"], dim)) for t in parts)
            found.append(best_of_tile(qi, q, ci, c, k))
        query, vec, score = (np.concatenate(x) for x in zip(*found))
        tile = right["column"][0].as_py() if right.num_rows else 0
        return pa.table({"query_id": query, "vec_id": vec, "score": score, "node": np.full(len(query), tile, np.int64)})

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    dealt_queries = queries.select("id", "v", F.col("tile").alias("row"), each(columns).alias("column"))
    # Names of their own: a cogroup drops columns that both sides take from one table.
    dealt_shards = candidates.select(F.col("id").alias("vec_id"), F.col("v").alias("w"), each(rows).alias("at_row"), F.col("tile").alias("at_column"))
    lists = (
        dealt_queries.groupBy("row", "column")
        .cogroup(dealt_shards.groupBy("at_row", "at_column"))
        .applyInArrow(best, "query_id long, vec_id long, score long, node long")
    )
    order = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    while True:
        columns = math.ceil(columns / FAN)
        lists = (
            lists.withColumn("node", F.floor(F.col("node") / FAN))
            .repartition("query_id", "node")
            .groupBy("query_id", "node", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
        )
        if columns <= 1:
            return lists.select("query_id", "rank", "vec_id", "score")
        lists = lists.drop("rank")
