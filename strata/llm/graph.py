"""Connected components of a graph of any size, with its links in tables throughout.

Alternating star steps on links from a node to a smaller one. First every node is linked
to the smallest parent of its parent, then all parents of a node to the smallest of them.
The links end as stars around the smallest node of each component. A round keeps the
components and takes an aggregate and two equi-joins; chains shorten fast, so the rounds
grow with the logarithm of the length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.sources.staging import stage
from strata.sources.tables import observed


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct links, stored, and a count and hash sum that tell when they stop changing."""
    seen = Observation()
    marked = edges.distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    stored = stage(marked)
    found = observed(seen)
    return stored, (found.get("n"), found.get("h"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of every node of links (a, b); component is its smallest node.

    Nodes are longs. Null ends and links from a node to itself add nothing. `known`, an
    earlier result, is joined by the links; its nodes are then in the result too.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        "a is not null and b is not null and u <> v"
    )
    if known is not None:
        edges = edges.unionByName(known.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v"))
    edges, now = _written(edges)
    before = None
    while now != before:
        before = now
        parent = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        stars = edges.join(parent, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v")).repartition("u")
        low = stars.groupBy("u").agg(F.min("v").alias("m"))
        edges, now = _written(
            stars.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
        )
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
