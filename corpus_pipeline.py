"""A corpus pipeline: quality, near copies, repeated passages, packing.

Each stage is called as (spark, docs, sf_dir) on the rows its predecessor kept, which are
written as Parquet and read again in between. All stages but the last return the columns
of documents; the last returns a row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard, packing, quality, substrings
from strata.llm.blocks import quoted
from strata.llm.queries import THRESHOLD, table, tokenizer
from strata.sources.staging import shared_folder, stage


def _new_name(docs: DataFrame) -> str:
    """A name that no column has."""
    taken = {c.lower() for c in docs.columns}
    return next(name for i in range(len(taken) + 1) if (name := f"row_{i}") not in taken)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject, with all their columns as they are.

    It learns from the labels of the folder's documents outside the held-out fold. Rows
    with null or empty texts are judged as an empty text; equal rows are judged alike.
    """
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.kept(docs, model, THRESHOLD)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, nulls last, and
    among rows of one doc_id the least by a hash of the row.

    Every row is a document of its own, also where rows share a doc_id or have none. Rows
    without words all stay.
    """
    row = _new_name(docs)
    columns = [F.col(quoted(c)) for c in docs.columns]
    rows = stage(docs.select(*columns, F.monotonically_increasing_id().alias(row)))
    groups = jaccard.near_copies(rows.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64(F.to_json(F.struct(*columns))).alias("hash"), row)
    least = groups.join(rows.select(row, order.alias("rank")), row).groupBy("component_id").agg(F.min("rank").alias("rank"))
    return rows.join(least.select(f"rank.{row}"), row, "left_semi").select(columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; where an earlier one has a window of 50 words too, the words that are
    left, joined by one space, with n_chars counted anew. Other texts stay as they are."""
    out = substrings.without_repeats(docs, carry=[c for c in docs.columns if c != "text"], as_it_was=True)
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length("kept")).otherwise(F.col("carried.n_chars"))
    return out.select([new.get(f.name, F.col(f"carried.{quoted(f.name)}")).cast(f.dataType).alias(f.name) for f in docs.schema])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.packed(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("substring dedup", without_repeated_passages),
    ("best-fit packing", packed_sequences),
]

#: The classifier and the packing cannot be expressed in SQL; the tests follow each stage
#: with a brute-force version on what the stage before it kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what lies between is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_folder(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{number}")
            docs = spark.read.parquet(f"{base}/{number}")
    return docs
