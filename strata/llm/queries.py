"""One query for each operator, over the whole of its given table, and the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import audit, bpe, checks, codes, jaccard, lines, packed, packing, quality, subspace, substrings, suffixes, topk, urls
from strata.sources.staging import shared_folder

# The rules of the given task, as verdict and host with path prefix.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
TOP = 20
THRESHOLD = 0.7


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").where(topk.usable("embedding"))
    whole = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.transform("embedding", lambda x: F.floor(64 * x.cast("double"))).alias("v"),
    )
    return topk.search(whole.where("id % 20 = 0"), whole, TOP)


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encoded(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/packed/{uuid.uuid4().hex}"
    packed.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=1)
    return packed.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.without_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), part="lang")


def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, codebooks = codes.compressed(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256)
    return out.select("vec_id", "code", "error", "label_error", F.lit(codes.codebooks_sha256(codebooks)).alias("codebooks_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # its stages use this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_jaccard": op2_jaccard,
    "op3_bpe": op3_bpe,
    "op4_url_rules": op4_url_rules,
    "op5_packed_ids": op5_packed_ids,
    "op6_substrings": op6_substrings,
    "op7_best_fit": op7_best_fit,
    "op8_suffixes": op8_suffixes,
    "op9_subspace": op9_subspace,
    "op10_quality": op10_quality,
    "op11_line_runs": op11_line_runs,
    "op12_filter_audit": op12_filter_audit,
    "op13_dual_tree": op13_dual_tree,
    "pipeline": pipeline,
}
SQL: dict[str, str] = checks.SQL
